from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql.types import StructType

from rankmart.plans.gold import (
    experience_global_rank,
    player_progression,
    skills_global_rank,
    skills_progression,
    world_summary,
)
from rankmart.sources.domain import TABLES

AT = datetime(2024, 3, 1, 12)
DAY = [datetime(2024, 1, d, 8) for d in range(1, 9)]
VOCATION = """name string, world string, vocation string, level int, experience bigint,
    world_type string, start_date timestamp, is_current boolean"""
SKILLS = """name string, world string, category string, vocation string, skill_level int,
    start_date timestamp, is_current boolean"""


def vocation(spark, *rows):
    return spark.createDataFrame([(n, w, "knight", lv, xp, "open", at, cur)
                                  for n, w, lv, xp, at, cur in rows], VOCATION)


def skills(spark, *rows):
    return spark.createDataFrame([(n, w, c, "knight", lv, at, True) for n, w, c, lv, at in rows], SKILLS)


def test_rank_order_and_ties(spark):
    state = vocation(
        spark,
        ("b", "x", 10, 5, DAY[0], True),
        ("a", "y", 10, 5, DAY[0], True),
        ("a", "x", 10, 5, DAY[0], True),
        ("c", "x", 10, 9, DAY[0], True),
        ("d", "x", 11, 1, DAY[0], True),
        ("e", "x", None, 99, DAY[0], True),
        ("z", "x", 99, 99, DAY[0], False),
    )
    for rows_per_slice in (1_000_000, 1):
        df = experience_global_rank(state, AT, rows_per_slice=rows_per_slice)
        got = [(r["rank"], r["name"], r["world"]) for r in df.orderBy("rank").collect()]
        assert got == [
            (1, "d", "x"), (2, "c", "x"), (3, "a", "x"), (4, "a", "y"), (5, "b", "x"), (6, "e", "x"),
        ]
    expected = StructType.fromDDL(TABLES["gold.experience_global_rank"][0])
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in expected]
    assert df.first()["snapshot_date"] == date(2024, 3, 1)


def test_skill_rank_per_category(spark):
    state = skills(spark, ("a", "x", "axe", 5, DAY[0]), ("b", "x", "axe", 7, DAY[0]),
                   ("a", "x", "club", 1, DAY[0]))
    df = skills_global_rank(state, AT)
    expected = StructType.fromDDL(TABLES["gold.skills_global_rank"][0])
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in expected]
    got = sorted((r["skill_name"], r["rank"], r["name"]) for r in df.collect())
    assert got == [("axe", 1, "b"), ("axe", 2, "a"), ("club", 1, "a")]


def test_summary_counts_distinct_names(spark, rows):
    state = vocation(spark, ("a", "x", 1, 1, DAY[0], True), ("a", "x", 2, 1, DAY[1], True),
                     ("b", "x", 1, 1, DAY[0], True), ("c", "x", 1, 1, DAY[0], False))
    assert rows(world_summary(state, AT), "world", "players_count") == [("x", 2)]


def test_progression_spans_worlds(spark):
    state = vocation(
        spark,
        ("a", "x", 10, 1000, DAY[0], False),
        ("a", "y", 12, 1500, DAY[3], True),
        ("b", "x", 1, 1, DAY[0], True),
    )
    got = player_progression(state, AT).collect()
    assert len(got) == 1
    row = got[0].asDict()
    assert (row["world"], row["level_gain"], row["experience_gain"]) == ("y", 2, 500)
    assert (row["days_between_updates"], row["avg_xp_per_day"]) == (3, 166.67)
    assert (row["previous_start_date"], row["current_start_date"]) == (DAY[0], DAY[3])


def test_a_version_after_a_missing_level_is_left_out(spark):
    state = vocation(
        spark,
        ("a", "x", 1, 1, DAY[0], False),
        ("a", "x", None, 2, DAY[1], False),
        ("a", "x", 3, 3, DAY[2], True),
    )
    assert [r["current_start_date"] for r in player_progression(state, AT).collect()] == [DAY[1]]


def test_same_day_rates(spark):
    later = DAY[0].replace(hour=20)
    state = vocation(spark, ("a", "x", 1, 10, DAY[0], False), ("a", "x", 2, 7, later, True))
    assert player_progression(state, AT).first()["avg_xp_per_day"] == -3.0
    assert player_progression(state, AT, same_day="null").first()["avg_xp_per_day"] is None
    held = skills(spark, ("a", "x", "axe", 1, DAY[0]), ("a", "x", "axe", 2, later),
                  ("a", "x", "axe", 4, DAY[2]))
    rates = [r["avg_skill_per_day"] for r in skills_progression(held, AT).orderBy("to_date").collect()]
    assert rates == [None, 1.0]
    with pytest.raises(ValueError, match="same_day"):
        skills_progression(held, AT, same_day="zero")


def test_skill_progression_keeps_categories_apart(spark):
    state = skills(spark, ("a", "x", "axe", 1, DAY[0]), ("a", "x", "club", 9, DAY[1]),
                   ("a", "x", "axe", 3, DAY[4]))
    for rows_per_slice in (1_000_000, 0.5):
        got = skills_progression(state, AT, rows_per_slice=rows_per_slice).collect()
        assert [(r["category"], r["skill_before"], r["skill_after"], r["skill_gain"],
                 r["days_between_updates"], r["avg_skill_per_day"]) for r in got] == [
            ("axe", 1, 3, 2, 4, 0.5)
        ]
