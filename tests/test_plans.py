"""The plans are the ones the operators promise."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rankmart.operators.rank import global_rank
from rankmart.operators.scd2 import scd2_apply, scd2_from_batches, scd2_open, scd2_step
from rankmart.plans import gold, marts, silver, views
from rankmart.plans.bronze import bronze_skills, bronze_vocation
from rankmart.queries.standin import daily_vocation, population, table
from rankmart.sources import tables
from rankmart.sources.domain import EXPERIENCE_HEADER, SKILLS_HEADER
from rankmart.sources.landing import read_landing, write_landing
from rankmart.sources.pages import NAVIGATION_LIST, extract_rows

SF_DIR = "/root/testdata/sf0.001"
AT = datetime(2024, 3, 1, 12)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(df, *kinds: str) -> int:
    """How many nodes of the physical plan are of these kinds."""
    return sum(line.strip(" :+-*()0123456789").startswith(kinds) for line in plan(df).splitlines())


def test_versions_need_one_shuffle_after_the_daily_rows(spark):
    daily = daily_vocation(spark, SF_DIR)
    versions = scd2_from_batches(daily, silver.VOCATION.keys, silver.VOCATION.tracked, "day")
    assert nodes(versions, "Exchange") - nodes(daily, "Exchange") <= 1


def test_progression_shares_one_window(spark):
    state = scd2_open(population(spark, SF_DIR), ["level"], F.lit(AT))
    df = gold.player_progression(state, AT)
    assert nodes(df, "Window") == 1


def test_a_sliced_ranking_never_gathers_its_rows(spark):
    items = table(spark, SF_DIR, "lineitem")
    df = global_rank(items, ["-l_quantity", "l_orderkey", "l_linenumber"], rows_per_slice=300)
    window = plan(df).split("Window [row_number")[1]
    exchange = window.split("Exchange ", 1)[1]
    assert exchange.startswith("hashpartitioning(_slice")


def test_apply_joins_once(spark, tmp_path):
    state = scd2_open(population(spark, SF_DIR).drop("start_date", "end_date", "is_current",
                                                     "hash_diff"), ["level"], F.lit(AT))
    # Spark decides by size whether to broadcast, and knows that of stored tables.
    state.write.parquet(str(tmp_path / "state"))
    state = spark.read.parquet(str(tmp_path / "state"))
    updates = state.drop("start_date", "end_date", "is_current", "hash_diff")
    stepped = scd2_step(state, updates, ["name", "world"], ["level"], AT)
    assert nodes(stepped, "SortMergeJoin") == 1
    small = scd2_step(state, updates, ["name", "world"], ["level"], AT, small_updates=True)
    assert nodes(small, "SortMergeJoin") == 0


def test_scans_read_only_what_is_needed(spark):
    text = plan(gold.world_summary(population(spark, SF_DIR), AT))
    assert "c_custkey" not in text.split("ReadSchema: struct<")[1].split(">")[0]
    rows = extract_rows(table(spark, SF_DIR, "pages"), NAVIGATION_LIST)
    assert "StringContains(html,<nav)" in plan(rows)
    assert "url:" not in plan(rows)


def player_rows(spark, day, levels):
    return spark.createDataFrame(
        [("1", n, "Knight", "Antica", str(lv), f"{lv * 1000:,}", "Open PvP") for n, lv in levels],
        ", ".join(f"`{c}` string" for c in EXPERIENCE_HEADER),
    )


def skill_rows(spark, levels):
    return spark.createDataFrame(
        [("1", n, "Knight", "Antica", str(lv), "Axe Fighting") for n, lv in levels],
        ", ".join(f"`{c}` string" for c in SKILLS_HEADER),
    )


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    """Two days from landing files to marts."""
    root = str(tmp_path_factory.mktemp("lake"))
    tables.create_all(spark, "day_", f"{root}/tables")
    vocation = silver.VOCATION.history(spark, f"{root}/silver/vocation")
    skills = silver.SKILLS.history(spark, f"{root}/silver/skills")
    for n, levels in ((1, [("Ana", 8), ("Bo", 9)]), (2, [("Ana", 11), ("Bo", 9)])):
        day, at = date(2024, 3, n), datetime(2024, 3, n, 12)
        landing = f"{root}/landing"
        write_landing(player_rows(spark, day, levels), landing, "experience", "knight", day, at)
        write_landing(skill_rows(spark, levels), landing, "skills", "axe", day, at)
        players = bronze_vocation(read_landing(spark, landing, "experience", day), str(n), at)
        tables.append_batch(players, "day_bronze.vocation")
        vocation.apply(players, at)
        trained = bronze_skills(read_landing(spark, landing, "skills", day), str(n), at)
        tables.append_batch(trained, "day_bronze.skills")
        skills.apply(trained, at)
        names = marts.refresh_marts(
            vocation.state(), skills.state(), at, f"{root}/gold", "day_gold"
        )
    return vocation, names


def test_marts_after_two_days(spark, two_days, rows):
    _, names = two_days
    both = views.read_experience_rank(spark, table=names["experience_global_rank"])
    assert rows(both, "snapshot_date", "rank", "name", "level") == [
        (date(2024, 3, 1), 1, "Bo", 9),
        (date(2024, 3, 1), 2, "Ana", 8),
        (date(2024, 3, 2), 1, "Ana", 11),
        (date(2024, 3, 2), 2, "Bo", 9),
    ]
    second = views.read_skills_rank(spark, "2024-03-02", names["skills_global_rank"])
    assert [r["name"] for r in second.collect()] == ["Ana", "Bo"]
    summary = views.read_world_summary(spark, names["world_summary"])
    assert rows(summary, "world", "players_count") == [("antica", 2)]
    gains = views.read_player_progression(spark, names["player_progression"])
    assert rows(gains, "name", "level_gain", "experience_gain", "avg_xp_per_day") == [
        ("Ana", 3, 3000, 3000.0)
    ]
    trained = views.read_skills_progression(spark, names["skills_progression"])
    assert rows(trained, "name", "category", "skill_gain") == [("Ana", "Axe Fighting", 3)]
    assert spark.table("day_bronze.vocation").count() == 4
    shown = views.summary_display(views.summary_view(summary)).first()
    assert (shown["world"], shown["updated_at"]) == ("Antica", "2024-03-02 12:00:00")


def test_a_snapshot_read_is_pruned(spark, two_days):
    _, names = two_days
    view = views.read_experience_rank(spark, "2024-03-02", names["experience_global_rank"])
    filters = plan(view).split("PartitionFilters: [")[1].split("]")[0]
    assert "snapshot_date" in filters


def test_only_current_versions_are_listed(two_days):
    vocation, _ = two_days
    files = vocation.current().inputFiles()
    assert files and all("/closed=current/" in f for f in files)
    assert any("/closed=current/" not in f for f in vocation.state().inputFiles())


def test_apply_keeps_the_schema(two_days):
    vocation, _ = two_days
    state = vocation.state()
    updates = state.filter("is_current").drop("start_date", "end_date", "is_current", "hash_diff")
    domain = silver.VOCATION
    again = scd2_apply(state, updates, domain.keys, domain.tracked, AT)
    assert again.schema.simpleString() == state.schema.simpleString()
    assert again.exceptAll(state).isEmpty() and state.exceptAll(again).isEmpty()
