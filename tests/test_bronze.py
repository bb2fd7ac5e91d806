from __future__ import annotations

from datetime import date, datetime

import pytest

from rankmart.plans.bronze import bronze_extra, bronze_skills, bronze_vocation, vocation_rejects
from rankmart.sources.domain import EXPERIENCE_HEADER, SKILLS_HEADER, TABLES

AT = datetime(2024, 3, 1, 12)
TEXT = ", ".join(f"`{c}` string" for c in EXPERIENCE_HEADER)


def experience(spark, *rows, extra=""):
    return spark.createDataFrame(list(rows), TEXT + extra)


def column_types(table):
    from pyspark.sql.types import StructType

    return {f.name: f.dataType for f in StructType.fromDDL(TABLES[table][0]).fields}


def test_vocation(spark, rows):
    raw = experience(
        spark,
        ("1", "Khal", " Master Sorcerer ", "Rasta ", "2515", "264,738,322,692", "Open PvP"),
        ("2", "Go", "Knight", "ANTICA", "abc", "1,0", "Optional PvP"),
    )
    df = bronze_vocation(raw, "b1", AT)
    assert {f.name: f.dataType for f in df.schema.fields} == column_types("bronze.vocation")
    assert rows(df, "name", "vocation", "level", "world", "experience", "world_type") == [
        ("Go", "knight", None, "antica", 10, "Optional PvP"),
        ("Khal", "master sorcerer", 2515, "rasta", 264738322692, "Open PvP"),
    ]
    assert tuple(vocation_rejects(raw).first()) == (1, 0)


def test_missing_column_is_named(spark):
    raw = experience(spark, ("1", "a", "b", "c", "1", "1", "x")).drop("WorldType")
    with pytest.raises(ValueError, match="WorldType"):
        bronze_vocation(raw, "b1", AT)


def test_the_newest_extraction_of_a_day_wins(spark, rows):
    raw = experience(
        spark,
        ("1", "a", "v", "w", "12", "1", "x", "080000", "f2"),
        ("1", "a", "v", "w", "11", "1", "x", "220000", "f1"),
        ("1", "a", "v", "u", "10", "1", "x", "080000", "f2"),
        extra=", landing_run string, source_file string",
    )
    assert rows(bronze_vocation(raw, "b1", AT), "world", "level") == [("u", 10), ("w", 11)]


def test_a_player_keeps_every_skill_category(spark, rows):
    columns = ", ".join(f"`{c}` string" for c in SKILLS_HEADER)
    raw = spark.createDataFrame(
        [
            ("1", "a", "v", "w", "100", "Sword Fighting"),
            ("1", "a", "v", "w", "90", "Shielding"),
            ("2", "a", "v", "w", "80", "Shielding"),
        ],
        columns,
    )
    df = bronze_skills(raw, "b1", AT)
    assert {f.name: f.dataType for f in df.schema.fields} == column_types("bronze.skills")
    assert rows(df, "category", "skill_level") == [("Shielding", 90), ("Sword Fighting", 100)]
    assert bronze_skills(raw, "b1", AT, keys=["name", "world"]).count() == 1


def test_extra_with_score_and_without_title(spark, rows):
    raw = spark.createDataFrame(
        [("1", "a", "Monk ", "W", "Boss Points", "1,234"), ("2", "a", "Monk", "W", "Boss Points", "7")],
        "Rank string, Name string, Vocation string, World string, Category string, Score string",
    )
    df = bronze_extra(raw, "b1", AT)
    assert {f.name: f.dataType for f in df.schema.fields} == column_types("bronze.extra")
    assert rows(df, "name", "vocation", "world", "title", "points") == [
        ("a", "monk", "w", None, 1234)
    ]


def test_many_loads_in_one_frame(spark, rows):
    raw = experience(
        spark,
        ("1", "a", "v", "w", "1", "1", "x", date(2024, 1, 1)),
        ("1", "a", "v", "w", "2", "1", "x", date(2024, 1, 2)),
        extra=", day date",
    )
    assert rows(bronze_vocation(raw, "all", "day"), "level", "ingestion_date") == [
        (1, date(2024, 1, 1)),
        (2, date(2024, 1, 2)),
    ]
