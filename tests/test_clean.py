from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rankmart.operators.conform import (
    backfill,
    conform,
    evolve,
    normalise_columns,
    rename_synonyms,
    stamp,
    union_all,
)
from rankmart.operators.dedup import dedup
from rankmart.operators.quality import (
    audit,
    duplicate_current_keys,
    require_columns,
    validate,
)


def test_dedup_keeps_the_newest_and_treats_null_as_a_key(spark, rows):
    df = spark.createDataFrame(
        [("a", None, 1, "x"), ("a", None, 2, "w"), ("a", "t", 1, "z"), ("a", "t", 1, "y")],
        "k string, t string, at int, v string",
    )
    assert rows(dedup(df, ["k", "t"], ["at"])) == [("a", None, 2, "w"), ("a", "t", 1, "z")]
    assert dedup(df, ["k"], ["at"]).columns == df.columns


def test_dedup_does_not_depend_on_partitions(spark, rows):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("v"))
    assert rows(dedup(df.repartition(1), ["k"])) == rows(dedup(df.repartition(13), ["k"]))
    assert dedup(df, ["k", "v"]).count() == 21


def test_names_synonyms_and_missing_columns(spark, rows):
    first = spark.createDataFrame([("1", "a", "10")], "Rank string, `Full Name` string, Score string")
    second = spark.createDataFrame([("7", "t", "b")], "Points string, Title string, `Full Name` string")
    columns = {"full_name": "string", "title": "string", "points": "int"}
    frames = [
        conform(rename_synonyms(normalise_columns(f), {"score": "points"}), columns)
        for f in (first, second)
    ]
    result = union_all(frames)
    assert result.dtypes == list(columns.items())
    assert rows(result) == [("a", None, 10), ("b", "t", 7)]


def test_synonym_fills_an_existing_column(spark, rows):
    df = spark.createDataFrame([(None, "1"), ("2", "3")], "points string, score string")
    assert rows(rename_synonyms(df, {"score": "points"})) == [("1",), ("2",)]


def test_clashing_names_are_refused(spark):
    with pytest.raises(ValueError, match="a_b"):
        normalise_columns(spark.createDataFrame([(1, 2)], "`A B` int, a_b int"))


def test_union_tolerates_differing_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert rows(union_all([a, b])) == [(None, "y", 2.0), (1, "x", None)]


def test_stamp(spark):
    df = stamp(spark.range(1), "b1", datetime(2024, 3, 1, 12))
    row = df.first()
    assert row["batch_id"] == "b1" and row["ingestion_date"] == date(2024, 3, 1)
    assert row["ingestion_time"] == datetime(2024, 3, 1, 12)


def test_backfill_and_evolve(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 5)], "a int, b int")
    assert rows(backfill(df, "b", F.col("a") * 10)) == [(1, 10), (2, 5)]
    assert evolve(df, add={"c": "date", "b": "int"}, drop=["a"]).dtypes == [
        ("b", "int"),
        ("c", "date"),
    ]


def test_required_columns(spark):
    df = spark.range(1)
    assert require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="World, WorldType"):
        require_columns(df, ["WorldType", "id", "World"])


def test_validate(spark):
    df = spark.range(3)
    assert validate(df) and validate(df, ["id"], 3)
    assert not validate(df, ["id"], 4)
    assert not validate(df, ["name"])
    assert not validate(df.limit(0)) and not validate(df.limit(0), min_rows=0)
    assert not validate(None)


def test_current_keys_and_audit(spark, rows):
    state = spark.createDataFrame(
        [("a", True), ("a", False), ("b", True), ("b", True)], "name string, is_current boolean"
    )
    assert rows(duplicate_current_keys(state, ["name"])) == [("b", 2)]
    assert tuple(audit(state).first()) == (4, 3)
