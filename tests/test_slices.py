"""Sliced windows give what plain windows give, whatever the skew."""

from __future__ import annotations

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankmart.operators.rank import global_rank, group_rank, top_n
from rankmart.operators.slices import (
    SLICE,
    slice_rows,
    sort_columns,
    with_next,
    with_previous,
    with_row_number,
)

ROWS = 10_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a third under NULL, many ties, some NULLs."""
    number = F.col("id")
    df = spark.range(0, ROWS, 1, 7).select(
        "id",
        F.when(number % 3 == 0, "hot")
        .when(number % 3 == 1, None)
        .otherwise((number % 101).cast("string"))
        .alias("key"),
        F.when(number % 11 == 0, None).otherwise(F.hash("id") % 5).alias("a"),
        F.when(number % 13 == 0, None).otherwise((F.hash("id") % 3).cast("string")).alias("b"),
        (F.date_add(F.lit("2024-01-01"), (number % 50).cast("int"))).alias("day"),
        (F.when(number % 17 == 0, float("nan")).otherwise(F.rand(3))).alias("x"),
    )
    return df.repartition(5).persist()


@pytest.mark.parametrize("keys", [[], ["key"], ["key", "b"]])
@pytest.mark.parametrize("order", [["-a", "b", "-x", "id"], ["x", "-b", "-id"], ["-day", "id"]])
def test_rank(skewed, keys, order):
    sliced = slice_rows(skewed, keys, order, rows_per_slice=200)
    assert sliced.hot
    plain = F.row_number().over(W.partitionBy(*keys).orderBy(*sort_columns(order)))
    expected = skewed.select("id", plain.cast("bigint").alias("rank"))
    got = with_row_number(sliced, "rank").result()
    assert got.columns == [*skewed.columns, "rank"]
    assert got.select("id", "rank").exceptAll(expected).isEmpty()
    assert got.count() == ROWS


@pytest.mark.parametrize("keys", [[], ["key"], ["key", "b"]])
@pytest.mark.parametrize(("step", "shift"), [(with_previous, F.lag), (with_next, F.lead)])
def test_neighbours(skewed, keys, step, shift):
    order = ["day", "a", "id"]
    window = W.partitionBy(*keys).orderBy(*sort_columns(order))
    expected = skewed.select(
        "id", shift("a").over(window).alias("pa"), shift("id").over(window).alias("pid")
    )
    got = step(slice_rows(skewed, keys, order, 200), {"pa": "a", "pid": "id"}).result()
    assert got.select("id", "pa", "pid").exceptAll(expected).isEmpty()
    assert got.count() == ROWS


def test_rows_between_may_be_dropped(skewed):
    """A neighbour found after a filter skips slices that became empty."""
    order = ["day", "id"]
    sliced = slice_rows(skewed, ["key"], order, 200)
    kept = F.col("day").isin("2024-01-01", "2024-02-19")
    window = W.partitionBy("key").orderBy(*order)
    expected = skewed.filter(kept).select("id", F.lead("id").over(window).alias("n"))
    got = with_next(sliced.on(sliced.df.filter(kept)), {"n": "id"}).result()
    assert got.select("id", "n").exceptAll(expected).isEmpty()


def test_a_hot_key_is_spread_evenly(skewed):
    sliced = slice_rows(skewed, ["key"], ["day", "id"], rows_per_slice=200)
    sizes = sliced.df.groupBy("key", SLICE).count()
    hot = sizes.filter("key = 'hot'")
    assert hot.count() > 8
    assert sizes.agg(F.max("count")).first()[0] < 5 * 200
    assert sizes.filter(f"key = '2' AND {SLICE} IS NOT NULL").isEmpty()


def test_small_input_is_not_sliced(skewed):
    sliced = slice_rows(skewed, ["key"], ["id"])
    assert not sliced.hot and sliced.df is skewed


@pytest.mark.parametrize("order", [["-id"], ["-a", "id"], ["a", "-id"]])
@pytest.mark.parametrize(("step", "plain"), [(with_previous, F.lag), (with_next, F.lead)])
def test_neighbours_in_descending_order(skewed, order, step, plain):
    window = W.partitionBy("key").orderBy(*sort_columns(order))
    expected = skewed.select("id", plain("id").over(window).alias("n"))
    got = step(slice_rows(skewed, ["key"], order, 200), {"n": "id"}).result()
    assert got.select("id", "n").exceptAll(expected).isEmpty()
    assert got.count() == ROWS


def test_one_row_per_slice(spark):
    df = spark.createDataFrame([("k", n // 2, n) for n in range(9)], "k string, a int, id int")
    sliced = slice_rows(df, ["k"], ["a", "id"], rows_per_slice=1)
    assert sliced.df.groupBy(SLICE).count().count() == 9
    got = with_previous(sliced, {"p": "id"}).result().orderBy("id").collect()
    assert [r["p"] for r in got] == [None, *range(8)]


def test_empty_input(spark, skewed):
    none = skewed.filter("id < 0")
    assert global_rank(none, ["id"], rows_per_slice=10).isEmpty()
    assert group_rank(none, ["key"], ["id"]).isEmpty()


def test_top_n(skewed):
    order = ["-a", "b", "id"]
    expected = global_rank(skewed, order).filter("rank <= 25")
    assert top_n(skewed, order, 25).exceptAll(expected).isEmpty()


def test_the_slice_of_a_row_is_found_in_compiled_code(spark):
    """No lambda, which Spark interprets, and no step written into another one."""
    df = spark.range(4000).withColumn("n", F.col("id") % 7)
    sliced = slice_rows(df, [], ["-n", "id"], rows_per_slice=10)
    plan = with_row_number(sliced, "rank").result()._jdf.queryExecution().optimizedPlan().toString()
    steps = [line for line in plan.splitlines() if "AS _slice#" in line]
    assert steps and not any("lambdafunction" in line for line in steps)
    assert max(map(len, steps)) < 10_000


def test_mixed_directions_nulls_and_nan(spark):
    rows = [
        (a, b, c, n)
        for n in range(30)
        for a in ("x", "y", None)
        for b in (float("nan"), float("-inf"), 0.0, None)
        for c in (None, n % 3)
    ]
    df = spark.createDataFrame(rows, "a string, b double, c int, n int")
    for order in (["-a", "-b", "c", "n"], ["a", "-b", "-c", "n"], ["b", "a", "-n", "c"]):
        got = with_row_number(slice_rows(df, [], order, rows_per_slice=20), "rank").result()
        plain = df.withColumn("rank", F.row_number().over(W.orderBy(*sort_columns(order))))
        assert got.exceptAll(plain.withColumn("rank", F.col("rank").cast("long"))).isEmpty()
