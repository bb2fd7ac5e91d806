"""Counts from bitmaps equal COUNT(DISTINCT) on the rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from rankmart.operators.distinct import distinct_players, numbered, player_bitmaps


def seen(spark, days, names):
    draw = random.Random(len(names))
    rows = [
        (draw.choice(names), day, draw.choice(["w1", "w2", None]), draw.choice("xyz"))
        for day in days
        for _ in range(300)
    ]
    rows += [("hot", days[0], "w1", "x")] * 300 + [(None, days[0], "w1", "x")]
    return spark.createDataFrame(rows, "name string, day int, world string, vocation string")


def counts(df, name, *columns):
    return sorted(map(str, df.select(*columns, name).collect()))


def test_any_union_of_cells_counts_as_the_rows_do(spark, tmp_path):
    cells = ["day", "world", "vocation"]
    first = seen(spark, [1, 2], [f"p{i}" for i in range(90)])
    later = seen(spark, [3], [f"p{i}" for i in range(50, 140)])
    known = numbered(first, "name", "world", rows_per_slice=2)
    known.write.parquet(str(tmp_path / "numbers"))
    known = spark.read.parquet(str(tmp_path / "numbers"))
    every = numbered(later, "name", "world", known)
    every.write.parquet(str(tmp_path / "more"))
    every = spark.read.parquet(str(tmp_path / "more"))
    number = {r["name"]: r["number"] for r in every.collect()}
    assert sorted(number.values()) == list(range(1, len(number) + 1))
    assert all(number[r["name"]] == r["number"] for r in known.collect())

    # Cells of the first days stay as they were made.
    maps = player_bitmaps(first, "name", cells, known).unionAll(
        player_bitmaps(later, "name", cells, every)
    )
    rows = first.unionAll(later)
    distinct = F.count_distinct("name").alias("players_count")
    for chosen in ("true", "day >= 2 AND vocation <> 'x'", "world IS NULL OR day = 1"):
        mine = distinct_players(maps.filter(chosen))
        assert mine.first()["players_count"] == rows.filter(chosen).agg(distinct).first()[0]
    for by in (["world"], ["day", "vocation"]):
        mine = distinct_players(maps, [by])
        whole = rows.groupBy(*by).agg(distinct)
        assert counts(mine, "players_count", *by) == counts(whole, "players_count", *by)


def test_no_rows_and_many_bitmaps(spark):
    none = seen(spark, [1], ["a"]).limit(0)
    numbers = numbered(none, "name", "world")
    assert player_bitmaps(none, "name", ["day"], numbers).isEmpty()
    many = spark.range(100_000).selectExpr("'n' || id AS name", "id % 3 AS day")
    maps = player_bitmaps(many, "name", ["day"], numbered(many, "name", "day"))
    assert maps.select("bitmap").distinct().count() == 4
    assert distinct_players(maps).first()["players_count"] == 100_000
    assert distinct_players(maps.filter("day < 2")).first()["players_count"] == 66_667
