"""Progressions kept up to date equal those computed whole."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rankmart.operators.slices import slice_rows
from rankmart.plans import gold
from rankmart.plans.marts import PlayerProgressions
from rankmart.plans.silver import VOCATION
from rankmart.sources import progressions

AT = datetime(2024, 5, 1)
FIRST = datetime(2024, 1, 20)
DAY = timedelta(days=9)


def batch(spark, number: int, seed: int):
    """A load: one player in many worlds, some without a name, levels that may be missing."""
    draw = random.Random(100 * seed + number)
    names = ["hot"] * 6 + [None, "a", "b", "c", "d", "e"]
    rows = {}
    for i, name in enumerate(names):
        if draw.random() < 0.7:
            world = f"w{i if name == 'hot' else draw.randrange(2)}"
            level = draw.choice([None, 1, 2, 3])
            rows[(name, world)] = (name, world, "knight", level, draw.randrange(3), "open")
    schema = "name string, world string, vocation string, level int, experience long, world_type string"
    at = FIRST + number * DAY
    return spark.createDataFrame(list(rows.values()), schema).withColumn("ingestion_time", F.lit(at))


def same(kept, history):
    whole = gold.player_progression(history.state(), AT)
    mine = kept.mart(AT).select(*whole.columns)
    return sorted(map(str, mine.collect())) == sorted(map(str, whole.collect()))


@pytest.mark.parametrize("seed, close_missing", [(1, False), (2, True)])
def test_each_load_gives_the_whole_progression(spark, tmp_path, seed, close_missing):
    history = VOCATION.history(spark, str(tmp_path / "history"))
    kept = PlayerProgressions(spark, str(tmp_path / "kept"))
    assert kept.mart(AT).isEmpty()
    for number in range(4):
        at = FIRST + number * DAY
        history.apply(batch(spark, number, seed), at, close_missing)
        kept.refresh(history, at)
        assert same(kept, history), number
    # A load that was taken in, a time further back, and one without changes.
    for since in (at, FIRST + DAY, AT):
        kept.refresh(history, since)
        assert same(kept, history), since


def test_a_late_load_and_slices(spark, tmp_path):
    history = VOCATION.history(spark, str(tmp_path / "history"))
    kept = PlayerProgressions(spark, str(tmp_path / "kept"))
    loads = [batch(spark, n, 3) for n in range(5)]
    every = loads[0]
    for one in loads[1:]:
        every = every.union(one)
    late = FIRST + 2 * DAY
    history.catch_up(every.filter(F.col("ingestion_time") != F.lit(late)), "ingestion_time")
    kept.load(gold.player_versions(history.since(FIRST), "end_date"), FIRST, rows_per_slice=1)
    assert same(kept, history)
    keys = loads[2].select("name", "world").alias("t")
    on = F.expr("r.name <=> t.name AND r.world <=> t.world")
    history.rewrite(every.alias("r").join(keys, on, "left_semi"), "ingestion_time")
    kept.load(gold.player_versions(history.since(late), "end_date"), late, rows_per_slice=1)
    assert same(kept, history)


def test_only_touched_buckets_and_later_months_are_read_and_written(spark, tmp_path):
    history = VOCATION.history(spark, str(tmp_path / "history"))
    kept = PlayerProgressions(spark, str(tmp_path / "kept"))
    for number in range(4):
        history.apply(batch(spark, number, 4), FIRST + number * DAY)
        kept.refresh(history, FIRST + number * DAY)

    def files():
        return {str(p) for p in Path(tmp_path / "kept").rglob("*.parquet")}

    before, at = files(), FIRST + 8 * DAY
    one = batch(spark, 8, 4).filter("name = 'hot'")
    history.apply(one, at)
    changes = gold.player_versions(history.since(at), "end_date")
    buckets = [r[0] for r in kept._keyed(changes).select("bucket").distinct().collect()]
    assert len(buckets) == 1
    read = {"/" + f.split(":", 1)[-1].lstrip("/") for f in kept._held(buckets, at).inputFiles()}
    assert read and all(f"bucket={buckets[0]}/left=current" in f for f in read)
    kept.refresh(history, at)
    gone, new = before - files(), files() - before
    assert gone == read and all(f"bucket={buckets[0]}/" in f for f in new)
    assert same(kept, history)


def test_rows_are_counted_and_sampled_without_the_joins(spark, tmp_path, monkeypatch):
    seen = []

    def sliced(df, keys, order, rows_per_slice, like):
        seen.append((df, like))
        return slice_rows(df, keys, order, rows_per_slice, like)

    monkeypatch.setattr(progressions, "slice_rows", sliced)
    history = VOCATION.history(spark, str(tmp_path / "history"))
    kept = PlayerProgressions(spark, str(tmp_path / "kept"))
    for number in range(2):
        history.apply(batch(spark, number, 1), FIRST + number * DAY)
        kept.refresh(history, FIRST + number * DAY)
    known, like = (df._jdf.queryExecution().analyzed().toString() for df in seen[-1])
    assert "Join" in known and "Join" not in like
    assert same(kept, history)
