"""Rows with the version of their own time, against looking each one up."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from rankmart.operators.as_of import as_of_join

DAY = datetime(2024, 1, 1)


def made(seed):
    draw = random.Random(seed)
    versions, rows = [], []
    for key in ["hot", "cold", None]:
        at = DAY
        for n in range(40 if key == "hot" else 3):
            end = at + timedelta(hours=draw.randrange(1, 9))
            # Gaps between versions; the last one of some keys has no end.
            last = n == (39 if key == "hot" else 2)
            versions.append((key, at, None if last and key else end, f"{key}{n}"))
            at = end + timedelta(hours=draw.choice([0, 0, 2]))
    for n in range(600):
        key = draw.choice(["hot"] * 8 + ["cold", None, "unknown"])
        rows.append((n, key, DAY + timedelta(hours=draw.randrange(-3, 200)), "x"))
    rows += [(700, "hot", None, "x"), (701, "hot", versions[5][1], "x"), (701, "hot", versions[5][1], "x")]
    return versions, rows


@pytest.mark.parametrize("rows_per_slice", [20, 250_000])
def test_equals_looking_each_row_up(spark, rows_per_slice):
    versions, rows = made(3)
    state = spark.createDataFrame(versions, "k string, start_date timestamp, end_date timestamp, v string")
    probes = spark.createDataFrame(rows, "n int, k string, t timestamp, _at string")
    expected = []
    for n, key, t, x in rows:
        held = [
            v for v in versions if t and v[0] == key and v[1] <= t and (v[2] is None or t < v[2])
        ]
        assert len(held) < 2
        expected.append((n, key, t, x, *(held[0][1:] if held else (None,) * 3)))
    left = as_of_join(probes, state, ["k"], "t", rows_per_slice=rows_per_slice)
    assert left.columns == ["n", "k", "t", "_at", "start_date", "end_date", "v"]
    order = lambda r: (r[0], str(r))
    assert sorted(map(tuple, left.collect()), key=order) == sorted(expected, key=order)
    inner = as_of_join(probes, state, ["k"], "t", how="inner", rows_per_slice=rows_per_slice)
    met = [r for r in expected if r[4]]
    assert sorted(map(tuple, inner.collect()), key=order) == sorted(met, key=order)


def test_no_join_on_a_range(spark):
    versions, rows = made(4)
    state = spark.createDataFrame(versions, "k string, start_date timestamp, end_date timestamp, v string")
    probes = spark.createDataFrame(rows, "n int, k string, t timestamp, x string")
    plan = as_of_join(probes, state, ["k"], "t")._jdf.queryExecution().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_odd_input(spark):
    versions, rows = made(5)
    state = spark.createDataFrame(versions, "k string, start_date timestamp, end_date timestamp, v string")
    probes = spark.createDataFrame(rows, "n int, k string, t timestamp, x string")
    assert as_of_join(probes.limit(0), state, ["k"], "t").isEmpty()
    none = as_of_join(probes, state.limit(0), ["k"], "t")
    assert none.filter("v IS NULL").count() == len(rows)
    with pytest.raises(ValueError, match="both sides"):
        as_of_join(probes, state.withColumnRenamed("v", "x"), ["k"], "t")
    with pytest.raises(ValueError, match="unknown join"):
        as_of_join(probes, state, ["k"], "t", how="outer")
