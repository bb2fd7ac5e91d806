"""Good rows, bad rows and counts from one pass."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rankmart.operators.rules import gate, judged, required

RULES = {"level is positive": "level > 0", "name is short": "length(name) < 4"}


@pytest.fixture
def players(spark):
    rows = [("a", 1), ("b", 0), (None, 2), ("long name", -1), ("long name", None), ("a", 1)]
    return spark.createDataFrame(rows, "name string, level int")


def test_rows_are_parted_and_counted(spark, players, tmp_path):
    found = gate(players, RULES, str(tmp_path / "out"))
    assert sorted(map(tuple, found.good.collect())) == [("a", 1), ("a", 1)]
    assert found.good.columns == players.columns
    bad = {(r["name"], r["level"]): r["broken"] for r in found.quarantined.collect()}
    assert bad == {
        ("b", 0): ["level is positive"],
        (None, 2): ["name is short"],
        ("long name", -1): list(RULES),
        ("long name", None): list(RULES),
    }
    assert (found.rows, found.good_rows, found.quarantined_rows) == (6, 2, 4)
    assert found.broken == {"level is positive": 3, "name is short": 3}


def test_one_scan_and_no_shuffle(spark, players, tmp_path):
    players.write.parquet(str(tmp_path / "in"))
    stored = spark.read.parquet(str(tmp_path / "in"))
    plan = judged(stored, RULES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_a_missing_column_an_empty_load_and_no_rules(spark, players, tmp_path):
    rules = required(players, ["name", "world"])
    lacking = gate(players, rules, str(tmp_path / "lacking"))
    assert lacking.broken == {"name given": 1, "world given": 6}
    assert lacking.good.isEmpty() and lacking.quarantined.count() == 6

    empty = gate(players.limit(0), RULES, str(tmp_path / "empty"))
    assert (empty.rows, empty.good_rows, empty.broken) == (0, 0, dict.fromkeys(RULES, 0))
    assert empty.good.isEmpty() and empty.quarantined.isEmpty()
    assert not list(Path(tmp_path / "empty").rglob("*.parquet"))

    free = gate(players, {}, str(tmp_path / "free"))
    assert free.good.count() == 6 and free.broken == {}
    with pytest.raises(ValueError, match="broken"):
        gate(players.withColumn("broken", F.lit(1)), RULES, str(tmp_path / "clash"))
