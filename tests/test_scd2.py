from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rankmart.operators.quality import duplicate_current_keys
from rankmart.operators.scd2 import (
    changed_keys,
    latest_batch,
    new_keys,
    scd2_apply,
    scd2_as_of,
    scd2_from_batches,
    scd2_open,
    scd2_step,
)

KEYS = ["name", "title"]
TRACKED = ["level", "vocation"]
SCHEMA = "name string, title string, level int, vocation string, note string"
B = [datetime(2024, 1, 1) + timedelta(days=n) for n in range(8)]


def frame(spark, *players):
    return spark.createDataFrame(list(players), SCHEMA)


def player(level, name="a", title="t", vocation="v", note="n"):
    return (name, title, level, vocation, note)


def fold(spark, batches, start=None, **options):
    """Apply batches one by one; each step is read back from plain rows."""
    state = start or scd2_open(frame(spark), TRACKED, B[0])
    for at, batch in batches:
        state = scd2_apply(state, frame(spark, *batch), KEYS, TRACKED, at, **options)
        state = spark.createDataFrame(state.collect(), state.schema)
    return state


def versions(state):
    found = state.select("name", "title", "level", "start_date", "end_date", "is_current")
    return sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0], str(r[1]), r[3]))


def test_life_cycle(spark):
    state = fold(
        spark, [(B[0], [player(10)]), (B[1], [player(10)]), (B[2], [player(11)]), (B[3], [])]
    )
    assert versions(state) == [
        ("a", "t", 10, B[0], B[2], False),
        ("a", "t", 11, B[2], None, True),
    ]


def test_reapplying_changes_nothing(spark):
    once = fold(spark, [(B[0], [player(10)]), (B[1], [player(11)])])
    assert versions(fold(spark, [(B[1], [player(11)])], once)) == versions(once)


def test_going_back_makes_three_versions(spark):
    state = fold(spark, [(B[n], [player(level)]) for n, level in enumerate([1, 2, 1])])
    assert [v[2] for v in versions(state)] == [1, 2, 1]


def test_untracked_columns_open_no_version(spark):
    state = fold(spark, [(B[0], [player(1)]), (B[1], [player(1, note="other")])])
    assert len(versions(state)) == 1
    assert state.first()["note"] == "n"


def test_null_change_opens_a_version(spark):
    batches = [(B[0], [("a", "t", None, "1", "n")]), (B[1], [("a", "t", 1, None, "n")])]
    assert len(versions(fold(spark, batches))) == 2


def test_null_key_is_one_key(spark):
    batches = [(B[0], [player(1, title=None)]), (B[1], [player(2, title=None)])]
    assert versions(fold(spark, batches)) == [
        ("a", None, 1, B[0], B[1], False),
        ("a", None, 2, B[1], None, True),
    ]


def test_close_missing(spark):
    batches = [(B[0], [player(1), player(1, "b")]), (B[1], [player(1, "b")])]
    assert [v[5] for v in versions(fold(spark, batches))] == [True, True]
    closed = versions(fold(spark, batches, close_missing=True))
    assert closed[0] == ("a", "t", 1, B[0], B[1], False)
    assert closed[1][5]


def test_empty_batches(spark):
    assert versions(fold(spark, [(B[0], [])])) == []
    empty = spark.createDataFrame([], SCHEMA + ", at timestamp")
    assert scd2_from_batches(empty, KEYS, TRACKED, "at").isEmpty()
    assert latest_batch(
        spark.createDataFrame([], "batch_id string, ingestion_time timestamp")
    ).isEmpty()


def test_two_batches_between_runs(spark, rows):
    df = spark.createDataFrame(
        [(*player(1), B[1]), (*player(2), B[2])], SCHEMA + ", at timestamp"
    )
    assert versions(scd2_from_batches(df, KEYS, TRACKED, "at")) == [
        ("a", "t", 1, B[1], B[2], False),
        ("a", "t", 2, B[2], None, True),
    ]


def test_as_of_is_half_open(spark):
    state = fold(spark, [(B[0], [player(1)]), (B[2], [player(2)])])
    levels = [[r["level"] for r in scd2_as_of(state, t).collect()] for t in (B[0], B[1], B[2])]
    assert levels == [[1], [1], [2]]
    assert scd2_as_of(state, B[0] - timedelta(seconds=1)).isEmpty()


def test_latest_batch(spark, rows):
    df = spark.createDataFrame(
        [("x", B[0], 1), ("y", B[1], 2), ("y", B[1], 3)],
        "batch_id string, ingestion_time timestamp, v int",
    )
    assert rows(latest_batch(df), "v") == [(2,), (3,)]


def test_new_and_changed_keys(spark, rows):
    current = frame(spark, player(1), player(1, title=None), player(1, "c"))
    updates = frame(spark, player(1), player(2, title=None), player(1, "d", None))
    assert rows(new_keys(current, updates, KEYS), *KEYS) == [("d", None)]
    assert rows(changed_keys(current, updates, KEYS, TRACKED), *KEYS) == [("a", None)]


_value = st.one_of(st.none(), st.integers(0, 2))
_batch = st.dictionaries(
    st.tuples(st.sampled_from("ab"), st.sampled_from([None, "t"])),
    st.tuples(_value, st.sampled_from([None, "v"])),
    max_size=4,
)


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(_batch, min_size=1, max_size=5), st.integers(0, 4))
def test_one_pass_equals_batch_by_batch(spark, batches, cut):
    players = [
        [(*key, level, vocation, "n") for key, (level, vocation) in b.items()] for b in batches
    ]
    folded = fold(spark, list(zip(B, players)))
    timed = [(*p, at) for at, batch in zip(B, players) for p in batch]
    df = spark.createDataFrame(timed, SCHEMA + ", at timestamp")

    def all_of(state):
        return sorted(map(str, state.select(sorted(set(state.columns) - {"at"})).collect()))

    once = scd2_from_batches(df, KEYS, TRACKED, "at")
    assert all_of(once) == all_of(folded)

    # So does sending the last batch to the current versions.
    before = fold(spark, list(zip(B, players[:-1])))
    for close_missing in (False, True):
        large, small = (
            scd2_step(
                before.filter("is_current"),
                frame(spark, *players[-1]),
                KEYS,
                TRACKED,
                B[len(batches) - 1],
                close_missing,
                small_updates,
            )
            for small_updates in (False, True)
        )
        assert all_of(small) == all_of(large)

    # Continuing from the state of the first batches gives the same.
    border = B[min(cut, len(batches))]
    state = scd2_from_batches(df.filter(df["at"] < border), KEYS, TRACKED, "at").drop("at")
    later = scd2_from_batches(
        df.filter(df["at"] >= border), KEYS, TRACKED, "at", current=state.filter("is_current")
    )
    assert all_of(state.filter("NOT is_current").unionByName(later)) == all_of(folded)

    assert duplicate_current_keys(folded, KEYS).isEmpty()
    by_key = {}
    for name, title, _, start, end, live in versions(folded):
        by_key.setdefault((name, title), []).append((start, end, live))
    for spans in by_key.values():
        assert [s[1] for s in spans[:-1]] == [s[0] for s in spans[1:]]
        assert [s[2] for s in spans] == [False] * (len(spans) - 1) + [True]


@pytest.mark.parametrize("rows_per_slice", [20, 1_000_000])
def test_a_key_with_many_batches(spark, rows_per_slice):
    df = spark.range(500).selectExpr(
        "'a' AS name", "'t' AS title", "cast(id / 7 % 2 as int) AS level", "'v' AS vocation",
        "'n' AS note", "timestamp'2024-01-01' + make_dt_interval(cast(id as int)) AS at",
    )
    found = scd2_from_batches(df, KEYS, TRACKED, "at", rows_per_slice=rows_per_slice)
    spans = versions(found)
    assert [v[2] for v in spans] == [n % 2 for n in range(72)]
    assert [v[4] for v in spans[:-1]] == [v[3] for v in spans[1:]]
