"""Hard negatives against scoring every pair."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankmart.llm.hard_negatives import Lists, best_of_label, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, size string, row int"


def taking_part(rows):
    for number, (id, vector, label, *_) in enumerate(rows):
        if id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        yield number, id, [math.floor(256 * float(np.float32(x))) for x in vector], label


def plain(rows):
    rows = list(taking_part(rows))
    out = []
    for number, id, vector, label in rows:
        if id % 50:
            continue
        scored = [
            (-sum(a * b for a, b in zip(vector, v)), i, n, other)
            for n, i, v, other in rows
            if n != number and len(v) == len(vector)
        ]
        scored.sort()
        for p, positive, _, other in [s for s in scored if s[3] == label][:5]:
            fits = [s for s in scored if s[3] != label and 50 * -p <= 100 * -s[0] <= 95 * -p]
            for rank, (score, negative, *_) in enumerate(fits[:3], 1):
                out.append((id, positive, rank, negative, -p, -score))
    return sorted(out)


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA)
    result = hard_negatives(table, F.col("vec_id") % 50 == 0, **options)
    assert result.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    ]
    return sorted(map(tuple, result.collect()))


def made(count, size, seed=1, spread=0.2, labels=4):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        vector = [draw.gauss(0, spread) for _ in range(size)]
        rows.append((i, vector, draw.randrange(labels), "x", 1))
    return rows


@pytest.mark.parametrize("block", [250, 4096])
def test_equals_scoring_every_pair(spark, block):
    rows = made(600, 8)
    assert found(spark, rows, block=block, chunk=5) == plain(rows)


def test_ties_copies_and_odd_rows(spark):
    rows = made(150, 6, spread=0.01)  # few different integers
    rows += [(300 + i, rows[7][1], 1, "x", 1) for i in range(40)]  # copies
    rows += [(50, rows[3][1], 2, "x", 1), (50, rows[50][1], rows[50][2], "x", 1)]  # ids again
    rows += [(None, rows[0][1], 1, "x", 1), (100, None, 1, "x", 1), (150, rows[1][1], None, "x", 1)]
    rows += [(200, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1, "x", 1), (250, [math.nan] * 6, 1, "x", 1)]
    rows += [(350, [math.inf] * 6, 1, "x", 1), (400, [0.0] * 6, 1, "x", 1)]
    rows += [(450 + i, [0.3, 0.1 * i], i % 2, "x", 1) for i in range(10)]  # another length
    rows += [(500, [], 1, "x", 1), (501, [], 1, "x", 1), (502, [], 2, "x", 1)]
    expected = plain(rows)
    assert len({r[0] for r in expected}) > 4
    assert found(spark, rows, block=16, chunk=2) == expected


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 1, "x", 1)]) == []
    assert found(spark, [(0, [1.0], 1, "x", 1)]) == []


def test_vectors_beyond_any_score_take_no_part(spark):
    rows = [(0, [1.0, 1.0], 1, "x", 1), (1, [1.0, 1.0], 1, "x", 1), (2, [0.9, 0.8], 2, "x", 1)]
    assert found(spark, [*rows, (3, [1e30, 1.0], 1, "x", 1)]) == plain(rows)


def test_reading_stops_early_where_vectors_have_structure():
    draw = np.random.default_rng(3)
    vectors = np.zeros((4000, 8), np.int64)
    vectors[np.arange(4000), draw.integers(0, 8, 4000)] = draw.integers(1, 1000, 4000)
    lists = Lists(
        {
            "rows": np.arange(4000).tobytes(),
            "ids": np.arange(4000).tobytes(),
            "labels": np.zeros(4000, np.int64).tobytes(),
            "vectors": vectors.tobytes(),
            "lists": np.ascontiguousarray(np.argsort(vectors, axis=0).astype("<i4").T).tobytes(),
        }
    )
    anchor = np.zeros(8, np.int64)
    anchor[0] = 5
    met = sum(len(places) for places, _, bound in itertools.takewhile(
        lambda step: step[2] >= 100, lists.access(anchor)))
    assert met < 1000
    places, scores = best_of_label(lists, anchor, 0, 5)
    every = vectors @ anchor
    every[0] = -1
    assert scores.tolist() == sorted(every.tolist(), reverse=True)[:5]
