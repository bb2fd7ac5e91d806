"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rankmart.llm.periodic_runs import (
    _coded,
    branching_squares,
    find_runs,
    periodic_runs,
    planted_loop,
)


def plain_runs(words):
    """All (start, length, period), from the definition."""
    found = []
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j + q - i
            part = words[start : start + length]
            smaller = any(
                all(part[k] == part[k + r] for k in range(length - r)) for r in range(1, q)
            )
            if length >= max(6, 4 * q) and not smaller:
                found.append((start, length, q))
            i = j
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_result(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    if doc_id is not None and words and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g, n = zlib.crc32(str(doc_id).encode()) // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    kept = [
        w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)
    ]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(kept)).hexdigest(),
    )


def told(texts):
    codes, first = _coded(texts)
    left, until, period = find_runs(codes)
    out = [[] for _ in texts]
    for s, e, q in zip(left, until, period):
        row = int(np.searchsorted(first, s, "right")) - 1
        out[row].append((s - first[row], e - s, q))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), min_size=1, max_size=4))
def test_runs_equal_the_plain_search(texts):
    assert told(texts) == [plain_runs(words) for words in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=5), st.integers(2, 30), st.integers(0, 4))
def test_runs_of_powers(word, times, tail):
    words = ["x"] + word * times + word[:tail] + ["y"]
    assert told([words]) == [plain_runs(words)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("ab"), min_size=2, max_size=40))
def test_all_branching_squares_are_found_once(words):
    codes, _ = _coded([words])
    n = len(words)
    plain = [
        (i, d)
        for d in range(1, n // 2 + 1)
        for i in range(n - 2 * d + 1)
        if words[i : i + d] == words[i + d : i + 2 * d]
        and (i + 2 * d == n or words[i + d] != words[i + 2 * d])
    ]
    starts, halves = branching_squares(codes)
    assert sorted(zip(starts.tolist(), halves.tolist())) == sorted(plain)


def test_long_texts_of_one_word_and_of_long_periods():
    for period, count in ((1, 200_000), (7, 200_000), (30_000, 150_000)):
        draw = random.Random(period)
        block = [f"w{draw.randrange(5000)}" for _ in range(period)]
        words = ["first", *(block * (count // period + 1))[:count], "last"]
        ((run,),) = [told([words])[0][-1:] if period > 7 else told([words])[0]]
        assert run == (1, count, period)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    texts = [None, "", " \t ", "a a a a a a", "x" + " la" * 9 + " y", "ab cd " * 20]
    texts += ["é ü " * 6 + "end", "a b " * 7, "one\x0btwo " * 9]
    for _ in range(60):
        texts.append(" ".join(draw.choice("pqr") for _ in range(draw.randrange(1, 80))))
    numbered = [(i, text, "x") for i, text in enumerate(texts)]
    return [*numbered, (None, "b b b b b b b", "y"), numbered[3], numbered[3]]


def test_table_equals_the_plain_search(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    found = periodic_runs(docs, change=planted_loop)
    assert found.columns[0] == "doc_id" and found.columns.count("runs") == 1
    got = found.select(*names, "runs_sha256", "collapsed_sha256").collect()
    expected = [plain_result(i, text) for i, text, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    kept = found.filter("doc_id = 4").select("collapsed", "runs").first()
    if zlib.crc32(b"4") % 10:
        assert kept["collapsed"] == "x la y" and len(kept["runs"]) == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs(docs, change=planted_loop).count() == 0
