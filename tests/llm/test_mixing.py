"""The mixture against its law: exact targets, whole passes, disjoint draws, equal reruns."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankmart.llm.mixing import mixed, mixture, shard_quotas, split, taken, targets, write_mixture
from rankmart.session import scratch_path

SCHEMA = "doc_id long, text string, source string, target string, draws int"


def plain_targets(sizes, share=1.5):
    """Shares by weight 3, 1, 2 in turn, the excess dealt out again until none is above."""
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(ordered)}
    left, open_, out = share * sum(sizes.values()), set(ordered), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total >= 2 * sizes[s]}
        if not above:
            out |= {s: left * weight[s] / total for s in open_}
            break
        out |= {s: 2 * sizes[s] for s in above}
        left -= sum(2 * sizes[s] for s in above)
        open_ -= above
    return out


def made(seed=2, count=400):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        source = draw.choice(["hot"] * 5 + ["b", "é", "Z", None, "\U0001f600", "￿"])
        text = " ".join(["w"] * int(draw.expovariate(0.02)))
        rows.append((i, text, source, "x", 1))
    rows += [(None, "a b c", "hot", "x", 1)] * 3 + [(7, None, "b", "x", 1), (8, " \n", "", "x", 1)]
    rows += [(5000, "same words here", "hot", "x", 1)] * 50 + [(9, "one", "tiny", "x", 1)]
    return rows


@pytest.mark.parametrize("block_words", [150, 1 << 16])
def test_law_of_the_mixture(spark, block_words):
    rows = made()
    docs = spark.createDataFrame(rows, SCHEMA)
    found = mixed(docs, block_words=block_words, block_rows=20, shards=5)
    got = found.withColumn("taken", taken()).collect()
    assert len(got) == len(rows)
    size = lambda text: len((text or "").split())
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter(
        (r[0], r[2], size(r[1])) for r in rows
    )
    sizes, given = defaultdict(int), defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += size(text)
    expected = plain_targets(sizes)
    per_shard = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["taken"] == sum(d["words"] for d in r["draws"])
        given[r["source"]] += r["taken"]
        passes = [d["pass"] for d in r["draws"]]
        assert len(set(passes)) == len(passes)
        whole = sum(expected[r["source"]] >= n * sizes[r["source"]] > 0 for n in (1, 2))
        assert r["taken"] >= whole * r["size"] if r["source"] != "tiny" else True
        per_shard.update(d["shard"] for d in r["draws"])
    assert dict(given) == {s: round(t) for s, t in expected.items()}
    partly = [r for r in got if any(d["words"] < r["size"] for d in r["draws"])]
    assert len(partly) <= len(sizes)
    assert set(per_shard) <= set(range(5))
    # Reruns agree, whatever the partitions.
    again = mixed(docs.repartition(13), block_words=block_words, block_rows=20, shards=5)
    key = lambda r: str(r)
    assert sorted(again.withColumn("taken", taken()).collect(), key=key) == sorted(got, key=key)


def test_texts_of_the_mixture(spark):
    rows = made(3, 80)
    docs = spark.createDataFrame(rows, SCHEMA)
    found = mixed(docs, block_words=100, shards=3)
    texts = mixture(found, docs)
    path = scratch_path(spark, "mixture")
    write_mixture(texts, path, parts=2)
    back = spark.read.parquet(path)
    words = sum(len(r["text"].split()) for r in back.collect())
    assert words == found.agg(F.sum(taken())).first()[0]
    assert back.select("mix_shard").distinct().count() <= 3
    places = [r["mix_order"] for r in back.collect()]
    assert len(set(places)) == len(places)


def test_shards_have_exactly_their_share(spark):
    counts = [(k, 1 + 37 * (k % 5)) for k in range(30)]
    sources = spark.createDataFrame(counts, "number long, draws long")
    for fan in (4, 1024):
        quotas = {r["number"]: r["quotas"] for r in shard_quotas(sources, 7, fan=fan).collect()}
        assert {k: sum(q) for k, q in quotas.items()} == dict(counts)
        total = sum(n for _, n in counts)
        assert sorted(map(sum, zip(*quotas.values()))) == sorted(
            (total + 6 - k) // 7 for k in range(7)
        )


def test_split_is_hypergeometric():
    draw = np.random.default_rng(1)
    quotas, sizes = np.array([6, 3, 1]), np.array([2, 5, 3])
    parts = np.stack([split(quotas, sizes, draw) for _ in range(20_000)])
    assert (parts.sum(axis=2) == quotas).all() and (parts.sum(axis=1) == sizes).all()
    mean = quotas[:, None] * sizes / 10
    assert np.abs(parts.mean(axis=0) - mean).max() < 0.03
    # Chance that the first shard's two places both hold the first source.
    assert abs((parts[:, 0, 0] == 2).mean() - 6 * 5 / (10 * 9)) < 0.015


def test_targets_of_many_sources(spark):
    draw = random.Random(4)
    sizes = {f"s{k:03}": int(draw.paretovariate(0.5)) for k in range(300)} | {None: 40, "": 0}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    expected = plain_targets(sizes)
    for r in targets(table).collect():
        assert r["target"] == pytest.approx(expected[r["source"]])


def test_empty_tables(spark):
    assert mixed(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([(1, None, "a", "x", 1), (2, "", None, "x", 1)], SCHEMA)
    got = mixed(none).withColumn("taken", taken()).collect()
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in got] == [(0, 0, 0, 0)] * 2
