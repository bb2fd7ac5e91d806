"""Language, quality, neighbours: accuracy on held-out rows, recall, odd input."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankmart.llm import ann, language_id, quality
from rankmart.llm.queries import op4_language_id, op6_quality, op9_neighbours, table

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    found = op4_language_id(spark, SF)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = table(spark, SF, "documents").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 150
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert found.filter("score < 0 OR score > 1").isEmpty()


def test_language_of_odd_texts(spark):
    docs = spark.createDataFrame(
        [(1, "the cat", "en", 0.5), (2, "le chat", "fr", 0.5), (3, "der hund", None, 0.5),
         (4, None, "en", 0.5), (5, "", None, 0.5), (6, "123 !?", None, 0.5), (None, "THE", None, 0.5)],
        "doc_id long, text string, lang string, score double",
    )
    model = language_id.train(docs)
    assert model.languages == ("en", "fr")
    found = language_id.identify(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    told = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found.collect()}
    assert told[1][0] == "en" and told[2][0] == "fr" and told[None][0] == "en"
    assert told[4] == told[5] == told[6] == ("und", 0.0)
    none = language_id.train(docs.filter("lang = 'xx'"))
    assert {r["lang_pred"] for r in language_id.identify(docs, none).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).isEmpty()


def test_a_frequent_text_is_learned_by_its_share(spark):
    """Of 8,000 rows about 1,000 are counted, also where half of them are one text."""
    rows = [(i, "zzz", "en") for i in range(4000)]
    rows += [(i, f"the {i}", "en") for i in range(4000, 8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def counted(model, text):
        """How often the n-gram of three was counted: buckets start at one."""
        bucket = list(language_id._grams([text], [len(text)]))[-1][1]
        return (np.exp(model.weights[bucket, 0] - model.weights.min()) - 1).round()

    whole = language_id.train(docs, rows=len(rows))
    assert (counted(whole, "zzz") == 4000).all() and (counted(whole, "the") == 4000).all()
    sampled = language_id.train(docs, rows=1000)
    for text in ("zzz", "the"):
        n = counted(sampled, text)
        assert ((n > 350) & (n < 650)).all(), n


def brute_language(texts, model):
    """Naive Bayes text by text, n-gram by n-gram."""
    found = []
    for text in texts:
        total = model.prior.copy()
        for _, buckets in language_id._grams([text], [len(text)]):
            for bucket in buckets:
                total = total + model.weights[bucket]
        best = max(range(len(total)), key=lambda i: total[i])
        share = 1.0 / sum(np.exp(t - total[best]) for t in total)
        found.append((model.languages[best], share))
    return found


def test_languages_against_plain_bayes(spark):
    docs = table(spark, SF, "documents").filter("text <> ''").orderBy("doc_id").limit(60)
    model = language_id.train(table(spark, SF, "documents"))
    rows = language_id.identify(docs, model).collect()
    expected = brute_language([r["text"] for r in rows], model)
    assert [r["lang_pred"] for r in rows] == [name for name, _ in expected]
    assert np.allclose([r["score"] for r in rows], [share for _, share in expected])


def test_quality_against_plain_discriminant(spark):
    """Log densities with covariances, inverses and determinants computed straight on."""
    docs = table(spark, SF, "documents").select("doc_id", "text")
    labels = table(spark, SF, "labels").select("doc_id", "quality")
    model = quality.train_by_id(docs, labels)
    rows = docs.join(labels, "doc_id").collect()
    x = quality.statistics(pa.array([r["text"] for r in rows], pa.string()))
    y = np.array([r["quality"] for r in rows])
    known = [x[y == k] for k in (0, 1)]
    own = [np.cov(k.T, bias=True) for k in known]
    common = sum(len(k) * c for k, c in zip(known, own)) / (len(known[0]) + len(known[1]))
    logs = []
    for k in (0, 1):
        mixed = (1 - quality.TOWARDS_COMMON) * own[k] + quality.TOWARDS_COMMON * common
        level = np.diag(np.maximum(np.diag(mixed), quality.FLOOR))
        mixed = (1 - quality.TOWARDS_DIAGONAL) * mixed + quality.TOWARDS_DIAGONAL * level
        mixed += quality.FLOOR * np.eye(len(mixed))
        away = x - known[k].mean(axis=0)
        distance = np.einsum("ni,ij,nj->n", away, np.linalg.inv(mixed), away)
        prior = np.log(len(known[k]) / (len(known[0]) + len(known[1])))
        logs.append(prior - 0.5 * np.linalg.slogdet(mixed)[1] - 0.5 * distance)
    expected = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
    assert np.allclose(model.score(x), expected, atol=1e-6)


def test_a_long_text_counts_like_its_parts():
    text = "ab" * 10 + " é"
    whole = sorted(b for _, g in language_id._grams([text], [len(text)]) for b in g)
    parts = sorted(
        b
        for at in range(0, len(text), 5)
        for _, g in language_id._grams([text[at : at + 7]], [min(5, len(text) - at)])
        for b in g
    )
    assert whole == parts


def test_quality_of_held_out_documents(spark):
    found = op6_quality(spark, SF)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = table(spark, SF, "labels").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["quality"] == r["predicted"] for r in rows]) > 0.9
    assert found.filter("isnan(score) OR score < 0 OR score > 1").isEmpty()
    assert found.filter("(score >= 0.5) <> (predicted = 1)").isEmpty()


def test_quality_with_few_labels(spark):
    docs = spark.createDataFrame(
        [(1, "a b", 1, 9), (2, None, None, 9), (3, "", 7, 9), (None, "x" * 3_000_000, 1, 9)],
        "doc_id long, text string, quality int, predicted int",
    )
    only = quality.classify(docs, quality.train(docs))
    assert only.columns == ["doc_id", "text", "quality", "score", "predicted"]
    apart = quality.train_by_id(docs.drop("quality"), docs.drop("text"))
    joined = docs.select("doc_id", "text").join(docs.select("doc_id", "quality"), "doc_id")
    assert np.allclose(apart.means, quality.train(joined).means)
    assert {r["score"] for r in only.collect()} == {1.0}
    none = quality.train(docs.filter("quality = 0"))
    assert {r["score"] for r in quality.classify(docs, none).collect()} == {0.5}


def test_recall_of_neighbours(spark):
    found = op9_neighbours(spark, SF).collect()
    rows = table(spark, SF, "embeddings").orderBy("vec_id").collect()
    vectors = np.array([r["embedding"] for r in rows], float)
    ids = np.array([r["vec_id"] for r in rows])
    hits = total = 0
    for query in ids[ids % 20 == 0]:
        scores = vectors @ vectors[ids == query][0]
        scores[ids == query] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]])
        mine = [r for r in found if r["query_id"] == query]
        assert [r["rank"] for r in sorted(mine, key=lambda r: r["rank"])] == list(range(1, 21))
        for r in mine:
            assert r["score"] == pytest.approx(scores[ids == r["vec_id"]][0], abs=1e-12)
        hits += len(best & {r["vec_id"] for r in mine})
        total += 20
    assert hits / total >= 0.9


def test_odd_vectors_take_no_part_and_ties_go_to_smaller_ids(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [1.0, 0.0]), (4, [0.5, 0.5]),
        (5, None), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]),
        (10, [1.0]), (None, [1.0, 1.0]), (40, None),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = ann.neighbours(vectors, F.col("vec_id") % 20 == 0, k=3).collect()
    told = {q: [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q]
            for q in (0, 20, 40)}
    assert told == {0: [2, 3, 20], 20: [0, 2, 3], 40: []}
    assert ann.neighbours(vectors.limit(0), F.lit(True)).isEmpty()
    everything = ann.neighbours(vectors, F.col("vec_id") == 0, k=20)
    assert everything.count() == 4


def test_probing_finds_every_code_within_the_radius():
    draw = np.random.default_rng(0)
    codes = draw.integers(0, 256, (300, 8), dtype=np.uint8)
    asked = codes[:20] ^ draw.integers(0, 8, (20, 8), dtype=np.uint8)
    apart = np.bitwise_count(codes[None] ^ asked[:, None]).sum(axis=2)
    for radius in (0, 3, 7, 12, 20, 27):
        met = ann._near(codes, asked, radius)
        assert not ((apart <= radius) & ~met).any()


def test_repeated_query_ids_and_other_lengths(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.9, 0.1]), (2, [0.1, 0.9]), (3, [0.5, 0.5])]
    rows += [(20, [1.0, 0.0, 0.0]), (4, [0.5, 0.1, 0.0]), (5, [0.7, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.neighbours(vectors, F.col("vec_id") % 20 == 0, k=2).collect()
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)
    assert found == [
        (0, 1, 1, 0.9), (0, 1, 2, 0.9), (0, 2, 3, 0.5), (0, 2, 3, 0.5),
        (20, 1, 5, 0.7), (20, 2, 4, 0.5),
    ]
    every = ann.neighbours(vectors.filter("vec_id = 0"), F.lit(True), k=5).collect()
    assert [(r["query_id"], r["vec_id"]) for r in every] == [(0, 0), (0, 0)]
