"""Names found by postings equal those of the search through all rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from rankmart.plans.names import NameIndex
from rankmart.plans.views import search

NAMES = ["Aldo", "aldo", "Bald 100%", "Éowyn Ålder", "o'Brien", "x", "xy", "", "aaaa", "a.b.c"]
TEXTS = ["", "  ", "A", "al", "ALD", "aldo", "ald 1", "0%", "%", "_", ".b.", "éowyn å", "aaaaa", "ÅLD"]


def test_same_names_as_the_literal_search(spark, tmp_path):
    index = NameIndex(spark, str(tmp_path))
    first = [(n,) for n in NAMES[:5]] + [(None,)] + [("Aldo",)] * 50
    index.add(spark.createDataFrame(first, "name string"))
    every = spark.createDataFrame([(n, i) for i, n in enumerate([*NAMES, None])], "player string, i int")
    # Known names are not written again, from another handle either.
    index = NameIndex(spark, str(tmp_path))
    index.add(every, "player")
    assert sorted(r[0] for r in index.postings().filter("gram = ''").select("name").collect()) == sorted(NAMES)
    for text in TEXTS:
        whole = every.filter(search("player", text)).select("i").collect()
        assert sorted(index.rows(every, text, "player").select("i").collect()) == sorted(whole), text


def test_no_names(spark, tmp_path):
    index = NameIndex(spark, str(tmp_path))
    index.add(spark.createDataFrame([(None,)], "name string"))
    assert index.find("a").isEmpty() and index.find("longer").isEmpty()


@pytest.mark.parametrize("text", ["er 77", "r 4"])
def test_one_partition_is_read(spark, tmp_path, text):
    index = NameIndex(spark, str(tmp_path))
    names = spark.range(3000).select(F.concat(F.lit("player "), "id").alias("name"))
    index.add(names)
    found = index.find(text)
    expected = sum(text in f"player {i}" for i in range(3000))
    assert found.count() == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*part#", plan)
    assert re.search(r"PushedFilters: \[[^\]]*(EqualTo|In)\(gram", plan)
    read = index._of(text if len(text) <= 3 else index._rarest(text))
    read.collect()
    metrics = read._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    assert metrics.apply("numPartitions").value() == 1
    assert metrics.apply("numOutputRows").value() < index.postings().count() / 8
