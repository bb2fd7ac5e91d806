"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from rankmart.queries.catalog import ORACLE, QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    with connect(SF_DIR) as connection:
        yield connection


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, db, name):
    result = compare(queries()[name](spark, SF_DIR), db, oracle_sql()[name])
    if result == "no rows":
        # Some filters leave nothing of the smallest tables.
        with connect(LARGER) as larger:
            result = compare(queries()[name](spark, LARGER), larger, oracle_sql()[name])
    assert result == ""


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["rank", "name"]
    assert df.count() > 0
