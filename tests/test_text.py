from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from rankmart.functions.hashing import hash_diff
from rankmart.functions.text import (
    clean_text,
    is_rejected,
    parse_grouped_number,
    parse_number,
    show_amount,
    title_case,
)


def test_thousands_separators(spark):
    df = spark.createDataFrame([("264,738,322,692",), ("1,234",), (None,), ("x",)], "t string")
    got = [r[0] for r in df.select(parse_grouped_number("t")).collect()]
    assert got == [264738322692, 1234, None, None]


@pytest.mark.parametrize(
    "text", ["12", " 12 ", "-3", "+4", "12.7", "5.", "abc", "", "1e3", "99999999999", "1 2", None]
)
def test_numbers_parse_like_a_lenient_cast(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(parse_number("t")).first()[0]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        lenient = df.select(F.col("t").cast("int")).first()[0]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert got == lenient


def test_rejects_are_bad_texts_not_missing_ones(spark):
    df = spark.createDataFrame([("abc",), ("7",), (None,)], "t string")
    got = [r[0] for r in df.select(is_rejected("t", parse_number("t"))).collect()]
    assert got == [True, False, False]


def test_clean_and_display(spark):
    df = spark.createDataFrame([("  Elder DRUID ", "d'artagnan of x", 1234.5)], "a string, b string, c double")
    row = df.select(clean_text("a"), title_case("b"), show_amount("c")).first()
    assert tuple(row) == ("elder druid", "D'artagnan Of X", "1,234.50")


def test_hash_of_plain_values_is_sha256_of_the_joined_text(spark):
    df = spark.createDataFrame([("knight", 10, "Open")], "a string, b int, c string")
    got = df.select(hash_diff(["a", "b", "c"])).first()[0]
    assert got == hashlib.sha256(b"knight||10||Open").hexdigest()


def test_hash_tells_where_a_null_is(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, None)], "a string, b string")
    hashes = [r[0] for r in df.select(hash_diff(["a", "b"])).collect()]
    assert len(set(hashes)) == 3 and None not in hashes
