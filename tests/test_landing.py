from __future__ import annotations

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rankmart.operators.conform import conform
from rankmart.plans.bronze import EXTRA_COLUMNS, SYNONYMS, bronze_extra
from rankmart.sources.domain import category_domain, dim_category, unknown_values, vocation_id
from rankmart.sources.landing import (
    _cells,
    _split_cells,
    headers,
    load_history,
    log_load,
    read_heterogeneous_csv,
    read_landing,
    write_landing,
)

DAY = date(2024, 3, 9)
AT = datetime(2024, 3, 9, 10, 15)


def put(path: Path, *lines: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_round_trip(spark, tmp_path, rows):
    people = spark.createDataFrame([("Ana, Maria", 28), ('say "x"', 29)], "Name string, Age int")
    written = write_landing(people, str(tmp_path), "people", "data", DAY, AT)
    assert set(written) == {"bucket", "key", "rows", "columns", "timestamp"}
    assert written["rows"] == 2 and written["columns"] == ["Name", "Age"]
    back = read_landing(spark, str(tmp_path), "people", DAY)
    assert rows(back, "Name", "Age", "year", "month", "day", "landing_run") == [
        ("Ana, Maria", "28", 2024, 3, 9, "101500"),
        ('say "x"', "29", 2024, 3, 9, "101500"),
    ]


def test_empty_input_writes_and_logs_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "Name string")
    written = write_landing(none, str(tmp_path), "people", "data", DAY, AT)
    assert written is None
    log_load(spark, str(tmp_path / "log"), written, "p", "people", "data", AT)
    assert not (tmp_path / "log").exists()
    assert not list(tmp_path.rglob("*.csv"))


def test_log_has_one_json_record_per_load(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "Name string")
    written = write_landing(df, str(tmp_path), "people", "data", DAY, AT)
    for _ in range(2):
        log_load(spark, str(tmp_path / "log"), written, "daily", "people", "data", AT)
    assert load_history(spark, str(tmp_path / "log")).count() == 2
    record = json.loads(next((tmp_path / "log").glob("part-*")).read_text())
    assert set(record) == {
        "pipeline", "layer", "entity", "subcategory", "status", "bucket", "data_key", "rows",
        "columns", "extracted_at", "logged_at",
    }
    assert (record["layer"], record["status"], record["rows"]) == ("landing", "SUCCESS", 1)


def test_only_the_day_is_read(spark, tmp_path):
    df = spark.createDataFrame([("a", date(2024, 3, 9)), ("b", date(2024, 3, 10))], "n string, d date")
    write_landing(df, str(tmp_path), "people", "x", df["d"], AT, ["n"])
    assert [r["n"] for r in read_landing(spark, str(tmp_path), "people", DAY).collect()] == ["a"]
    assert read_landing(spark, str(tmp_path), "people").count() == 2


def test_the_other_layout(spark, tmp_path, rows):
    folder = tmp_path / "year=2024" / "month=03" / "day=09" / "experience"
    put(folder / "druid_081500.csv", "Name,Level", "a,1")
    put(folder / "knight_211500.csv", "Name,Level", "a,2")
    put(folder / "_SUCCESS")
    df = read_landing(spark, str(tmp_path), "experience", DAY, layout="date_first")
    assert rows(df, "Name", "Level", "month", "landing_run") == [
        ("a", "1", 3, "081500"),
        ("a", "2", 3, "211500"),
    ]
    with pytest.raises(ValueError, match="layout"):
        read_landing(spark, str(tmp_path), "experience", DAY, layout="other")


def test_values_stay_under_their_own_header(spark, tmp_path, rows):
    put(tmp_path / "boss_080000.csv", "Rank,Name,Score,Category", '1,a,"1,234",Boss Points')
    put(tmp_path / "loyalty_080000.csv", "Rank,Name,Title,Score,Category", "1,b,Sage,7,Loyalty Points")
    put(tmp_path / "odd name_090000.csv", "Rank,Name,Score,Category", "1,c,9,Boss Points")
    assert headers(spark, str(tmp_path)).count() == 3
    df = read_heterogeneous_csv(spark, str(tmp_path), EXTRA_COLUMNS, SYNONYMS)
    assert rows(df, "name", "title", "points", "category", "landing_run") == [
        ("a", None, "1,234", "Boss Points", "080000"),
        ("b", "Sage", "7", "Loyalty Points", "080000"),
        ("c", None, "9", "Boss Points", "090000"),
    ]
    bronze = bronze_extra(df, "b1", AT)
    assert rows(bronze, "name", "points") == [("a", 1234), ("b", 7), ("c", 9)]


def test_categories(spark, rows):
    assert category_domain(" Fishing ") == "skills" and category_domain("boss") == "extra"
    assert vocation_id("Monk") == 6
    for call in (category_domain, vocation_id):
        with pytest.raises(ValueError, match="unknown"):
            call("cooking")
    dim = dim_category(spark)
    assert dim.groupBy("domain").count().filter("domain = 'extra'").first()["count"] == 6
    df = spark.createDataFrame([("boss",), ("cooking",), (None,)], "k string")
    known = [r[0] for r in dim.select("category_key").collect()]
    assert rows(unknown_values(df, "k", known)) == [(None,), ("cooking",)]


def test_conform_is_typed(spark):
    assert conform(spark.range(1), {"title": "string", "id": "int"}).dtypes == [
        ("title", "string"),
        ("id", "int"),
    ]


def test_a_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Name,Score\na,1\n")
    df = read_heterogeneous_csv(spark, str(tmp_path), {"name": "string", "points": "string"})
    plan = json.loads(df._jdf.queryExecution().optimizedPlan().toJSON())
    text = json.dumps(plan)
    # Spark narrows a parse to the one value that is taken from it: one parse for each value.
    assert "CsvToStructs" in text and '"requiredSchema"' not in text.replace(
        '"requiredSchema": null', ""
    )


def test_filling_up_a_line_changes_no_value(spark):
    lines = [
        "a,b,c", "a", "", "a,b,c,d,e", ",,", 'a,"1,234",c', 'a,"x""y",c', 'a,"open,c', 'a,b"c"d,e',
        '"a\\",b,c', "a\\,b,c", " a , b , c ", 'a,b,"c" ', 'a,"b" x,c', ",".join(map(str, range(70))),
    ]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    found = df.select("line", _cells(F.col("line")).alias("l"), _cells(F.col("line"), F.lit(3)).alias("r"))
    for row in found.collect():
        assert row["l"] == row["r"], row["line"]


def test_lines_without_quotes_are_split_without_the_parser(spark):
    lines = [
        "a,b,c", "a", "", " ", ",,", "a,b,c,d,e", " a , b , c ", "#a,b", "null,NULL", "a,\u00a0b",
        "a;b|c,'d,e'", ",".join(map(str, range(64))), ",".join(map(str, range(70))), "," * 80,
    ]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    found = df.select("line", _split_cells(F.col("line")).alias("l"), _cells(F.col("line")).alias("r"))
    for row in found.collect():
        assert row["l"] + [None] * (len(row["r"]) - len(row["l"])) == row["r"], row["line"]
    others = spark.createDataFrame([('a,"b,c"',), ("a\\,b",), ("a\tb,c",)], "line string")
    assert others.filter(_split_cells(F.col("line")).isNotNull()).isEmpty()
