"""Dated landing files: writing, reading, and the log of what was written.

Layout: ``<root>/<domain>/year=/month=/day=/dataset=/run=HHMMSS/part-*.csv``. The
other usual layout, ``<root>/year=/month=/day=/<domain>/<dataset>_HHMMSS.csv``, is
read as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MAX_ROWS_PER_FILE = 500_000
#: Columns that a file with a header of its own may have.
MAX_COLUMNS = 64

LOG_SCHEMA = """pipeline string, layer string, entity string, subcategory string,
    status string, bucket string, data_key string, rows bigint, columns array<string>,
    extracted_at string, logged_at string"""

# Added by the readers: extraction run and file of each row.
ORIGIN = ["landing_run", "source_file"]


def write_landing(
    df: DataFrame,
    root: str,
    domain: str,
    dataset: str | Column,
    day: date | Column,
    at: datetime,
    columns: Sequence[str] | None = None,
) -> dict | None:
    """Append ``df`` as header CSV under its day and return what was written.

    ``dataset`` and ``day`` may be columns, so that one job writes many of either;
    ``columns`` are those to write, all by default. An empty frame writes nothing
    and returns None.
    """
    columns = list(columns or df.columns)
    day = day if isinstance(day, Column) else F.lit(day)
    dataset = dataset if isinstance(dataset, Column) else F.lit(dataset)
    parts = ["year", "month", "day", "dataset", "run"]
    counted = Observation()
    placed = df.withColumns(
        {
            "year": F.date_format(day, "yyyy"),
            "month": F.date_format(day, "MM"),
            "day": F.date_format(day, "dd"),
            "dataset": dataset,
            "run": F.lit(f"{at:%H%M%S}"),
        }
    ).select(*columns, *parts)
    (
        # Rebalancing splits a large day over several tasks and merges small ones.
        placed.hint("rebalance", *parts)
        .observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("append")
        .option("header", True)
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .partitionBy(*parts)
        .csv(f"{root}/{domain}")
    )
    rows = counted.get["rows"]
    if rows == 0:
        return None
    return {
        "bucket": root,
        "key": domain,
        "rows": rows,
        "columns": columns,
        "timestamp": at.isoformat(),
    }


def log_load(
    spark: SparkSession,
    log_path: str,
    written: Mapping | None,
    pipeline: str,
    entity: str,
    subcategory: str,
    logged_at: datetime,
    status: str = "SUCCESS",
) -> None:
    """Append one record about a write; nothing was written, nothing is logged."""
    if not written:
        return
    record = (
        pipeline,
        "landing",
        entity,
        subcategory,
        status,
        written["bucket"],
        written["key"],
        written["rows"],
        list(written["columns"]),
        written["timestamp"],
        logged_at.isoformat(),
    )
    spark.createDataFrame([record], LOG_SCHEMA).coalesce(1).write.mode("append").json(log_path)


def load_history(spark: SparkSession, log_path: str) -> DataFrame:
    """Every logged write."""
    return spark.read.schema(LOG_SCHEMA).json(log_path)


def _day_paths(root: str, domain: str, day: date | None, layout: str) -> tuple[str, str]:
    """(base path, path to read) of one day, or of all days."""
    days = f"year={day:%Y}/month={day:%m}/day={day:%d}" if day else "year=*/month=*/day=*"
    if layout == "domain_first":
        return f"{root}/{domain}", f"{root}/{domain}/{days}"
    if layout == "date_first":
        return root, f"{root}/{days}/{domain}"
    raise ValueError(f"unknown layout: {layout}")


def with_origin(df: DataFrame) -> DataFrame:
    """Add the run time taken from the path, and the file."""
    path = F.col("_metadata.file_path")
    run = F.regexp_extract(path, r"(?:/run=|_)(\d{6})(?:/[^/]*|\.csv[^/]*)$", 1)
    rows = df.select("*", run.alias("landing_run"), path.alias("source_file"))
    return rows.drop("dataset", "run")


def read_landing(
    spark: SparkSession,
    root: str,
    domain: str,
    day: date | None = None,
    layout: str = "domain_first",
) -> DataFrame:
    """Header CSVs of a domain as text, with ``year``, ``month``, ``day`` and origin.

    Only the folder of ``day`` is listed and read. No schema is given, so that the
    columns are the ones of the file. Files of one call must have the same header; one
    that differs fails the read rather than land under wrong names, and
    :func:`read_heterogeneous_csv` reads such files.
    """
    base, path = _day_paths(root, domain, day, layout)
    reader = spark.read.option("header", True).option("basePath", base)
    return with_origin(reader.option("enforceSchema", False).csv(path))


def whole_files(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """One row per file below ``path``: its text as ``value``, the folder names, the origin.

    A file must fit a row; those written here hold at most ``MAX_ROWS_PER_FILE`` rows.
    """
    reader = spark.read
    if base is not None:
        reader = reader.option("basePath", base)
    return with_origin(reader.text(path, wholetext=True))


def _first_lines(text: Column) -> Column:
    """The lines of a text that are not empty, without a byte order mark."""
    lines = F.split(F.regexp_replace(text, "^\ufeff", ""), r"\r\n|\n|\r")
    return F.filter(lines, lambda line: line != "")


def headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with any line below ``path``: ``source_file``, first line ``header``."""
    header = F.get(_first_lines(F.col("value")), F.lit(0)).alias("header")
    return whole_files(spark, path).select("source_file", header).filter("header IS NOT NULL")


def _split_cells(line: Column) -> Column:
    """The values of a line that commas alone divide; null for any other line.

    Spark's CSV parser costs several times as much, and makes ``MAX_COLUMNS`` values of
    every line. A line has no more than these here either.
    """
    plain = ~line.rlike(r'["\\\x00-\x1f]')
    cells = F.transform(F.split(line, ",", MAX_COLUMNS + 1), lambda c: F.nullif(c, F.lit("")))
    return F.when(plain, F.slice(cells, 1, MAX_COLUMNS))


def _parsed_cells(line: Column, columns: Column | None = None) -> Column:
    """The values of a CSV line in order as a struct; see :func:`_cells`."""
    if columns is not None:
        whole = (F.regexp_count(line, F.lit('"')) % 2 == 0) & ~F.contains(line, F.lit("\\"))
        filled = F.concat(line, F.repeat(F.lit(","), F.lit(MAX_COLUMNS) - columns))
        line = F.when(whole, filled).otherwise(line)
    names = [f"c{k}" for k in range(MAX_COLUMNS)]
    # Without an option, Spark would parse the line once for each value that is taken from it.
    return F.from_csv(line, ", ".join(f"{n} string" for n in names), {"mode": "PERMISSIVE"})


def _cells(line: Column, columns: Column | None = None) -> Column:
    """The values of a CSV line in order; null where it has no more.

    ``columns`` is how many a line of the file should have. Such a line is filled up with
    empty values, as Spark raises and catches an error for each that is short; one with
    an open quote or an escape is left as it is.
    """
    return _listed(_parsed_cells(line, columns))


def _listed(parsed: Column) -> Column:
    return F.array(*[parsed[f"c{k}"] for k in range(MAX_COLUMNS)])


def named_lines(
    files: DataFrame, columns: Mapping[str, str], synonyms: Mapping[str, str] | None = None
) -> DataFrame:
    """The lines of whole files, each value under the name in the first line of its file.

    ``columns`` is ``{name: type}``; names of the header have lower case and ``_`` for blanks,
    ``synonyms`` (``{old: new}``) fill in where the new name is absent or its value null, and a
    column of ``files`` (a folder name) is taken where the header has none. Also works on a
    stream: every file is split by itself, in one pass.
    """
    old: dict[str, list[str]] = {}
    for name, new in (synonyms or {}).items():
        old.setdefault(new, []).append(name)
    lines = F.col("_lines")
    header = F.get(lines, F.lit(0))
    names = F.transform(
        _cells(header), lambda n: F.replace(F.lower(F.trim(n)), F.lit(" "), F.lit("_"))
    )
    given = F.filter("_names", lambda n: n.isNotNull())
    twice = F.size(F.array_distinct(given)) < F.size(given)
    wide = F.size(F.split(header, ",")) > MAX_COLUMNS
    checked = (
        F.when(twice, F.raise_error(F.concat(F.lit("columns differ only in case or blanks: "), header)))
        .when(wide, F.raise_error(F.lit(f"a header has more than {MAX_COLUMNS} columns")))
        .otherwise(F.col("_names"))
    )
    split = files.withColumn("_lines", _first_lines(F.col("value"))).withColumn("_names", names)
    split = split.withColumn("_names", checked)
    folders = [c for c in files.columns if c != "value"]
    # Where each name stands is found once a file, not once a line.
    wanted = {n: [n, *old.get(n, [])] for n in columns}
    places = {n: f"_at_{k}" for k, n in enumerate(dict.fromkeys(sum(wanted.values(), [])))}
    rows = split.select(
        *folders,
        *[(F.array_position("_names", F.lit(n)) - 1).cast("int").alias(p) for n, p in places.items()],
        F.size(given).alias("_columns"),
        F.explode(F.slice(lines, 2, F.size(lines))).alias("_line"),
    )
    # The parser sees only the lines that need it. Each step is a column of its own, or
    # Spark would parse a line anew for every value of it.
    rows = rows.withColumn("_split", _split_cells(F.col("_line")))
    rest = F.when(F.col("_split").isNull(), F.col("_line"))
    rows = rows.withColumn("_parsed", _parsed_cells(rest, F.col("_columns")))
    listed = F.when(F.col("_split").isNull(), _listed(F.col("_parsed")))
    rows = rows.withColumn("_cells", F.coalesce("_split", listed))

    def value(name: str) -> Column:
        found = [F.get("_cells", F.col(places[n])) for n in wanted[name]]
        if name in folders:
            found.append(F.col(name).cast("string"))
        return F.coalesce(*found)

    return rows.select(*[value(n).cast(t).alias(n) for n, t in columns.items()])


def read_heterogeneous_csv(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str],
    synonyms: Mapping[str, str] | None = None,
    base: str | None = None,
) -> DataFrame:
    """CSV files with differing headers below ``path`` as one frame, plus origin.

    Values stay under the names of their own file whatever their position. The text is read
    once and each file is split where it is read; nothing about files reaches the driver.
    With ``base``, the folder names below it (``year=``, ``month=``, ``day=``) may be among
    ``columns``.
    """
    files = whole_files(spark, path, base)
    return named_lines(files, {**columns, **{c: "string" for c in ORIGIN}}, synonyms)


def export_csv(df: DataFrame, path: str) -> None:
    """Write a frame as header CSV, one file per task."""
    df.write.mode("overwrite").option("header", True).csv(path)
