"""Writing catalog tables with Spark's own writers (parquet, Snappy)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from hashlib import sha256
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankmart.operators.conform import backfill, evolve
from rankmart.sources.domain import TABLES

MAX_ROWS_PER_FILE = 500_000
#: Parquet's own default.
ROW_GROUP_BYTES = 128 << 20
#: For tables whose readers ask for a short range of sorted rows.
SHORT_ROW_GROUP_BYTES = 8 << 20
COMPRESSION = "snappy"


def create_all(spark: SparkSession, prefix: str = "", location: str | None = None) -> list[str]:
    """Create the databases and tables that do not exist yet; return the table names.

    ``prefix`` goes before each database name. Tables lie below ``location`` if given,
    else in the warehouse.
    """
    names = []
    for table, (columns, partitions) in TABLES.items():
        database, short = table.split(".")
        name = f"{prefix}{database}.{short}"
        place = f"LOCATION '{location}/{database}'" if location else ""
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {prefix}{database} {place}")
        place = f"LOCATION '{location}/{database}/{short}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(partitions)}) {place}"
        )
        names.append(name)
    return names


def table_at(
    spark: SparkSession,
    path: str,
    schema: StructType,
    by: Sequence[str],
    buckets: tuple[str, int] | None = None,
) -> str:
    """The name of a partitioned table whose files lie at ``path``, known or new.

    The name is derived from the path. ``buckets`` is a column and the number of buckets
    that it is hashed to. Partitions found at ``path`` are taken in.
    """
    name = f"at_{sha256(path.encode()).hexdigest()[:24]}"
    if spark.catalog.tableExists(name):
        spark.catalog.recoverPartitions(name)
        return name
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    clustered = f"CLUSTERED BY ({buckets[0]}) INTO {buckets[1]} BUCKETS" if buckets else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(by)}) {clustered} LOCATION '{path}'"
    )
    # Makes the folder, if there is none.
    none = spark.createDataFrame([], schema)
    none.write.mode("ignore").partitionBy(*by).parquet(path)
    spark.catalog.recoverPartitions(name)
    return name


def put_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions of ``table`` that occur in ``df``, which may read the table.

    Rows are written by the tasks that hold them; :func:`overwrite_partitions` gathers them
    by partition first.
    """
    rows = _like_table(df, table)
    writer = rows.write.option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
    with setting(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        writer.option("compression", COMPRESSION).insertInto(table, overwrite=True)


def _sized(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Group rows by table partition before a write.

    Unlike a hash repartition, rebalancing splits a partition that holds much of the
    data over several tasks, and merges small ones.
    """
    return df.hint("rebalance", *by) if by else df


def _clustered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows by ranges of ``order``, sorted: a large partition spans several tasks.

    Spark samples the rows for this, so the last stage before is run twice.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _like_table(df: DataFrame, table: str) -> DataFrame:
    """Columns by name, in the table's order and types."""
    schema = df.sparkSession.table(table).schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Another value of a session setting for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _insert(
    df: DataFrame, table: str, overwrite: bool, within: Sequence[str], row_group_bytes: int
) -> int:
    spark = df.sparkSession
    counted = Observation()
    by = _partitions(spark, table)
    rows = _like_table(df, table)
    # Counted behind the shuffle: what lies before is also run to sample the ranges.
    rows = _clustered(rows, [*by, *within]) if within else _sized(rows, by)
    writer = (
        rows.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .option("compression", COMPRESSION)
        .option("parquet.block.size", row_group_bytes)
    )
    # The static default would replace every partition of the table, and an insert
    # reads this mode from the session only.
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        writer.insertInto(table, overwrite=overwrite)
    return counted.get["rows"]


def append_batch(
    df: DataFrame,
    table: str,
    within: Sequence[str] = (),
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> int:
    """Append rows to an existing table and return how many there were.

    With ``within``, rows of a partition are dealt to files by ranges of these columns and lie
    sorted in them, so that the smallest and largest values that Parquet keeps let a filter
    on the first of them pass over files and row groups. Name columns that make rows differ:
    equal values go to one task.
    """
    return _insert(df, table, False, within, row_group_bytes)


def overwrite_partitions(
    df: DataFrame,
    table: str,
    within: Sequence[str] = (),
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> int:
    """Replace only the partitions that occur in ``df``; return the rows written.

    ``within`` is as for :func:`append_batch`.
    """
    return _insert(df, table, True, within, row_group_bytes)


def _columns(schema: StructType, by: Sequence[str]) -> list[tuple[str, str]]:
    """Names and types, those of the partitions last."""
    fields = sorted(schema.fields, key=lambda f: f.name in by)
    return [(f.name, f.dataType.simpleString()) for f in fields]


def _has_columns(df: DataFrame, table: str, by: Sequence[str]) -> bool:
    """Whether a table there has the columns and partitions of ``df``."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table) or _partitions(spark, table) != list(by):
        return False
    return _columns(spark.table(table).schema, by) == _columns(df.schema, by)


def _literal(value: str | None) -> str:
    if value is None:
        return "null"
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{quoted}'"


def _folders(rows: DataFrame, by: Sequence[str]) -> dict[str, str]:
    """The partitions of files just written, as SQL names them, and where each lies."""
    values = [F.col(c).cast("string").alias(c) for c in by]
    files = rows.select(*values, F.col("_metadata.file_path").alias("_file"))
    found = files.groupBy(*by).agg(F.min("_file").alias("_file")).collect()
    return {
        ", ".join(f"`{c}` = {_literal(row[c])}" for c in by): unquote(
            row["_file"].rpartition("/")[0]
        )
        for row in found
    }


def _point(spark: SparkSession, table: str, partition: str, folder: str | None) -> None:
    """Point one partition of a table at a folder, or at none."""
    if folder is None:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition})")
        return
    place = _literal(folder)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({partition}) LOCATION {place}")
    spark.sql(f"ALTER TABLE {table} PARTITION ({partition}) SET LOCATION {place}")


def replace_table(df: DataFrame, table: str, path: str, by: Sequence[str] = ()) -> None:
    """Make ``table`` the rows of ``df``, which may read the table itself.

    The rows go to a new folder below ``path``; then the name is pointed at it. Files
    of the replaced version stay for readers that still use them. Where columns and
    partitions are the same the name stays all the while; else the table is dropped and
    created anew. Partitions are pointed at their new folders one by one: a reader finds each
    of them old or new, never missing, and one that has no rows any more goes last. A step
    that died before left the table as it was; one that died in between is repeated.
    """
    spark = df.sparkSession
    folder = f"{path}/version={uuid4().hex}"
    writer = (
        _sized(df, by)
        .write.option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .option("compression", COMPRESSION)
    )
    (writer.partitionBy(*by) if by else writer).parquet(folder)
    if _has_columns(df, table, by):
        if by:
            fresh = _folders(spark.read.schema(df.schema).parquet(folder), by)
            for partition, place in fresh.items():
                _point(spark, table, partition, place)
            moved = F.col("_metadata.file_path").contains(folder.rpartition("/")[2])
            for partition in _folders(spark.table(table).filter(~moved), by):
                _point(spark, table, partition, None)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        return
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    if not by:
        spark.catalog.createTable(table, path=folder, source="parquet")
        return
    # Types as in the rows; read off folder names, a text of digits would become a number.
    columns = ", ".join(f"`{name}` {type_}" for name, type_ in _columns(df.schema, by))
    names = ", ".join(f"`{c}`" for c in by)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({names}) "
        f"LOCATION '{folder}'"
    )
    spark.catalog.recoverPartitions(table)


def backfill_table(
    spark: SparkSession, table: str, column: str, value: Column, path: str
) -> None:
    """Fill the NULLs of a column of a table."""
    rows = backfill(spark.table(table), column, value)
    replace_table(rows, table, path, _partitions(spark, table))


def evolve_table(
    spark: SparkSession,
    table: str,
    path: str,
    add: dict[str, str] | None = None,
    drop: Sequence[str] = (),
) -> None:
    """Add columns in place; dropping rewrites the table."""
    if drop:
        by = [c for c in _partitions(spark, table) if c not in drop]
        replace_table(evolve(spark.table(table), add, drop), table, path, by)
        return
    for name, type_ in (add or {}).items():
        if name not in spark.table(table).columns:
            spark.sql(f"ALTER TABLE {table} ADD COLUMN {name} {type_}")
