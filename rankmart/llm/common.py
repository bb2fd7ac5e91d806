"""What several operators share: stored intermediate tables, words, gapless numbers."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankmart.session import scratch_path

ROW = "_row"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_dropped(spark: SparkSession) -> Iterator[None]:
    """Statements inside leave no shuffle files behind. The setting is put back after."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


_OPEN = threading.local()


Table = tuple[str, StructType]


@contextmanager
def scratch(spark: SparkSession, keep: list[Table] | None = None) -> Iterator[None]:
    """Tables stored inside are emptied at the end, but for those that outlive it.

    Those go to the scope around, if there is one. With ``keep`` nothing is emptied; all
    tables are listed there, to be emptied later. Scopes belong to their thread.
    """
    scopes = vars(_OPEN).setdefault("scopes", [])
    made: list[Table] = []
    outliving: list[Table] = []
    scopes.append((made, outliving))
    try:
        yield
    finally:
        scopes.pop()
        if keep is not None:
            keep += made + outliving
        else:
            if scopes:
                scopes[-1][0].extend(outliving)
            for path, schema in made:
                emptied(spark, path, schema)


def emptied(spark: SparkSession, path: str, schema: StructType) -> None:
    """Gives the files of a stored table back; its folder stays, without rows."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def stored(
    df: DataFrame, name: str, by: Sequence[str] = (), outlives: bool = False
) -> DataFrame:
    """``df`` written once below the shared folder and read back.

    This cuts the lineage: what follows reads files that every executor sees, so a lost
    executor costs no more than its tasks. The shuffle files of the write are dropped
    when it ends, so that a chain of steps needs the disk of its largest step. ``by`` are
    columns to cut the table by; ``outlives`` tells that it is needed after the scope.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    with shuffle_files_dropped(df.sparkSession):
        (df.write.partitionBy(*by) if by else df.write).parquet(path)
    scopes = vars(_OPEN).get("scopes")
    if scopes:
        scopes[-1][outlives].append((path, df.schema))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def text_key(text: str = "text") -> Column:
    """Tells rows of one ``doc_id`` with different texts apart."""
    return F.xxhash64(text_or_empty(text))


def ascii_words(text: Column) -> Column:
    """Words of letters, digits and all characters beyond ASCII, A-Z lower-cased.

    ``lower`` also changes letters beyond ASCII. That alters no comparison with ASCII
    words: the one such letter whose lower case is ASCII, the Kelvin sign, is exchanged
    before, and a dotted capital I keeps its dot as a character of the word.
    """
    lowered = F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u2126")))
    parts = F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(parts, "")


def with_row_number(df: DataFrame) -> DataFrame:
    """A number per row, different for each; it lasts once the rows are stored."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def gapless(
    rows: DataFrame, keys: Sequence[str], name: str, total: int, per_task: int = 50_000
) -> DataFrame:
    """Numbers from 0 without gaps within ``keys``, in any order, as column ``name``.

    ``rows`` is a stored table with ``ROW``; ``total`` is its number of rows. A key's
    rows are spread over buckets by a hash of their row number, numbered there, and moved
    by the sizes of the buckets before, so that no task holds a whole key.
    """
    bucket, start = f"{name}_bucket", f"{name}_start"
    buckets = max(1, -(-total // per_task))
    placed = rows.withColumn(bucket, F.pmod(F.xxhash64(ROW), F.lit(buckets)))
    sizes = placed.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        *keys, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(start)
    )
    inside = F.row_number().over(W.partitionBy(*keys, bucket).orderBy(ROW)) - 1
    numbered = placed.withColumn(name, inside.cast("long"))
    joined = numbered.join(starts, [*keys, bucket])
    return joined.withColumn(name, F.col(name) + F.col(start)).drop(bucket, start)
