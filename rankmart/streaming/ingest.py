"""Incremental arrival: new landing files go once into bronze and into the history.

Rows pass a stateful step that lets equal rows of one extraction through once within
``REPEATS`` of their arrival, so a file that is delivered twice, under whatever name, counts
once. Its clock is the arrival, not the extraction: however old a file is, it is never too
late for it, and the state stays bounded. It has a hash of every row of these days, so it lies
in RocksDB, beside the heap of the executors; what has expired leaves with the next files, not
in a micro-batch of its own that goes through all of it. While the stream starts, the session's
settings of the two are changed.

A call is two streams. The first takes the files, in as many micro-batches as ``max_files``
asks for, and only stores the rows that pass (``<checkpoint>/arrived``, Spark's file sink). The
second loads all that has arrived since the last load, once: however many micro-batches the files
came in, bronze and the history are rewritten one time.

Bronze is a table of partitions (``late``, ``ingestion_date``). Rows extracted no later than
what bronze already holds are *late* and go to partitions of their own. Rows in time continue
the current versions; the keys of late rows are versioned anew from all their bronze rows. Both
replace partitions with what they hold already and the new rows, so a load that died, or a
lost checkpoint, repeats nothing and loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankmart.functions.hashing import hash_diff
from rankmart.operators.dedup import dedup
from rankmart.operators.scd2 import same_key
from rankmart.plans.bronze import (
    EXTRA_COLUMNS,
    EXTRA_KEYS,
    SKILLS_KEYS,
    SYNONYMS,
    VOCATION_KEYS,
    bronze_extra,
    bronze_skills,
    bronze_vocation,
)
from rankmart.plans.silver import DOMAINS
from rankmart.session import scratch_path
from rankmart.sources.domain import EXPERIENCE_HEADER, SKILLS_HEADER, TABLES
from rankmart.sources.history import History
from rankmart.sources.landing import ORIGIN, named_lines, with_origin
from rankmart.sources.tables import overwrite_partitions, setting, table_at

# domain: (landing folder, header or None where files differ, bronze step, key)
_STREAMS: dict[str, tuple[str, list[str] | None, Callable, list[str]]] = {
    "vocation": ("experience", EXPERIENCE_HEADER, bronze_vocation, VOCATION_KEYS),
    "skills": ("skills", SKILLS_HEADER, bronze_skills, SKILLS_KEYS),
    "extra": ("extra", None, bronze_extra, EXTRA_KEYS),
}

_DAY = {"year": "int", "month": "int", "day": "int"}
REPEATS = "7 days"
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def landed_at() -> Column:
    """Extraction time of a row: its day and run."""
    run = F.when(F.col("landing_run") != "", F.col("landing_run")).otherwise("000000")
    day = F.date_format(F.make_date("year", "month", "day"), "yyyyMMdd")
    return F.to_timestamp(F.concat(day, run), "yyyyMMddHHmmss")


def landing_stream(
    spark: SparkSession, root: str, domain: str, max_files: int | None = None
) -> DataFrame:
    """New header CSVs of a domain as a stream, with the day and origin of each row."""
    folder, header, _, _ = _STREAMS[domain]
    columns = ", ".join(f"`{c}` string" for c in header or ["value"])
    days = ", ".join(f"{c} {t}" for c, t in _DAY.items())
    reader = spark.readStream.schema(f"{columns}, {days}").option("basePath", f"{root}/{folder}")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = f"{root}/{folder}/year=*/month=*/day=*"
    if header:
        return with_origin(
            reader.option("header", True).option("enforceSchema", False).csv(path)
        )
    files = with_origin(reader.text(path, wholetext=True))
    wanted = {**EXTRA_COLUMNS, **_DAY, **{c: "string" for c in ORIGIN}}
    return named_lines(files, wanted, SYNONYMS)


def once(rows: DataFrame, within: str = REPEATS) -> DataFrame:
    """A stream without rows that repeat an earlier one of the same extraction."""
    content = [c for c in rows.columns if c != "source_file"]
    row = F.unhex(hash_diff(content))
    seen = rows.withColumns({"_arrived": F.current_timestamp(), "_row": row})
    kept = seen.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_row"])
    return kept.drop("_arrived", "_row")


def bronze_table(spark: SparkSession, path: str, domain: str) -> str:
    """The bronze table of a domain with its files at ``path``."""
    columns = StructType.fromDDL(TABLES[f"bronze.{domain}"][0])
    schema = StructType([f for f in columns.fields if f.name != "ingestion_date"])
    schema = schema.add("late", "boolean").add("ingestion_date", "date")
    return table_at(spark, path, schema, ["late", "ingestion_date"])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def add_to_bronze(rows: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Adds rows, one per key and time, to their partitions and returns them with ``late``.

    Of rows with one key and time one stays, where it is.
    """
    bronze = rows.sparkSession.table(table)
    last = bronze.agg(F.max("ingestion_date")).first()[0]
    newest = bronze.filter(F.col("ingestion_date") == F.lit(last))
    applied = newest.agg(F.max("ingestion_time")).first()[0] if last else None
    late = F.col("ingestion_time") <= F.lit(applied) if applied else F.lit(False)
    rows = rows.withColumn("late", late)
    # Days that bronze does not have yet are written as they are.
    days = rows.select("ingestion_date").distinct()
    met = bronze.select("ingestion_date").join(days, "ingestion_date", "left_semi").distinct()
    met = [r[0] for r in met.collect()]
    again = F.coalesce(F.col("ingestion_date").isin(met), F.lit(False))
    one = rows.select(*bronze.columns)
    if met:
        every = bronze.filter(again).unionByName(one.filter(again))
        every = every.withColumn("_in_time", ~F.col("late"))
        merged = dedup(every, [*keys, "ingestion_time", "ingestion_date"], ["_in_time"])
        one = merged.drop("_in_time").unionByName(one.filter(~again))
    overwrite_partitions(one, table)
    return rows


def ingest_available(
    spark: SparkSession,
    root: str,
    domain: str,
    bronze_path: str,
    history_root: str,
    checkpoint: str,
    max_files: int | None = None,
) -> History:
    """Ingest the files that arrived since the last call, then stop.

    Each row takes effect at the time its file was extracted, however late the file
    arrives and however files are dealt to micro-batches, so the history is that of all
    files in one pass. What a call that died left behind is taken by the next one.
    """
    _, _, to_bronze, keys = _STREAMS[domain]

    def load(arrived: DataFrame, number: int) -> None:
        session = arrived.sparkSession
        landed = arrived.withColumn("landed", landed_at())
        rows = _written(to_bronze(landed, f"{domain}-{number}", "landed"), "rows")
        if rows.isEmpty():
            return
        table = bronze_table(session, bronze_path, domain)
        rows = add_to_bronze(rows, table, keys)
        history = DOMAINS[domain].history(session, history_root)
        late = _written(rows.filter("late").select(*keys).distinct(), "late-keys")
        if late.isEmpty():
            history.catch_up(rows, "ingestion_time")
            return
        r, t = rows.alias("r"), late.alias("t")
        in_time = _written(r.join(t, same_key("r", "t", keys), "left_anti"), "in-time")
        history.catch_up(in_time, "ingestion_time")
        known = session.table(table).alias("r").join(t, same_key("r", "t", keys), "left_semi")
        batches = dedup(known.drop("late"), [*keys, "ingestion_time"], ["ingestion_time"])
        history.rewrite(_written(batches, "late"), "ingestion_time")

    rows = once(landing_stream(spark, root, domain, max_files))
    arrived = f"{checkpoint}/arrived"
    files = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", f"{checkpoint}/files")
        .trigger(availableNow=True)
    )
    # A stream keeps the settings that it started with.
    with ExitStack() as settings:
        for name, value in _STATE.items():
            settings.enter_context(setting(spark, name, value))
        taken = files.start(arrived)
    taken.awaitTermination()
    # Without a limit on files, one micro-batch has all that arrived.
    loaded = (
        spark.readStream.schema(rows.schema)
        .parquet(arrived)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{checkpoint}/loads")
        .trigger(availableNow=True)
        .start()
    )
    loaded.awaitTermination()
    return DOMAINS[domain].history(spark, history_root)
