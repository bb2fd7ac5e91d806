"""A stored Type 2 history: a table cut by key bucket and by the month a version ended.

    <root>/by_<buckets>/bucket=<n>/closed=current/...     current versions of the bucket's keys
    <root>/by_<buckets>/bucket=<n>/closed=2024-03/...     versions that ended in March

``key_hash`` identifies a key (also with nulls in it); Spark buckets the files by it, and
``bucket`` is that very bucket. A batch is therefore joined to the state without moving the state, and
replaces only the partitions of the buckets that hold its keys: the current versions and the
month of the batch. A load that changes the past replaces all months of its buckets. Other
files are not touched. ``as_of`` reads the months from its time on.

Writing is one job that replaces partitions when it ends. Every step can be repeated: a batch
that is in already changes nothing. A partition that is left without versions keeps a row
without a key, which readers skip, so that it too is replaced by the write alone.

A bucket is one task of the join: take as many buckets as the state has parts of a task's
size. Their number belongs to the table; another number is another table. One load at a time
may write. While it writes, Spark's mode of overwriting partitions is ``dynamic`` in the
session.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankmart.functions.hashing import hash_diff
from rankmart.operators.scd2 import (
    FIRST,
    scd2_as_of,
    scd2_from_batches,
    scd2_merge,
    scd2_open,
)
from rankmart.sources.tables import overwrite_partitions, put_partitions, table_at

BUCKETS = 8
KEY, BUCKET, CLOSED = "key_hash", "bucket", "closed"
CURRENT = "current"


def month(time: Column | datetime) -> Column:
    """The month by UTC, whatever the zone of the session."""
    time = time if isinstance(time, Column) else F.lit(time)
    return F.date_format(F.to_utc_timestamp(time, F.current_timezone()), "yyyy-MM")


class History:
    """State of one domain below ``root``; ``schema`` is the silver schema."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        keys: Sequence[str],
        tracked: Sequence[str],
        buckets: int = BUCKETS,
    ):
        self.spark = spark
        self.schema = schema
        self.keys = list(keys)
        self.tracked = list(tracked)
        self.buckets = buckets
        stored = StructType(list(schema.fields)).add(KEY, "string").add(BUCKET, "integer")
        self.table = table_at(
            spark,
            f"{root}/by_{buckets}",
            stored.add(CLOSED, "string"),
            [BUCKET, CLOSED],
            (KEY, buckets),
        )

    def _keyed(self, rows: DataFrame) -> DataFrame:
        """With the key's hash and its bucket, the one that Spark puts it in."""
        keyed = rows.withColumn(KEY, hash_diff(self.keys))
        return keyed.withColumn(BUCKET, F.pmod(F.hash(KEY), F.lit(self.buckets)))

    def _rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _versions(self, rows: DataFrame) -> DataFrame:
        return rows.filter(F.col(KEY).isNotNull()).select(*self.schema.names)

    def current(self) -> DataFrame:
        """The current versions."""
        return self._versions(self._rows().filter(F.col(CLOSED) == CURRENT))

    def state(self) -> DataFrame:
        """All versions of all keys."""
        return self._versions(self._rows())

    def since(self, t: datetime | Column) -> DataFrame:
        """The versions that began or ended at ``t`` or later; earlier months are not read."""
        time = t if isinstance(t, Column) else F.lit(t)
        rows = self._rows().filter((F.col(CLOSED) == CURRENT) | (F.col(CLOSED) >= month(t)))
        recent = (F.col("start_date") >= time) | (F.col("end_date") >= time)
        return self._versions(rows.filter(recent))

    def as_of(self, t: datetime | Column) -> DataFrame:
        """The versions valid at ``t``; months that ended before are not read."""
        ended_later = (F.col(CLOSED) == CURRENT) | (F.col(CLOSED) >= month(t))
        return scd2_as_of(self._versions(self._rows().filter(ended_later)), t)

    def loads(self) -> DataFrame:
        """What each batch time opened and closed, and the current versions after it."""
        versions = self.state()
        opened = versions.select(F.col("start_date").alias("at"), F.lit(1).alias("n"))
        closed = versions.filter("NOT is_current").select(
            F.col("end_date").alias("at"), F.lit(-1).alias("n")
        )
        times = opened.unionAll(closed).groupBy("at").agg(
            F.count_if(F.col("n") > 0).alias("opened_rows"),
            F.count_if(F.col("n") < 0).alias("closed_rows"),
        )
        # One row per batch.
        until = W.orderBy("at").rowsBetween(W.unboundedPreceding, 0)
        left = F.sum(F.col("opened_rows") - F.col("closed_rows")).over(until)
        return times.withColumn("current_rows", left)

    def merged(
        self, versions: DataFrame, buckets: Sequence[int], since: Column, end: Column | None = None
    ) -> DataFrame:
        """The partitions of some buckets after ``versions``: the current ones and those of
        the months from ``since`` on. The stored side of the join stays where it is."""
        held = self._rows().filter(F.col(BUCKET).isin(list(buckets)))
        held = held.filter((F.col(CLOSED) == CURRENT) | (F.col(CLOSED) >= month(since)))
        real = held.filter(F.col(KEY).isNotNull())
        current = real.filter(F.col(CLOSED) == CURRENT).drop(BUCKET, CLOSED)
        after = scd2_merge(current, versions, KEY, end)
        closed = real.filter(F.col(CLOSED) != CURRENT).drop(BUCKET, CLOSED)
        return self._placed(after.unionByName(closed), held)

    def _placed(self, rows: DataFrame, replaced: DataFrame) -> DataFrame:
        """Rows with their partition, and one row without a key for each replaced partition."""
        bucket = F.pmod(F.hash(KEY), F.lit(self.buckets))
        closed = F.when(F.col("is_current"), CURRENT).otherwise(month(F.col("end_date")))
        placed = rows.select(*self._columns(), KEY).withColumns({BUCKET: bucket, CLOSED: closed})
        marks = replaced.select(BUCKET, CLOSED).distinct()
        return placed.unionByName(marks, allowMissingColumns=True)

    def _columns(self) -> list[Column]:
        return [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]

    def _touched(self, rows: DataFrame) -> list[int]:
        """At most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())

    def apply(self, updates: DataFrame, as_of: datetime, close_missing: bool = False) -> None:
        """Apply one batch, at most one row per key, later than all before.

        Fails, and writes nothing, if a changed key has a version that starts at ``as_of`` or
        after it. With ``close_missing``, keys that are not in the batch end.
        """
        opened = self._keyed(scd2_open(updates, self.tracked, as_of))
        every = list(range(self.buckets))
        touched = every if close_missing else self._touched(opened)
        if touched:
            end = F.lit(as_of) if close_missing else None
            opened = opened.withColumn(FIRST, F.lit(True))
            put_partitions(self.merged(opened, touched, F.lit(as_of), end), self.table)

    def catch_up(self, batches: DataFrame, batch: str) -> None:
        """Apply many batches in one pass; ``batch`` is each row's batch time.

        All batch times must be later than every start date of the state.
        """
        rows = self._keyed(batches)
        touched = self._touched(rows)
        if touched:
            versions = scd2_from_batches(rows, self.keys, self.tracked, batch, first=FIRST)
            since = batches.agg(F.min(batch)).first()[0]
            put_partitions(self.merged(versions, touched, F.lit(since)), self.table)

    def rewritten(self, batches: DataFrame, batch: str, buckets: Sequence[int]) -> DataFrame:
        """All partitions of some buckets with the versions of the keys in ``batches`` anew."""
        keyed = self._keyed(batches)
        redone = scd2_from_batches(keyed, self.keys, self.tracked, batch)
        held = self._rows().filter(F.col(BUCKET).isin(list(buckets)))
        keys = keyed.select(KEY).distinct()
        others = held.filter(F.col(KEY).isNotNull()).join(keys, KEY, "left_anti")
        columns = [*self.schema.names, KEY]
        return self._placed(others.select(*columns).unionByName(redone.select(*columns)), held)

    def rewrite(self, batches: DataFrame, batch: str) -> None:
        """Replace all versions of the keys in ``batches`` by those that it gives.

        ``batches`` holds everything ever seen of its keys, so that what arrives late
        takes its place in time. Versions of other keys stay.
        """
        touched = self._touched(self._keyed(batches))
        if touched:
            # Gathered by partition: every task holds rows of many.
            overwrite_partitions(self.rewritten(batches, batch, touched), self.table)
