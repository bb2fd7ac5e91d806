"""Versions stored beside their predecessors, kept up to date load by load.

    <root>/by_<buckets>/bucket=<n>/left=current/...     last versions of the bucket's keys
    <root>/by_<buckets>/bucket=<n>/left=2024-03/...     versions that later loads never read

A progression compares each version with the one before it. Of the past, a load needs but one
row per key, the last. Those rows, and all current versions, lie in ``left=current``; a version
goes to the month in which it had both ended and found a successor. A load therefore reads and
replaces, for the buckets of its keys alone, the current rows and the months from its time on.

``load`` is given what began or ended at ``since`` or later and restates the keys in it from
there: it can be repeated, and a load of the past is one with an earlier ``since``. Writing is
one job that replaces partitions when it ends. A partition that is left without versions keeps
a row without a bucket's key, which readers skip. One load at a time may write; while it writes,
Spark's mode of overwriting partitions is ``dynamic`` in the session.

Null keys are keys; an empty load changes nothing; versions of one key that start together
stand in the order of ``world``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankmart.functions.hashing import hash_diff
from rankmart.operators.slices import ROWS_PER_SLICE, slice_rows, with_next, with_previous
from rankmart.sources.history import BUCKETS, CURRENT, month
from rankmart.sources.tables import put_partitions, table_at

KEY, BUCKET, LEFT = "key_hash", "bucket", "left"
END = "end_date"


class Progressions:
    """Versions with the ``values`` of their predecessors, below ``root``.

    ``schema`` is that of the versions, with ``END`` and ``is_current``. ``keys`` say what is
    followed, ``order`` how, its first column being the start; ``values`` are the columns
    taken over: ``{new name: column}``.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        keys: Sequence[str],
        order: Sequence[str],
        values: Mapping[str, str],
        buckets: int = BUCKETS,
    ):
        self.spark = spark
        self.versions = list(schema.names)
        self.keys, self.order, self.values = list(keys), list(order), dict(values)
        self.start = self.order[0]
        self.buckets = buckets
        stored = StructType(list(schema.fields))
        for new, old in self.values.items():
            stored = stored.add(new, schema[old].dataType)
        self.columns = list(stored.names)
        stored = stored.add(KEY, "string").add(BUCKET, "integer").add(LEFT, "string")
        self.table = table_at(spark, f"{root}/by_{buckets}", stored, [BUCKET, LEFT])

    def pairs(self) -> DataFrame:
        """All versions with the values of the one before, null for the first of a key."""
        rows = self.spark.table(self.table).filter(F.col(KEY).isNotNull())
        return rows.select(*self.columns)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        keyed = rows.withColumn(KEY, hash_diff(self.keys))
        return keyed.withColumn(BUCKET, F.pmod(F.hash(KEY), F.lit(self.buckets)))

    def _held(self, buckets: Sequence[int], since: datetime | Column) -> DataFrame:
        """The partitions that a load from ``since`` on replaces."""
        rows = self.spark.table(self.table).filter(F.col(BUCKET).isin(list(buckets)))
        return rows.filter((F.col(LEFT) == CURRENT) | (F.col(LEFT) >= month(since)))

    def _before(self, held: DataFrame, changes: DataFrame, since: Column) -> DataFrame:
        """The held versions from before ``since``, ended as the changes say."""
        version = [KEY, *self.order]
        ended = changes.filter(F.col(self.start) < since).select(
            *[F.col(c).alias(f"_{c}") for c in version],
            F.col(END).alias("_end"),
        )
        same = F.lit(True)
        for c in version:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        reopened = F.when(F.col(END) < since, F.col(END))
        end = F.coalesce("_end", reopened)
        was_ended = F.col("_end").isNotNull() | reopened.isNotNull()
        old = held.filter(F.col(self.start) < since)
        joined = old.join(ended, same, "left")
        # A version that ended before stays as it is; one of now is current without an end.
        columns = [c for c in (*self.columns, KEY) if c not in (END, "is_current")]
        return joined.select(*columns, end.alias(END), (~was_ended).alias("is_current"))

    def merged(
        self,
        changes: DataFrame,
        since: datetime | Column,
        buckets: Sequence[int],
        rows_per_slice: int = ROWS_PER_SLICE,
    ) -> DataFrame:
        """The partitions of some buckets after the changes of their keys."""
        since = since if isinstance(since, Column) else F.lit(since)
        changes = self._keyed(changes)
        held = self._held(buckets, since)
        real = held.filter(F.col(KEY).isNotNull())
        keys = changes.select(KEY).distinct()
        others = real.join(keys, KEY, "left_anti")
        old = self._before(real.join(keys, KEY, "left_semi"), changes, since)
        new = changes.filter(F.col(self.start) >= since).select(*self.versions, KEY)
        known = old.withColumn("_new", F.lit(False)).unionByName(
            new.withColumn("_new", F.lit(True)), allowMissingColumns=True
        )
        # All that is known and some more, without the joins.
        like = real.select(KEY, *self.order).unionByName(new.select(KEY, *self.order))
        sliced = slice_rows(known, [KEY], self.order, rows_per_slice, like)
        near = {f"_before_{name}": column for name, column in self.values.items()}
        beside = with_next(with_previous(sliced, near), {"_next": self.start}).result()
        filled = {
            name: F.when(F.col("_new"), F.col(f"_before_{name}")).otherwise(F.col(name))
            for name in self.values
        }
        # What is current or last is needed by later loads; all else leaves for good.
        needed = F.col("is_current") | F.col("_next").isNull()
        left = F.when(needed, CURRENT).otherwise(month(F.greatest(END, "_next")))
        changed = beside.withColumns(filled).withColumn(LEFT, left)
        columns = [*self.columns, KEY, LEFT]
        rows = changed.select(*columns).unionByName(others.select(*columns))
        rows = rows.withColumn(BUCKET, F.pmod(F.hash(KEY), F.lit(self.buckets)))
        marks = held.select(BUCKET, LEFT).distinct()
        return rows.unionByName(marks, allowMissingColumns=True)

    def load(
        self,
        changes: DataFrame,
        since: datetime | Column,
        rows_per_slice: int = ROWS_PER_SLICE,
    ) -> None:
        """Take in all versions that began or ended at ``since`` or later.

        ``changes`` is a stored table or a cheap read: it is gone through several times.
        """
        changes = changes.select(*self.versions)
        # At most as many numbers as there are buckets.
        touched = sorted(r[0] for r in self._keyed(changes).select(BUCKET).distinct().collect())
        if touched:
            put_partitions(self.merged(changes, since, touched, rows_per_slice), self.table)
