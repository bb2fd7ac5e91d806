"""Type 2 history: versions with half-open validity ``[start_date, end_date)``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from rankmart.functions.hashing import hash_diff
from rankmart.operators.slices import ROWS_PER_SLICE, slice_rows, with_next, with_previous

VERSION_COLUMNS = ["start_date", "end_date", "is_current", "hash_diff"]
#: Whether a version is the first of its key in a pass over batches.
FIRST = "_first"


def _time(t: datetime | Column) -> Column:
    return t if isinstance(t, Column) else F.lit(t)


def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe key equality between two aliased frames."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def latest_batch(
    df: DataFrame, batch: str = "batch_id", time: str = "ingestion_time"
) -> DataFrame:
    """Rows of the batch loaded last; no rows for an empty frame.

    Of two batches with the same time the greater id wins.
    """
    newest = df.agg(F.max(F.struct(time, batch))[batch])
    return df.filter(F.col(batch) == newest.scalar())


def new_keys(current: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates whose key has no current version."""
    known = current.select(*keys).distinct()
    return updates.alias("u").join(known.alias("c"), same_key("u", "c", keys), "left_anti")


def changed_keys(
    current: DataFrame, updates: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Keys on both sides whose tracked values differ, with both hashes.

    Each side has at most one row per key.
    """
    old = current.select(*keys, hash_diff(tracked).alias("old_hash")).alias("c")
    new = updates.select(*keys, hash_diff(tracked).alias("new_hash")).alias("u")
    return (
        old.join(new, same_key("c", "u", keys))
        .filter("old_hash <> new_hash")
        .select("u.*", "old_hash")
    )


def scd2_open(df: DataFrame, tracked: Sequence[str], start: datetime | Column) -> DataFrame:
    """Rows as first, current versions starting at ``start``."""
    return df.withColumns(
        {
            "start_date": _time(start),
            "end_date": F.lit(None).cast(df.select(_time(start)).schema[0].dataType),
            "is_current": F.lit(True),
            "hash_diff": hash_diff(tracked),
        }
    )


def _version(side: str, fields: Sequence[StructField], **replaced: Column) -> Column:
    """A row of ``side`` as a struct in the state's column order and types."""
    values = [replaced.get(f.name, F.col(f"{side}.{f.name}")) for f in fields]
    return F.struct(*[v.cast(f.dataType).alias(f.name) for v, f in zip(values, fields)])


def scd2_step(
    current: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: datetime | Column,
    close_missing: bool = False,
    small_updates: bool = False,
) -> DataFrame:
    """The current versions after ``updates``, and the versions closed by it.

    Both inputs hold at most one row per key. One full outer join finds every case;
    a changed key yields two rows, the closed version and its successor. With
    ``small_updates`` the joins have the current versions on the left alone, so that Spark
    can broadcast the updates, if they are as small as it allows, and leave those in place.
    """
    fields = current.schema.fields
    c, u = current.alias("c"), scd2_open(updates, tracked, as_of).alias("u")
    on = same_key("c", "u", keys)

    known = F.col("c.is_current").isNotNull()
    present = F.col("u.hash_diff").isNotNull()
    changed = known & present & ~F.col("c.hash_diff").eqNullSafe(F.col("u.hash_diff"))
    closed = changed
    if close_missing:
        closed = closed | (known & ~present)
    opened = changed | (present & ~known)

    old = _version(
        "c",
        fields,
        end_date=F.when(closed, _time(as_of)).otherwise(F.col("c.end_date")),
        is_current=~closed,
    )
    new = _version("u", fields)
    both = F.inline(F.array_compact(F.array(F.when(known, old), F.when(opened, new))))
    if not small_updates:
        return c.join(u, on, "full_outer").select(both)

    # Keys of the updates that have a current version: no more than there are updates.
    met = c.join(u, on, "left_semi").select(*keys).alias("c")
    fresh = u.join(met, on, "left_anti").select(F.inline(F.array(new)))
    return c.join(u, on, "left").select(both).unionByName(fresh)


def scd2_apply(
    state: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: datetime | Column,
    close_missing: bool = False,
) -> DataFrame:
    """The whole state after one batch.

    Changed keys are closed at ``as_of`` and reopened with the new values, new keys
    are opened, everything else stays, including keys absent from the batch unless
    ``close_missing``. Reapplying a batch changes nothing.
    """
    stepped = scd2_step(
        state.filter("is_current"), updates, keys, tracked, as_of, close_missing
    )
    return state.filter("NOT is_current").unionByName(stepped)


def scd2_from_batches(
    df: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    batch: str,
    current: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    first: str | None = None,
) -> DataFrame:
    """All versions from many batches at once, one row per key and ``batch`` time.

    A row opens a version when its tracked values differ from the key's row in the
    batch before; the version ends where the next one starts. Equal to applying the
    batches one by one. ``current`` holds versions to continue from, all of which
    must start before the first batch; batches without a time are not allowed. ``first``
    names a column that tells the first version of each key.
    """
    rows = df.withColumns({"start_date": F.col(batch), "hash_diff": hash_diff(tracked)})
    if current is not None:
        carried = [c for c in current.columns if c not in ("end_date", "is_current")]
        rows = current.select(*carried).unionByName(rows.select(*carried))
    sliced = slice_rows(rows, keys, ["start_date"], rows_per_slice)
    compared = with_previous(sliced, {"_before": "hash_diff"})
    kept = compared.df.filter(~F.col("_before").eqNullSafe(F.col("hash_diff")))
    if first is not None:
        kept = kept.withColumn(first, F.col("_before").isNull())
    kept = kept.drop("_before")
    ended = with_next(compared.on(kept), {"end_date": "start_date"}).result()
    versions = ended.withColumn("is_current", F.col("end_date").isNull())
    others = [c for c in rows.columns if c not in VERSION_COLUMNS]
    return versions.select(*others, *VERSION_COLUMNS, *([first] if first else []))


def scd2_merge(
    current: DataFrame, versions: DataFrame, key: str, end: Column | None = None
) -> DataFrame:
    """Current versions continued by later ones, and those that this closes.

    ``versions`` come from one pass over later batches; ``FIRST`` marks the first of each
    key. ``key`` is one column that is never null and tells the keys apart on both sides.
    A first version with the values of the current one only carries it on. With ``end``,
    keys without a version end there. One join on ``key``, so that a side that is stored in
    buckets of it is not shuffled. A version that starts no later than a current one with
    other values fails the job.
    """
    fields = current.schema.fields
    c, v = current.alias("c"), versions.alias("v")
    known = F.col("c.is_current").isNotNull()
    present = F.col("v.hash_diff").isNotNull()
    first = present & F.coalesce(F.col(f"v.{FIRST}"), F.lit(False))
    carried = known & first & (F.col("c.hash_diff") == F.col("v.hash_diff"))
    backwards = F.col("v.start_date") <= F.col("c.start_date")
    refused = F.raise_error(F.lit("a batch time is not later than the start of a current version"))

    until = F.when(carried, F.col("v.end_date"))
    until = until.when(first & backwards, refused).when(first, F.col("v.start_date"))
    until = until.when(~present, end) if end is not None else until
    stays = F.when(carried, F.col("v.is_current")).otherwise(~present & F.lit(end is None))
    old = _version("c", fields, end_date=until, is_current=stays)
    new = _version("v", fields)
    # A current version meets all later ones of its key and goes out with the first.
    once = known & (first | ~present)
    rows = F.array(F.when(once, old), F.when(present & ~carried, new))
    joined = c.join(v, F.col(f"c.{key}") == F.col(f"v.{key}"), "full_outer")
    return joined.select(F.inline(F.array_compact(rows)))


def scd2_as_of(state: DataFrame, t: datetime | Column) -> DataFrame:
    """The versions valid at ``t``."""
    started = F.col("start_date") <= _time(t)
    not_ended = F.col("end_date").isNull() | (F.col("end_date") > _time(t))
    return state.filter(started & not_ended)
