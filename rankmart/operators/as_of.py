"""Rows joined to the version that was valid at their own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmart.operators.slices import ROWS_PER_SLICE, slice_rows, with_carried

_AT, _KIND, _ROW, _VERSION, _VALID = "_at", "_kind", "_row", "_version", "_valid"


def as_of_join(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    time: str,
    start: str = "start_date",
    end: str = "end_date",
    how: str = "left",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Each row with the columns of the version of its key that holds at its ``time``.

    A version holds from ``start`` until before ``end`` (null: for good); versions of a key do
    not overlap. Keys may be null and equal each other then. A row without a version, or
    without a time, has nulls, or is left out with ``how="inner"``. The columns of
    ``versions`` other than the keys are added and must have names of their own.

    There is no join on a range: versions and rows go into one order of time by key, and the
    last version is carried forward to the rows behind it. That costs one shuffle of both,
    however many versions a key has, and hot keys are cut into slices of time.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unknown join: {how}")
    added = [c for c in versions.columns if c not in keys]
    twice = sorted(set(added) & set(rows.columns))
    if twice:
        raise ValueError(f"columns on both sides: {twice}")
    version, row = F.struct(*added), F.struct(*rows.columns)
    left = versions.filter(F.col(start).isNotNull()).select(
        *keys, F.col(start).alias(_AT), F.lit(0).alias(_KIND), version.alias(_VERSION)
    )
    right = rows.select(*keys, F.col(time).alias(_AT), F.lit(1).alias(_KIND), row.alias(_ROW))
    # At equal times the version comes first: it holds from its start on.
    both = left.unionByName(right, allowMissingColumns=True)
    sliced = slice_rows(both, keys, [_AT, _KIND], rows_per_slice)
    found = with_carried(sliced, {_VALID: _VERSION}).result().filter(F.col(_KIND) == 1)
    until = F.col(_VALID)[end]
    holds = F.col(_VALID).isNotNull() & F.col(_AT).isNotNull()
    holds &= until.isNull() | (until > F.col(_AT))
    if how == "inner":
        found = found.filter(holds)
    return found.select(
        *[F.col(_ROW)[c].alias(c) for c in rows.columns],
        *[F.when(holds, F.col(_VALID)[c]).alias(c) for c in added],
    )
