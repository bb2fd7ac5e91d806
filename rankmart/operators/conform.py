"""Bring frames with differing headers into one schema, and stamp them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalise_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names with ``_`` for blanks."""
    names = [c.strip().lower().replace(" ", "_") for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns differ only in case or blanks: {twice}")
    return df.toDF(*names)


def rename_synonyms(df: DataFrame, synonyms: Mapping[str, str]) -> DataFrame:
    """Rename ``{old: new}`` where present; if both exist, fill ``new`` from ``old``."""
    for old, new in synonyms.items():
        if old in df.columns and new in df.columns:
            df = df.withColumn(new, F.coalesce(new, old)).drop(old)
        elif old in df.columns:
            df = df.withColumnRenamed(old, new)
    return df


def conform(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Exactly ``{name: type}``, in that order; a missing column is a typed NULL."""
    return df.select(
        *[
            (F.col(name) if name in df.columns else F.lit(None)).cast(type_).alias(name)
            for name, type_ in columns.items()
        ]
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stamp(
    df: DataFrame,
    batch_id: str,
    as_of: datetime | Column,
    source_system: str = "highscore_page",
) -> DataFrame:
    """Add the audit columns of a load; ``as_of`` is its time, never the clock's."""
    time = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.withColumns(
        {
            "ingestion_time": time,
            "ingestion_date": F.to_date(time),
            "source_system": F.lit(source_system),
            "batch_id": F.lit(batch_id),
        }
    )


def backfill(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Fill the NULLs of ``column`` from ``value``."""
    return df.withColumn(column, F.coalesce(F.col(column), value))


def evolve(
    df: DataFrame, add: Mapping[str, str] | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """Add typed NULL columns that are absent, and drop columns."""
    fresh = {n: F.lit(None).cast(t) for n, t in (add or {}).items() if n not in df.columns}
    return df.withColumns(fresh).drop(*drop) if fresh else df.drop(*drop)
