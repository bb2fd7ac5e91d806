"""Checks on frames and on versioned state."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``df`` itself, or ``ValueError`` naming the missing columns."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def validate(
    df: DataFrame | None, expected_columns: Iterable[str] = (), min_rows: int = 1
) -> bool:
    """Whether the frame has the columns and at least ``min_rows`` rows (one at least)."""
    if df is None or not set(expected_columns) <= set(df.columns):
        return False
    needed = max(min_rows, 1)
    return df.limit(needed).count() == needed


def reject_counts(df: DataFrame, rejected: Mapping[str, Column]) -> DataFrame:
    """One row: how many values of each column could not be parsed."""
    return df.agg(*[F.count_if(flag).alias(name) for name, flag in rejected.items()])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, with the number of rows as ``rows``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def duplicate_current_keys(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Business keys with more than one current version; empty when the state is sound."""
    return duplicate_keys(state.filter("is_current"), keys)


def audit(state: DataFrame) -> DataFrame:
    """One row: total and current versions."""
    return state.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if("is_current").alias("current_rows"),
    )
