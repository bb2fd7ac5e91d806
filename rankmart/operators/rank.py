"""Row-number rankings over a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankmart.operators.slices import (
    ROWS_PER_SLICE,
    slice_rows,
    sort_columns,
    with_row_number,
)


def global_rank(
    df: DataFrame,
    order: Sequence[str],
    name: str = "rank",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Number all rows in ``order`` (``"-column"`` sorts descending)."""
    return group_rank(df, [], order, name, rows_per_slice)


def group_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "rank",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Number the rows of each key in ``order``."""
    return with_row_number(slice_rows(df, keys, order, rows_per_slice), name).result()


def top_n(df: DataFrame, order: Sequence[str], n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows with their rank, without ranking the rest."""
    first = df.orderBy(*sort_columns(order)).limit(n)
    number = F.row_number().over(W.orderBy(*sort_columns(order)))
    return first.withColumn(name, number.cast("bigint"))
