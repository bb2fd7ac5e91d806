"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the greatest ``newest`` columns for each key.

    Ties fall to the greatest remaining columns, so the survivor does not depend on
    the partitioning. It is an aggregate, not a window: copies of a hot key are
    reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    priority = [*newest, *[c for c in rest if c not in newest]]
    if not priority:
        return df.select(*keys).distinct()
    survivor = F.max(F.struct(*priority)).alias("_row")
    return df.groupBy(*keys).agg(survivor).select(
        *[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
    )
