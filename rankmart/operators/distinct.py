"""Distinct players for any filter, from bitmaps instead of the rows.

Every name gets a number. A cell, such as a world on a day, holds its players as bitmaps of
``2**15`` numbers each; the players of any union of cells are the bits of their bitmaps put
together, exactly. Bitmaps of further cells are added without touching those there.

Numbers go by ``near`` and name, so that the players of one world lie in few bitmaps. A name
keeps its number for good: names seen later are numbered behind the last.

Null names are no players, as in ``COUNT(DISTINCT)``; null values of a cell's columns are values;
no rows give no cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmart.operators.slices import ROWS_PER_SLICE, slice_rows, with_row_number

NUMBER, BUCKET, BITS = "number", "bitmap", "players"


def numbered(
    rows: DataFrame,
    name: str,
    near: str,
    known: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``name`` and ``NUMBER``, gapless, of all names in ``rows`` and ``known``.

    ``known`` is an earlier result; its names keep their numbers. Names are aggregated before
    they are ordered, and ordered in slices, so neither a frequent name nor all names meet in
    one task. Store the result: it decides what the bitmaps mean.
    """
    names = rows.filter(F.col(name).isNotNull()).groupBy(name).agg(F.min(near).alias("_near"))
    if known is not None:
        names = names.join(known.select(name), name, "left_anti")
    placed = with_row_number(slice_rows(names, [], ["_near", name], rows_per_slice), NUMBER)
    fresh = placed.result().select(name, NUMBER)
    if known is None:
        return fresh
    last = known.agg(F.coalesce(F.max(NUMBER), F.lit(0).cast("long")).alias("last"))
    behind = fresh.withColumn(NUMBER, F.col(NUMBER) + last.scalar())
    return known.select(name, NUMBER).unionAll(behind)


def player_bitmaps(
    rows: DataFrame, name: str, cells: Sequence[str], numbers: DataFrame
) -> DataFrame:
    """For each cell its players: one row for each of its bitmaps that is not empty."""
    seen = rows.filter(F.col(name).isNotNull()).select(name, *cells).distinct()
    placed = seen.join(numbers.select(name, NUMBER), name)
    bucket = F.bitmap_bucket_number(NUMBER).alias(BUCKET)
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(NUMBER)))
    return placed.groupBy(*cells, bucket).agg(bits.alias(BITS))


def distinct_players(
    bitmaps: DataFrame, sets: Sequence[Sequence[str]] = ((),), name: str = "players_count"
) -> DataFrame:
    """Distinct players by each of several sets of the cells' columns.

    Filter the bitmaps before for a part of the cells. A column that is not in a set is null;
    ``set_id`` tells that from a null value: its bits, the last column's lowest, are set for
    columns left out.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    united = bitmaps.groupingSets(
        [[F.col(BUCKET), *map(F.col, s)] for s in sets], F.col(BUCKET), *map(F.col, columns)
    ).agg(F.bitmap_or_agg(F.col(BITS)).alias(BITS), F.grouping_id().alias("set_id"))
    counted = F.sum(F.bitmap_count(F.col(BITS))).cast("long").alias(name)
    return united.groupBy(*columns, "set_id").agg(counted)
