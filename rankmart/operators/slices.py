"""Ordered windows that no hot key can overload.

``Window.partitionBy(key)`` puts every row of a key into one task, and a window
without a key puts the whole table there. Here a key with more rows than one task
should hold is cut into *slices*, i.e. ranges of its order columns:

1. Count the rows. A few slices' worth of rows fit one task and need no slicing.
2. Sample the key and order columns and take every n-th sampled row of a key as a
   cut point. Keys with too few sampled rows get none and stay whole. There are at
   most ``MAX_SLICES`` cut points or so; they are frozen on the driver, so that each
   later evaluation of the plan cuts in the same places, also after a lost executor.
3. A row's slice is the number of cut points at or before it (binary search).
4. The window runs per (key, slice). What it cannot see across the slice border
   (last row of the slice before, rows counted so far) comes from one small
   aggregate per hot slice, broadcast back. Its size is bounded by the cut points.

The sample decides only where the cuts fall, never a result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

# Slices are hashed to tasks, so they are smaller than a task's share: several small
# ones even out where a few large ones would collide.
ROWS_PER_SLICE = 250_000
SLICES_PER_TASK = 4
MAX_SLICES = 1 << 15
SAMPLES_PER_SLICE = 32

SLICE = "_slice"
_CUTS = "_cuts"
_HOT = "_hot"


@dataclass(frozen=True)
class Sliced:
    """Rows ready for windows over (keys, order); ``hot`` says whether slices exist."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    hot: bool

    def on(self, df: DataFrame) -> Sliced:
        """The same slicing for rows derived from ``df`` (slice column kept)."""
        return replace(self, df=df)

    def window(self) -> WindowSpec:
        parts = [*self.keys, SLICE] if self.hot else list(self.keys)
        return W.partitionBy(*parts).orderBy(*sort_columns(self.order))

    def result(self) -> DataFrame:
        return self.df.drop(SLICE, _HOT)


def order_name(key: str) -> str:
    return key.removeprefix("-")


def sort_columns(order: Sequence[str]) -> list[Column]:
    """``"a"`` sorts ascending with NULLs first, ``"-a"`` descending with NULLs last."""
    return [
        F.desc_nulls_last(order_name(k)) if k.startswith("-") else F.asc_nulls_first(k)
        for k in order
    ]


def _stretches(order: Sequence[str]) -> list[tuple[bool, list[str]]]:
    """The order columns by stretches of one direction: whether it descends, and the names."""
    return [
        (down, [order_name(k) for k in run])
        for down, run in groupby(order, lambda k: k.startswith("-"))
    ]


def _places(order: Sequence[str]) -> dict[str, Column]:
    """One struct for each stretch of the order."""
    return {f"_place{i}": F.struct(*names) for i, (_, names) in enumerate(_stretches(order))}


def _at_or_after(order: Sequence[str], cut: Column) -> Column:
    """Whether the row sorts at or after ``cut``, under :func:`sort_columns`; both have
    :func:`_places`.

    Structs compare field by field, NULLs first. Turned round, that is descending with
    NULLs last.
    """
    result = None
    for (down, _), place in reversed(list(zip(_stretches(order), _places(order)))):
        low, high = (F.col(place), cut[place]) if down else (cut[place], F.col(place))
        result = high >= low if result is None else (high > low) | ((high == low) & result)
    return F.lit(True) if result is None else result


def _with_slice_number(df: DataFrame, order: Sequence[str], most_cuts: int) -> DataFrame:
    """Binary search: the largest n such that the n-th cut is at or before the row.

    Each step is a column, so that it is compiled; a lambda would be interpreted. The result
    passes a generator of one row: where a join asks what its key is made of, Spark would
    write the steps into each other, which doubles the expression every time.
    """
    places, cuts = _places(order), F.col(_CUTS)
    found = df.withColumns({**places, SLICE: F.lit(0)})
    for bit in reversed(range(most_cuts.bit_length())):
        candidate = F.col(SLICE) + F.lit(1 << bit)
        hit = (candidate <= F.size(cuts)) & _at_or_after(order, F.get(cuts, candidate - 1))
        found = found.withColumn(SLICE, F.when(hit, candidate).otherwise(F.col(SLICE)))
    number = F.when(cuts.isNotNull(), F.col(SLICE))
    return found.withColumn(SLICE, F.explode(F.array(number))).drop(*places)


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for i, key in enumerate(keys):
        condition = condition & left[key].eqNullSafe(right[f"_k{i}"])
    return condition


def slice_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    like: DataFrame | None = None,
) -> Sliced:
    """Prepare ``df`` for windows over ``keys`` in ``order``.

    ``order`` must be a total order within a key, or equal rows land on either side
    of each other at random, as with any window. Where ``df`` is a long plan, ``like`` is a
    cheap one with the same key and order columns that holds its rows, and maybe more; it is
    counted and sampled in place of ``df``.
    """
    keys, order = tuple(keys), tuple(order)
    names = [order_name(k) for k in order]
    narrow = (df if like is None else like).select(*dict.fromkeys([*keys, *names]))

    total = narrow.count()
    if total <= rows_per_slice * SLICES_PER_TASK:
        return Sliced(df, keys, order, hot=False)

    slices = min(MAX_SLICES, math.ceil(total / rows_per_slice))
    fraction = min(1.0, slices * SAMPLES_PER_SLICE / total)
    step = max(1, round(fraction * total / slices))
    by_key = W.partitionBy(*keys).orderBy(*sort_columns(order))
    picked = (
        narrow.sample(fraction, seed=17)
        .withColumn("_pos", F.row_number().over(by_key))
        .filter(F.col("_pos") % step == 0)
    )
    frozen = picked.toArrow()
    if frozen.num_rows == 0:
        return Sliced(df, keys, order, hot=False)

    # At most sample size / step rows, i.e. about MAX_SLICES.
    places = [place.alias(name) for name, place in _places(order).items()]
    cuts = (
        df.sparkSession.createDataFrame(frozen, schema=picked.schema)
        .groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        .agg(F.array_sort(F.collect_list(F.struct("_pos", *places))).alias(_CUTS))
    )
    if keys:
        marked = df.join(F.broadcast(cuts), _same_keys(df, cuts, keys), "left")
    else:
        marked = df.withColumn(_CUTS, cuts.scalar())
    sliced = _with_slice_number(marked, order, frozen.num_rows)
    sliced = sliced.withColumn(_HOT, F.col(_CUTS).isNotNull())
    return Sliced(sliced.drop(_CUTS, *cuts.columns), keys, order, hot=True)


def _per_slice(sliced: Sliced, aggregate: Column) -> DataFrame:
    """One row per slice of the hot keys; bounded by the number of cuts."""
    renamed = [F.col(k).alias(f"_k{i}") for i, k in enumerate(sliced.keys)]
    return (
        sliced.df.filter(_HOT)
        .groupBy(*renamed, F.col(SLICE).alias("_s"))
        .agg(aggregate.alias("_agg"))
    )


def _slices_of_key(sliced: Sliced) -> WindowSpec:
    return W.partitionBy(*[f"_k{i}" for i in range(len(sliced.keys))]).orderBy("_s")


def _join_slices(df: DataFrame, sliced: Sliced, small: DataFrame) -> DataFrame:
    on = _same_keys(df, small, sliced.keys) & (df[SLICE] == small["_s"])
    return df.join(F.broadcast(small), on, "left")


def with_row_number(sliced: Sliced, name: str) -> Sliced:
    """Position of each row within its key, from 1, as bigint."""
    local = F.row_number().over(sliced.window()).cast("bigint")
    if not sliced.hot:
        return sliced.on(sliced.df.withColumn(name, local))
    counted = _per_slice(sliced, F.count(F.lit(1)))
    earlier = _slices_of_key(sliced).rowsBetween(W.unboundedPreceding, -1)
    offsets = counted.withColumn("_offset", F.sum("_agg").over(earlier))
    columns = sliced.df.columns
    numbered = _join_slices(sliced.df.withColumn("_local", local), sliced, offsets)
    rank = F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0))
    return sliced.on(numbered.select(*columns, rank.alias(name)))


def _with_neighbour(sliced: Sliced, values: Mapping[str, str], forward: bool) -> Sliced:
    shift = F.lead if forward else F.lag
    if not sliced.hot:
        shifted = {new: shift(old).over(sliced.window()) for new, old in values.items()}
        return sliced.on(sliced.df.withColumns(shifted))
    row = F.struct(*[F.col(old).alias(new) for new, old in values.items()])
    edge = F.min_by if forward else F.max_by
    placed, place = sliced, F.struct(*[F.col(order_name(k)) for k in sliced.order])
    if any(k.startswith("-") for k in sliced.order):
        # A struct compares ascending only; the position in the slice knows every order.
        place = F.row_number().over(sliced.window())
        placed, place = sliced.on(sliced.df.withColumn("_place", place)), F.col("_place")
    edges = _per_slice(placed, edge(row, place))
    beyond = edges.withColumn("_beyond", shift("_agg").over(_slices_of_key(sliced)))
    columns = sliced.df.columns
    local = sliced.df.withColumn("_near", shift(row).over(sliced.window()))
    joined = _join_slices(local, sliced, beyond)
    found = F.coalesce(F.col("_near"), F.col("_beyond"))
    return sliced.on(joined.select(*columns, *[found[new].alias(new) for new in values]))


def with_previous(sliced: Sliced, values: Mapping[str, str]) -> Sliced:
    """Add columns of the row before, within the key: ``{new name: column}``."""
    return _with_neighbour(sliced, values, forward=False)


def with_next(sliced: Sliced, values: Mapping[str, str]) -> Sliced:
    """Add columns of the row after, within the key: ``{new name: column}``."""
    return _with_neighbour(sliced, values, forward=True)


def with_carried(sliced: Sliced, values: Mapping[str, str]) -> Sliced:
    """Add the last value that is not null, at or before the row, within the key:
    ``{new name: column}``. The order columns are ascending."""
    until = sliced.window().rowsBetween(W.unboundedPreceding, 0)
    near = {new: F.last(old, ignorenulls=True).over(until) for new, old in values.items()}
    if not sliced.hot:
        return sliced.on(sliced.df.withColumns(near))
    place = F.struct(*sliced.order)
    lasts = [
        F.max_by(old, F.when(F.col(old).isNotNull(), place)).alias(new)
        for new, old in values.items()
    ]
    edges = _per_slice(sliced, F.struct(*lasts))
    earlier = _slices_of_key(sliced).rowsBetween(W.unboundedPreceding, -1)
    carried = [
        F.last(F.col("_agg")[new], ignorenulls=True).over(earlier).alias(new) for new in values
    ]
    beyond = edges.withColumn("_beyond", F.struct(*carried))
    columns = sliced.df.columns
    local = sliced.df.withColumns({f"_near_{new}": value for new, value in near.items()})
    joined = _join_slices(local, sliced, beyond)
    found = [
        F.coalesce(F.col(f"_near_{new}"), F.col("_beyond")[new]).alias(new) for new in values
    ]
    return sliced.on(joined.select(*columns, *found))
