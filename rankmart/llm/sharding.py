"""Sharding by vector bin packing.

Documents with equal texts are a group and stay together. A group weighs bytes, tokens and
rows; units are placed one after the other, the heaviest first, on the shard where the dot
product of the unit and the shard's residual capacity is largest.

The number of units is bounded whatever the number of groups. A group that holds more than
one part in ``UNITS`` of a shard's bytes, tokens or rows is a unit by itself; there can be
at most three times ``UNITS`` times the number of shards of them. All lighter groups are
dealt by a hash into ``UNITS`` units for each shard, whose weights are summed by Spark. A
group that is heavier than a shard is split into one unit for each shard.

Results for odd input: a null text weighs one byte, like an empty one, and is equal to it;
a null ``doc_id`` is kept; equal rows are placed each; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmart.llm.common import ROW, gapless, stored, text_or_empty, with_row_number

UNITS = 256
WEIGHTS = ("size", "tokens", "one")


def word_count(text: Column) -> Column:
    """A stand-in for tokens: words between white space."""
    trimmed = F.trim(text)
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"\s+"))).cast("long")


def vector_pack(units: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unit. ``units`` has a row for each unit, a column for each weight."""
    total = np.maximum(units.sum(axis=0), 1e-300)
    parts = units / total
    residual = np.full((shards, units.shape[1]), 1.0 / shards)
    placed = np.zeros(len(units), np.int64)
    for unit in np.argsort(-parts.max(axis=1), kind="stable"):
        shard = int((residual @ parts[unit]).argmax())
        placed[unit] = shard
        residual[shard] -= parts[unit]
    return placed


def shard_documents(
    docs: DataFrame,
    shards: int = 16,
    id: str = "doc_id",
    text: str = "text",
    tokens: Column | None = None,
    units: int = UNITS,
) -> DataFrame:
    """One row per document: ``size``, ``tokens``, checksum, ``shard`` and ``slot``.

    ``size`` is the text's bytes and one more; ``slot`` counts a shard's documents from 0.
    """
    whole = text_or_empty(text)
    rows = docs.select(
        F.col(id).alias("doc"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        (word_count(whole) if tokens is None else tokens.cast("long")).alias("tokens"),
        F.lit(1).cast("long").alias("one"),
        F.crc32(whole).cast("long").alias("text_crc32"),
        F.unhex(F.md5(whole)).alias("group"),
    )
    rows = stored(with_row_number(rows), "shard-rows")
    spark = docs.sparkSession
    total = rows.agg(*[F.coalesce(F.sum(w), F.lit(0)).alias(w) for w in WEIGHTS]).first()

    def part(weight: str) -> Column:
        return F.col(weight) / F.lit(float(max(1, total[weight])))

    groups = rows.groupBy("group").agg(*[F.sum(w).alias(w) for w in WEIGHTS])
    share = F.greatest(*[part(w) for w in WEIGHTS])
    heavy = groups.withColumn("share", share).filter(F.col("share") > 1.0 / (units * shards))
    # At most 3 * units * shards rows.
    found = heavy.select("group", "share").orderBy("group").collect()
    own, number = [], 0
    for row in found:
        pieces = shards if row["share"] * shards > 1 else 1
        own.append((row["group"], number, pieces))
        number += pieces
    own_units = spark.createDataFrame(own, "group binary, first long, pieces long")
    light = -1 - F.pmod(F.xxhash64("group"), F.lit(units * shards))
    split = F.col("first") + F.pmod(F.xxhash64(ROW), F.col("pieces"))
    united = rows.join(F.broadcast(own_units), "group", "left").withColumn(
        "unit", F.coalesce(split, light)
    )
    weighed = united.groupBy("unit").agg(*[F.sum(w).alias(w) for w in WEIGHTS])
    known = sorted(weighed.collect())
    weights = np.array([r[1:] for r in known], float).reshape(-1, len(WEIGHTS))
    placed = vector_pack(weights, shards)
    table = [(r["unit"], int(s)) for r, s in zip(known, placed, strict=True)]
    where = spark.createDataFrame(table, "unit long, shard int")
    dealt = united.join(F.broadcast(where), "unit")
    return gapless(dealt, ["shard"], "slot", int(total["one"])).select(
        F.col("doc").alias(id), "size", "tokens", "text_crc32", "shard", "slot"
    )
