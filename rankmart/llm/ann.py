"""Nearest neighbours by multi-index hashing.

Vectors are centred, projected on their principal directions and rotated so that signs lose
least (iterative quantisation); the signs make a binary code. The rotation is learned on a
bounded sample of ``SAMPLE`` rows. Codes are cut into substrings of 8 bits and every
substring is indexed. Two codes that differ in at most r of all bits differ, in at least one
of m substrings, in at most floor(r / m) bits (in the first r mod m + 1 substrings) or one
less (in the others), so probing the substrings within that distance finds *every* code
within r. Those are checked on the whole code and ranked by the inner product of the
original vectors.

The radius is part of the fit: the exact neighbours of up to ``CALIBRATION`` sampled queries
are found among all rows, and r is the code distance that holds ``RECALL`` of them. It
follows the data at every size. Queries with fewer than k hits within r are searched once
more with no bound on the distance.

The index is held in blocks of ``BLOCK`` vectors with their substring tables, and queries in
blocks of ``QUERIES``; a task meets one pair of blocks at a time and returns each query's
best k of it, so neither memory nor rows depend on how alike the vectors are.

Results for odd input: vectors that are null, empty, all zero, or hold a null or non-finite
component take no part, nor do rows without an id; vectors of each length are searched by
themselves; rows are told apart, not ids: a query meets all rows but its own, also others of its
id, and each of two query rows of one id has its own k hits; ties go to the smaller id; with k
or fewer candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankmart.llm.common import stored

SAMPLE = 10_000
CALIBRATION = 200
RECALL = 0.96
BITS = 64
BLOCK = 8192
QUERIES = 1024
_SUB = 8
_CHOICE = 1 << 20
_RESULT = "query long, query_id long, row long, id long, score double, distance int"
_RESULT_NAMES = [column.split()[0] for column in _RESULT.split(", ")]
#: Differing bits of two bytes.
_APART = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8))


@dataclass(frozen=True)
class Rotation:
    mean: np.ndarray
    matrix: np.ndarray

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One row of bytes, i.e. of substrings, for each vector."""
        signs = (vectors - self.mean) @ self.matrix > 0
        return np.packbits(signs, axis=1, bitorder="little")


def fit_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = 30) -> Rotation:
    """Principal directions of a sample, rotated towards the corners of the cube."""
    mean = sample.mean(axis=0)
    around = sample - mean
    _, directions = np.linalg.eigh(around.T @ around)
    chosen = directions[:, ::-1][:, : min(bits, sample.shape[1])]
    flat = around @ chosen
    draw = np.random.default_rng(11).normal(size=(flat.shape[1],) * 2)
    turn = np.linalg.qr(draw)[0]
    for _ in range(rounds):
        corners = np.where(flat @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(flat.T @ corners)
        turn = left @ right
    return Rotation(mean, chosen @ turn)


def substring_radii(radius: int, substrings: int) -> list[int]:
    """How far to probe each substring so that no code within ``radius`` is missed."""
    whole, rest = divmod(radius, substrings)
    return [whole if t <= rest else whole - 1 for t in range(substrings)]


def _near(codes: np.ndarray, asked: np.ndarray, radius: int) -> np.ndarray:
    """Which rows (columns) a query (row) meets in at least one substring table."""
    met = np.zeros((len(asked), len(codes)), bool)
    for table, reach in enumerate(substring_radii(radius, codes.shape[1])):
        if reach < 0:
            continue
        order = np.argsort(codes[:, table], kind="stable")
        values, heads = np.unique(codes[order, table], return_index=True)
        ends = np.append(heads[1:], len(order))
        for value, head, end in zip(values, heads, ends, strict=True):
            probing = np.flatnonzero(_APART[asked[:, table], value] <= reach)
            if len(probing):
                met[np.ix_(probing, order[head:end])] = True
    return met


def search_block(
    ids: np.ndarray,
    rows: np.ndarray,
    vectors: np.ndarray,
    codes: np.ndarray,
    asked_ids: np.ndarray,
    asked_rows: np.ndarray,
    asked: np.ndarray,
    asked_codes: np.ndarray,
    radius: int,
    k: int,
) -> tuple[list[np.ndarray], ...]:
    """For each query its best ``k`` rows of a block within the radius."""
    out: tuple[list, ...] = ([], [], [], [], [], [])
    for low in range(0, len(asked), 128):
        part = slice(low, low + 128)
        met = _near(codes, asked_codes[part], radius)
        for row, query in enumerate(range(low, min(low + 128, len(asked)))):
            found = np.flatnonzero(met[row] & (rows != asked_rows[query]))
            apart = np.bitwise_count(codes[found] ^ asked_codes[query]).sum(axis=1)
            found, apart = found[apart <= radius], apart[apart <= radius]
            if not len(found):
                continue
            scores = (vectors[found] * asked[query]).sum(axis=1)
            best = np.lexsort((rows[found], ids[found], -scores))[:k]
            out[0].append(np.full(len(best), asked_rows[query]))
            out[1].append(np.full(len(best), asked_ids[query]))
            out[2].append(rows[found[best]])
            out[3].append(ids[found[best]])
            out[4].append(scores[best])
            out[5].append(apart[best])
    return out


def _vectors(column: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, size)


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: no nulls, only finite numbers, not all zero."""
    whole = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return vector.isNotNull() & F.coalesce(whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def _sampled(rows: DataFrame, total: int, size: int) -> DataFrame:
    """About ``size`` rows, chosen by a hash of their number; all where there are fewer."""
    below = int(min(1.0, size / max(1, total)) * _CHOICE)
    return rows.filter(F.pmod(F.xxhash64("row", F.lit(3)), F.lit(_CHOICE)) < below)


def _search(
    index: DataFrame,
    queries: DataFrame,
    rotation: Rotation,
    total: int,
    asked: int,
    radius: int,
    k: int,
) -> DataFrame:
    """The best ``k`` rows of each query within ``radius``, from all pairs of blocks."""
    shared = index.sparkSession.sparkContext.broadcast(rotation)
    size = rotation.matrix.shape[0]
    blocks, query_blocks = -(-total // BLOCK), -(-max(1, asked) // QUERIES)

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    block = F.pmod(F.xxhash64("row", F.lit(5)), F.lit(blocks)).cast("int")
    query_block = F.pmod(F.xxhash64("row", F.lit(7)), F.lit(query_blocks)).cast("int")
    left = index.select("*", block.alias("block"), numbers(query_blocks).alias("query_block"))
    right = queries.select("*", query_block.alias("query_block"), numbers(blocks).alias("block"))

    def pair(rows: pa.Table, asks: pa.Table) -> pa.Table:
        out: tuple[list, ...] = ([], [], [], [], [], [])
        if rows.num_rows and asks.num_rows:
            turn = shared.value
            vectors = _vectors(rows["vector"], size)
            wanted = _vectors(asks["vector"], size)
            out = search_block(
                rows["id"].to_numpy(),
                rows["row"].to_numpy(),
                vectors,
                turn.codes(vectors),
                asks["id"].to_numpy(),
                asks["row"].to_numpy(),
                wanted,
                turn.codes(wanted),
                radius,
                k,
            )
        kinds = (np.int64, np.int64, np.int64, np.int64, np.float64, np.int32)
        columns = [
            pa.array((np.concatenate(x) if x else np.zeros(0)).astype(kind))
            for x, kind in zip(out, kinds, strict=True)
        ]
        return pa.table(columns, names=_RESULT_NAMES)

    keys = ("block", "query_block")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, _RESULT)
    best = W.partitionBy("query").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's nearest rows."""
    rows = vectors.select(
        F.col(id).try_cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    # Stored, so that the numbers of rows last.
    index = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = F.size("vector")
    lengths = index.groupBy(size.alias("size")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asked")
    )
    # One search for each length that is asked for.
    found = [
        _of_length(index.filter(size == r["size"]), r["size"], r["n"], r["asked"], k, recall)
        for r in lengths.filter("asked > 0").orderBy("size").collect()
    ]
    if not found:
        schema = "query_id long, rank int, vec_id long, score double"
        return vectors.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


def _of_length(
    index: DataFrame, size: int, total: int, asked: int, k: int, recall: float
) -> DataFrame:
    """The search among vectors of one length."""
    queries = stored(index.filter("asks").drop("asks"), "queries")
    index = index.drop("asks")

    # At most about SAMPLE vectors reach the driver.
    sample = _sampled(index, total, SAMPLE).limit(2 * SAMPLE).toArrow()
    if not sample.num_rows:
        sample = index.limit(1).toArrow()
    rotation = fit_rotation(_vectors(sample["vector"], size))
    bits = rotation.matrix.shape[1]
    tried = _sampled(queries, asked, CALIBRATION)
    exact = _search(index, tried, rotation, total, CALIBRATION, bits, k)
    apart = exact.agg(F.percentile("distance", recall).alias("r")).first()["r"]
    radius = bits if apart is None else int(np.ceil(apart))

    near = stored(_search(index, queries, rotation, total, asked, radius, k), "near")
    wanted = min(k, total - 1)
    full = near.groupBy("query").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= wanted)
    short = stored(queries.join(full, F.col("row") == F.col("query"), "left_anti"), "short")
    left = short.count()
    if left:
        rest = _search(index, short, rotation, total, left, bits, k)
        again = short.select(F.col("row").alias("query"))
        near = near.join(again, "query", "left_anti").unionByName(rest)
    return near.select(
        "query_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("vec_id"),
        "score",
    )
