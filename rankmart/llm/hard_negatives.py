"""Hard negatives by Fagin's threshold algorithm.

Components become integers, floor(256 x), and a row's score is its integer inner product with
an anchor. Positives are an anchor's best rows of its own label; a negative is a row of
another label whose score lies in the *window* of a positive, here 50 % to 95 % of its score.

Rows are held in blocks with one list per dimension, sorted by the component. For an anchor
each list is read from the end that adds most: from the largest component where the anchor's
is positive, from the smallest where it is negative. Rows met in any list are scored in full
(random access). The *threshold*, the sum of what the lists would add at the depth reached,
bounds the score of all rows not met. Reading stops once it falls strictly below the k-th
score found in each window, or below the window itself, so that equal scores are all met and
go by their id. Results are exact; only the work depends on how soon the threshold falls.

1. Rows of one length and label are cut into blocks of at most about ``BLOCK`` rows and stored
   with their lists. Anchors, in chunks of about ``CHUNK``, meet the blocks of their label;
   the best positives of all blocks are merged.
2. Rows of one length are cut into blocks whatever their label, and anchors with their windows
   meet each. The best negatives of all blocks are merged.

A task holds one block and one chunk, whatever label or vector is frequent. The lists are made
once and stored. Work grows with anchors times rows where the vectors have no structure.

Results for odd input: rows with a null id, label or vector, or with a null or non-finite
component, take no part, nor do vectors whose integers have a sum of squares of 2^55 or more
(a score would not fit). Vectors are compared with vectors of their length; an empty one
scores 0 with another. A row is told from others of its id: an anchor leaves out itself only,
and each of two anchor rows of one id has its own result. Of equal scores and ids any row
comes first; they give equal results. An anchor without positives, and a positive without
negatives, have no rows; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankmart.llm.common import stored, with_row_number

BLOCK = 4096
CHUNK = 4096
SCALE = 256
#: Score of a negative, in hundredths of its positive's.
LOWEST, HIGHEST = 50, 95
_STEP = 16
_LIMIT = float(1 << 55)
_EXACT = float(1 << 53)
_BLOCKS = "size int, label long, block int, rows binary, ids binary, labels binary, vectors binary, lists binary"


def _floors(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x * float(SCALE)))


def usable_rows(
    rows: DataFrame, is_anchor: Column, id: str, label: str, vector: str
) -> DataFrame:
    """``id``, ``label``, integer ``vector``, its ``size``, and whether the row ``asks``."""
    found = rows.select(
        F.col(id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    ).filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    squares = F.aggregate(
        "vector", F.lit(0.0), lambda total, x: total + F.pow(F.floor(x * float(SCALE)), 2)
    )
    # Beyond any score: floor() of such a number would be no long.
    small = F.forall("vector", lambda x: F.abs(x) < float(1 << 40))
    found = found.filter(F.coalesce(finite, F.lit(False))).filter(small)
    found = found.filter(squares < _LIMIT)
    return found.withColumns({"vector": _floors(F.col("vector")), "size": F.size("vector")})


def _numbers(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """A column of vectors as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not size:
        return np.zeros((len(column), 0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _block(rows: pa.Table) -> pa.Table:
    """The rows of a block, by id, and their places in the order of each component."""
    rows = rows.sort_by([("id", "ascending"), ("row", "ascending")])
    size = rows["size"][0].as_py()
    vectors = _numbers(rows["vector"], size)
    lists = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
    data = {
        "rows": rows["row"].to_numpy(),
        "ids": rows["id"].to_numpy(),
        "labels": rows["label"].to_numpy(),
        "vectors": vectors,
        "lists": np.ascontiguousarray(lists.T),
    }
    found = {
        "size": pa.array([size], pa.int32()),
        "label": rows["part"].slice(0, 1),
        "block": rows["block"].slice(0, 1),
    }
    for name, values in data.items():
        found[name] = pa.array([values.astype(values.dtype.newbyteorder("<")).tobytes()])
    return pa.table(found)


class Lists:
    """A block: its rows and, for each dimension, their order."""

    def __init__(self, block: dict):
        self.rows = np.frombuffer(block["rows"], "<i8")
        self.ids = np.frombuffer(block["ids"], "<i8")
        self.labels = np.frombuffer(block["labels"], "<i8")
        self.vectors = np.frombuffer(block["vectors"], "<i8").reshape(len(self.rows), -1)
        self.lists = np.frombuffer(block["lists"], "<i4").reshape(-1, len(self.rows))
        # A sum of products below this is exact in double precision, where it is faster.
        squares = np.square(self.vectors.astype(np.float64)).sum(axis=1)
        self.largest = float(squares.max()) if len(squares) else 0.0
        self.fast = self.vectors.astype(np.float64)

    def access(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | float]]:
        """Rows newly met, their scores, and a bound for all rows not met so far."""
        used = np.flatnonzero(anchor)
        weights = anchor[used]
        count = len(self.rows)
        exact = float(np.square(weights.astype(np.float64)).sum()) * self.largest < _EXACT**2
        vectors, anchor = (self.fast, anchor.astype(float)) if exact else (self.vectors, anchor)
        seen = np.zeros(count, bool)
        depth, step = 0, _STEP
        falling = weights > 0
        while depth < count and len(used):
            end = min(count, depth + step)
            # From the last place on where the anchor's component is positive.
            best = self.lists[used[falling], count - end : count - depth]
            least = self.lists[used[~falling], depth:end]
            new = np.zeros(count, bool)
            new[best.ravel()] = True
            new[least.ravel()] = True
            new &= ~seen
            seen |= new
            met = np.flatnonzero(new)
            edge = np.empty(len(used), np.int64)
            edge[falling] = self.vectors[self.lists[used[falling], count - end], used[falling]]
            edge[~falling] = self.vectors[self.lists[used[~falling], end - 1], used[~falling]]
            scores = (vectors[met] @ anchor).astype(np.int64)
            # Python's numbers, as a bound may be beyond 64 bits.
            bound = sum(map(operator.mul, weights.tolist(), edge.tolist()))
            yield met, scores, bound if end < count else -np.inf
            depth, step = end, 2 * step
        if not len(used):
            # An anchor of zeros: all scores are 0.
            yield np.arange(count), np.zeros(count, np.int64), -np.inf


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id."""
    if len(scores) > 4 * k + 64:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        chosen = np.flatnonzero(scores >= floor)
        return chosen[np.lexsort((ids[chosen], -scores[chosen]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def best_of_label(lists: Lists, anchor: np.ndarray, row: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the anchor's best ``k`` rows but itself."""
    places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for met, found, bound in lists.access(anchor):
        other = lists.rows[met] != row
        places = np.concatenate((places, met[other]))
        scores = np.concatenate((scores, found[other]))
        top = _best(lists.ids[places], scores, k)
        places, scores = places[top], scores[top]
        if len(top) == k and bound < int(scores[-1]):
            break
    return places, scores


def best_in_windows(
    lists: Lists, anchor: np.ndarray, label: int, positives: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each positive score the best ``k`` rows of another label in its window."""
    none = np.zeros(0, np.int64)
    found = [(none, none) for _ in positives]
    for met, scores, bound in lists.access(anchor):
        other = lists.labels[met] != label
        met, scores = met[other], scores[other]
        over = True
        for at, positive in enumerate(positives):
            fits = (LOWEST * positive <= 100 * scores) & (100 * scores <= HIGHEST * positive)
            places = np.concatenate((found[at][0], met[fits]))
            values = np.concatenate((found[at][1], scores[fits]))
            top = _best(lists.ids[places], values, k)
            found[at] = places[top], values[top]
            full = len(top) == k and bound < int(values[top[-1]])
            # The window of a negative score is empty.
            over &= full or positive < 0 or 100 * bound < LOWEST * int(positive)
        if over:
            break
    return found


def _counted(rows: DataFrame, keys: list[str], share: int, name: str) -> DataFrame:
    parts = F.ceil(F.count(F.lit(1)) / F.lit(share)).cast("int")
    return rows.groupBy(*keys).agg(parts.alias(name))


def _numbered(name: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(name) - 1))


def _pairs(
    rows: DataFrame, anchors: DataFrame, keys: list[str], block: int, chunk: int
) -> tuple[DataFrame, DataFrame]:
    """Blocks (a row each, with their lists) and anchors, repeated for each of their pairs.

    Blocks and chunks are formed within ``keys``. The numbers of blocks and chunks are
    joined as tables of one row per value of ``keys``.
    """
    part = F.col("label") if "label" in keys else F.lit(0).cast("long")
    rows, anchors = rows.withColumn("part", part), anchors.withColumn("part", part)
    by = ["size", "part"]
    counts = _counted(anchors, by, chunk, "chunks").join(_counted(rows, by, block, "blocks"), by)
    counts = stored(counts, "counts")
    # A row's number is unique but not dense; its hash deals rows out evenly.
    dealt = F.pmod(F.xxhash64("row", F.lit(5)), F.col("blocks")).cast("int")
    held = rows.join(counts.drop("chunks"), by).withColumn("block", dealt).drop("blocks")
    index = held.groupBy(*by, "block").applyInArrow(_block, _BLOCKS)
    index = stored(index.withColumnRenamed("label", "part"), "lists")
    index = index.join(counts.drop("blocks"), by).withColumn("chunk", _numbered("chunks"))
    dealt = F.pmod(F.xxhash64("row", F.lit(7)), F.col("chunks")).cast("int")
    asks = anchors.join(counts, by).withColumn("chunk", dealt).drop("chunks")
    asks = asks.withColumn("block", _numbered("blocks")).drop("blocks")
    return index.drop("chunks"), asks


_KEYS = ("size", "part", "block", "chunk")


def _positives(index: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    def pair(block: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if block.num_rows and anchors.num_rows:
            (held,) = block.to_pylist()
            lists = Lists(held)
            vectors = _numbers(anchors["vector"], held["size"])
            for at, (row, id) in enumerate(
                zip(anchors["row"].to_numpy(), anchors["id"].to_numpy(), strict=True)
            ):
                places, scores = best_of_label(lists, vectors[at], row, k)
                out += [
                    (row, id, lists.rows[p], lists.ids[p], s)
                    for p, s in zip(places, scores, strict=True)
                ]
        return _longs(out, ["row", "id", "positive_row", "positive_id", "positive_score"])

    schema = "row long, id long, positive_row long, positive_id long, positive_score long"
    found = index.groupBy(*_KEYS).cogroup(asks.groupBy(*_KEYS)).applyInArrow(pair, schema)
    order = W.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    return found.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k)


def _negatives(index: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    def pair(block: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if block.num_rows and anchors.num_rows:
            (held,) = block.to_pylist()
            lists = Lists(held)
            vectors = _numbers(anchors["vector"], held["size"])
            rows = zip(
                anchors["row"].to_numpy(),
                anchors["label"].to_numpy(),
                anchors["scores"].to_pylist(),
                strict=True,
            )
            for at, (row, label, scores) in enumerate(rows):
                windows = np.array(scores, np.int64)
                for window, (places, values) in zip(
                    scores, best_in_windows(lists, vectors[at], label, windows, k), strict=True
                ):
                    out += [
                        (row, window, lists.rows[p], lists.ids[p], s)
                        for p, s in zip(places, values, strict=True)
                    ]
        return _longs(out, ["row", "positive_score", "negative_row", "negative_id", "negative_score"])

    schema = "row long, positive_score long, negative_row long, negative_id long, negative_score long"
    found = index.groupBy(*_KEYS).cogroup(asks.groupBy(*_KEYS)).applyInArrow(pair, schema)
    order = W.partitionBy("row", "positive_score").orderBy(
        F.desc("negative_score"), "negative_id", "negative_row"
    )
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _longs(rows: list[tuple], names: list[str]) -> pa.Table:
    numbers = np.array(rows, np.int64).reshape(-1, len(names))
    return pa.table([pa.array(numbers[:, k]) for k in range(len(names))], names=names)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """For each anchor and each of its positives the best negatives in the window."""
    chosen = usable_rows(vectors, is_anchor, id, label, vector)
    # Stored, so that the numbers of rows last.
    rows = stored(with_row_number(chosen).withColumnRenamed("_row", "row"), "rows")
    anchors = rows.filter("asks")
    index, asks = _pairs(rows, anchors, ["size", "label"], block, chunk)
    best = stored(_positives(index, asks, positives), "positives")

    # Positives of one score have one window.
    windows = best.groupBy("row").agg(F.collect_set("positive_score").alias("scores"))
    index, asks = _pairs(rows, anchors.join(windows, "row"), ["size"], block, chunk)
    found = _negatives(index, asks, negatives)
    return (
        best.join(found, ["row", "positive_score"])
        .select(
            F.col("id").alias("anchor_id"),
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            "negative_id",
            "positive_score",
            "negative_score",
        )
    )
