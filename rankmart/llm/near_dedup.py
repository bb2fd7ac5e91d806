"""Near-duplicate documents by order MinHash.

A text is the sequence of its shingles (five words in a row, lower-cased), each labelled
with its occurrence, so that the labelled shingles of a text are all different. A sketch
draws the ``ORDER`` shingles with the smallest hashes and keeps them in the order of the
text: two texts have equal sketches with about the ``ORDER``-th power of the share of
shingles that they have in common *in the same order*. ``SKETCHES`` sketches are taken.

Two texts are linked when the best alignment of their shingle sequences, n and m long, has
c equal shingles with c / (n + m - c) of at least ``SIMILARITY``. Only a band of the
alignment can reach that: an aligned pair of places differs by at most max(n, m) - c. As
labelled shingles are different, the best alignment in the band is a longest increasing
subsequence, found exactly.

Every pair of a bucket is compared, unless its two nodes are in one class already:

1. Equal texts are one node, whatever their number.
2. A bucket is a sketch value. Each of its nodes is compared with two of them: the one
   whose buckets hold the most nodes (the base of a group of copies is in the buckets of
   all its copies), and one drawn by a hash, another in each bucket. Links make classes by
   connected components; buckets of near copies are mostly one class then.
3. Nodes of a bucket that are in different classes are compared, all with all. They are
   cut into blocks of about ``BLOCK`` nodes, and a task takes one pair of blocks, so that
   no task holds a bucket. A class larger than a block has blocks of its own, which are
   not compared with each other. The work grows with the square of the *unlike* nodes of
   a bucket: that is the price of a large family of texts that share a template.
4. Classes are made once more with the links of step 3.

Texts of similarity 0.8 have equal sketches with probability 0.41 each, so a pair misses
all 24 sketches in about 3 cases of a million. With few shingles it is less, down to 0.2 for
four and five shingles. Texts of at most ``FEW`` shingles are therefore also in the buckets
of their shingles with the smallest hashes, as many as can be missing from a text that is
similar (and one more): two such texts share one of these buckets for certain.

Results for odd input: null and empty texts are equal to each other and make one class;
texts of fewer than five words are one shingle; a null ``doc_id`` belongs to the class of
its text and is never its representative unless all are null; equal rows are in one class;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmart.llm.arrays import (
    mix,
    owners,
    signed,
    slices,
    utf8,
    window_hashes,
    word_bounds,
    word_hashes,
)
from rankmart.llm.common import ROW, stored, text_or_empty, with_row_number
from rankmart.llm.components import components

SHINGLE = 5
ORDER = 4
SKETCHES = 24
SIMILARITY = 0.8
#: A text that is similar to one of 20 shingles has 25 at most.
FEW = 25
#: Nodes, and shingles, of a block on average.
BLOCK = 128
BLOCK_SHINGLES = 1 << 20
#: Numbers of a matrix of places in one comparison of blocks.
_CELLS = 1 << 22
_DRAW = np.random.default_rng(5).integers(0, 1 << 63, (2, SKETCHES), dtype=np.uint64)
_SEEDS, _FACTORS = _DRAW[0], _DRAW[1] * np.uint64(2) + np.uint64(1)


def _shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Labelled shingles of all texts and where each text's begin.

    A text of one to four words has one shingle, an empty text none.
    """
    data, offsets = utf8(pc.utf8_lower(texts))
    starts, ends, first = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    owner = owners(first)
    windows = window_hashes(words, SHINGLE)
    fits = owner[: len(windows)] == owner[len(owner) - len(windows) :]
    hashes, rows = windows[fits], owner[: len(windows)][fits]
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        whole = np.array(
            [window_hashes(words[first[r] : first[r + 1]], counts[r])[0] for r in short]
        )
        hashes, rows = np.append(hashes, mix(whole)), np.append(rows, short)
        order = np.argsort(rows, kind="stable")
        hashes, rows = hashes[order], rows[order]
    # Occurrences: equal shingles of a text, in the order of the text.
    same = mix(hashes + rows.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    order = np.argsort(same, kind="stable")
    sorted_ = same[order]
    new = np.append(True, sorted_[1:] != sorted_[:-1]) if len(order) else np.zeros(0, bool)
    at = np.arange(len(order))
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    labelled = mix(hashes + occurrence * np.uint64(0xA0761D6478BD642F))
    return labelled, np.searchsorted(rows, np.arange(len(texts) + 1))


def _sketch(labels: np.ndarray) -> np.ndarray:
    """One 64-bit value for each sketch of a text with at least one shingle.

    Texts of few shingles have more values, beyond the ``SKETCHES``-th.
    """
    if len(labels) > ORDER:
        drawn = (labels[:, None] ^ _SEEDS) * _FACTORS
        drawn ^= drawn >> np.uint64(32)
        drawn *= _FACTORS[::-1]
        least = np.argpartition(drawn, ORDER - 1, axis=0)[:ORDER]
        chosen = labels[np.sort(least, axis=0)]
    else:
        chosen = np.repeat(labels[:, None], SKETCHES, axis=1)
    value = _SEEDS.copy()
    for row in chosen:
        value = mix(value * np.uint64(31) + row)
    if len(labels) > FEW:
        return value
    # Of n shingles a similar text lacks n - ceil(0.8 n) at most.
    missing = len(labels) - int(np.ceil(SIMILARITY * len(labels) - 1e-9))
    return np.append(value, np.sort(mix(labels))[: missing + 1])


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            labels, first = _shingles(batch.column("text"))
            sketches = [
                _sketch(labels[a:b]) if b > a else np.zeros(0, np.uint64)
                for a, b in zip(first[:-1], first[1:], strict=True)
            ]
            at = np.append(0, np.cumsum([len(s) for s in sketches])).astype(np.int32)
            values = np.concatenate(sketches) if sketches else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_pydict(
                {
                    "node": batch.column("node"),
                    "doc": batch.column("doc"),
                    "shingles": pa.array(np.diff(first).astype(np.int64)),
                    "sketches": pa.ListArray.from_arrays(pa.array(at), signed(values)),
                }
            )


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Order-aware similarity of two labelled shingle sequences; 0 where below ``least``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    needed = least / (1 + least) * (len(a) + len(b))
    common, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(common) < needed - 1e-9:
        return 0.0
    band = max(len(a), len(b)) - needed + 1e-9
    near = np.abs(at_a - at_b) <= band
    order = np.argsort(at_a[near])
    path = at_b[near][order]
    if len(path) and np.all(path[1:] > path[:-1]):
        aligned = len(path)
    else:
        tails: list[int] = []
        for place in path.tolist():
            k = bisect_left(tails, place)
            tails[k : k + 1] = [place]
        aligned = len(tails)
    found = aligned / (len(a) + len(b) - aligned)
    return found if found >= least - 1e-12 else 0.0


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            labels, first = _shingles(batch.column("text"))
            others, begin = _shingles(batch.column("other_text"))
            found = [
                similarity(labels[first[r] : first[r + 1]], others[begin[r] : begin[r + 1]])
                for r in range(len(batch))
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "node": batch.column("node"),
                    "other": batch.column("other"),
                    "similarity": pa.array(found, pa.float64()),
                }
            )


def _texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    whole = text_or_empty(text)
    # The node is 16 bytes of a digest of the text.
    return docs.select(
        F.unhex(F.md5(whole)).alias("node"),
        F.col(id).try_cast("long").alias("doc"),
        whole.alias("text"),
    )


def _members(nodes: DataFrame) -> DataFrame:
    """Buckets of two nodes and more: ``bucket``, ``node`` and ``shingles``."""
    keys = nodes.select("node", "shingles", F.posexplode("sketches").alias("sketch", "value"))
    # What follows the sketches are shingles, of any place.
    of = F.least("sketch", F.lit(SKETCHES))
    keys = keys.withColumn("bucket", F.xxhash64(of, "value")).drop("sketch", "value")
    sizes = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return stored(keys.join(sizes, "bucket"), "buckets")


def candidates(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of nodes and centers to compare, and the centers (``bucket``, ``other``)."""
    weights = members.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = members.join(weights, "node")
    heaviest = F.struct("weight", "node", "shingles")
    drawn = F.struct(
        F.xxhash64("node", "bucket").alias("draw"), F.col("node"), F.col("shingles")
    )
    centers = weighed.groupBy("bucket").agg(
        F.max(heaviest).alias("heaviest"), F.min(drawn).alias("drawn")
    )
    both = centers.select(
        "bucket",
        F.explode(
            F.array(
                F.struct(F.col("heaviest.node").alias("other"), "heaviest.shingles"),
                F.struct(F.col("drawn.node").alias("other"), "drawn.shingles"),
            )
        ).alias("center"),
    ).select("bucket", "center.other", F.col("center.shingles").alias("other_shingles"))
    both = stored(both.distinct(), "centers")
    close = F.least("shingles", "other_shingles") >= SIMILARITY * F.greatest(
        "shingles", "other_shingles"
    )
    pairs = members.join(both, "bucket").filter((F.col("node") != F.col("other")) & close)
    pairs = pairs.select(
        F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other")
    )
    return pairs.distinct(), both.select("bucket", "other")


def _blocks(members: DataFrame, centers: DataFrame, roots: DataFrame) -> DataFrame:
    """The nodes of buckets with nodes still to compare: ``bucket``, ``node``, ``root``, ``block``.

    Centers have been compared with all. ``only`` is the class of a block that holds one.
    """
    center = centers.withColumnsRenamed({"bucket": "_bucket", "other": "_node"})
    # A bucket of three has at most one pair without a center, if both centers are one node.
    is_center = (F.col("bucket") == F.col("_bucket")) & (F.col("node") == F.col("_node"))
    rooted = (
        members.filter("size > 2")
        .join(center, is_center, "left_anti")
        .join(roots, "node", "left")
        .select("bucket", "node", "shingles", F.coalesce("root", "node").alias("root"))
    )
    sums = [F.count(F.lit(1)).alias("n"), F.sum("shingles").alias("s")]
    by_class = rooted.groupBy("bucket", "root").agg(*sums)

    def count(n, s):
        return F.greatest(F.ceil(n / BLOCK), F.ceil(s / BLOCK_SHINGLES))

    # Blocks that a class needs by itself; the classes of one block are dealt out together.
    own = stored(by_class.withColumn("own", count(F.col("n"), F.col("s"))), "class-sizes")
    small = F.col("own") == 1
    open_ = (
        own.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("classes"),
            count(F.sum(F.when(small, F.col("n"))), F.sum(F.when(small, F.col("s")))).alias(
                "shared"
            ),
        )
        .filter("classes > 1")
    )
    sized = own.join(open_, "bucket").select("bucket", "root", "own", "shared")
    rows = rooted.join(sized, ["bucket", "root"])
    block = F.when(
        F.col("own") > 1,
        -1 - F.abs(F.xxhash64("root", F.pmod(F.xxhash64("node", F.lit(7)), "own")) % (1 << 60)),
    ).otherwise(F.pmod(F.xxhash64("root", F.lit(7)), "shared"))
    only = F.when(F.col("own") > 1, F.col("root")).alias("only")
    return rows.select("bucket", "node", "root", block.alias("block"), only)


def _block_links(table: pa.Table) -> pa.Table:
    """Links between the nodes of two blocks (or of one), all pairs of unlike classes."""
    left, right = table.filter(pc.field("side") == 0), table.filter(pc.field("side") == 1)
    same = not len(right)

    def parts(side: pa.Table):
        lists = side["labels"].combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks)
        labels = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        first = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy())).astype(np.int64)
        return labels, first, side["node"].to_pylist(), side["root"].to_pylist()

    a, first_a, node_a, root_a = parts(left)
    b, first_b, node_b, root_b = (a, first_a, node_a, root_a) if same else parts(right)
    size_a, size_b = np.diff(first_a), np.diff(first_b)
    # Only shingles of both sides count; their places are numbered.
    shared = np.unique(a) if same else np.intersect1d(a, b)
    common = np.zeros((len(size_a), len(size_b)), np.float32)
    row_a, row_b = owners(first_a), owners(first_b)
    at_a, at_b = np.searchsorted(shared, a), np.searchsorted(shared, b)
    if len(shared):
        in_a = shared[np.minimum(at_a, len(shared) - 1)] == a
        in_b = shared[np.minimum(at_b, len(shared) - 1)] == b
        row_a, at_a, row_b, at_b = row_a[in_a], at_a[in_a], row_b[in_b], at_b[in_b]
        step = max(1, _CELLS // max(len(size_a), len(size_b)))
        order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
        row_a, at_a, row_b, at_b = row_a[order_a], at_a[order_a], row_b[order_b], at_b[order_b]
        for low in range(0, len(shared), step):
            width = min(step, len(shared) - low)
            matrices = []
            for rows, at, count in ((row_a, at_a, len(size_a)), (row_b, at_b, len(size_b))):
                begin, end = np.searchsorted(at, [low, low + width])
                held = np.zeros((count, width), np.float32)
                held[rows[begin:end], at[begin:end] - low] = 1
                matrices.append(held)
            common += matrices[0] @ matrices[1].T
    needed = SIMILARITY / (1 + SIMILARITY) * (size_a[:, None] + size_b[None, :])
    out = []
    for i, j in np.argwhere(common >= needed - 1e-6).tolist():
        if root_a[i] == root_b[j] or (same and i >= j):
            continue
        x, y = a[first_a[i] : first_a[i + 1]], b[first_b[j] : first_b[j + 1]]
        if similarity(x, y) > 0:
            out.append((max(node_a[i], node_b[j]), min(node_a[i], node_b[j])))
    columns = [pa.array([pair[k] for pair in out], pa.binary()) for k in (0, 1)]
    return pa.Table.from_arrays(columns, names=["node", "other"])


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            labels, first = _shingles(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), signed(labels))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), lists], names=["node", "labels"]
            )


def _one_text_each(texts: DataFrame, nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """The texts of the nodes asked for."""
    wanted = nodes.join(asked, "node").select(
        F.col("node").alias("_node"), F.col("doc").alias("_doc")
    )
    same = (F.col("node") == F.col("_node")) & F.col("doc").eqNullSafe(F.col("_doc"))
    # Of equal rows one is enough.
    return texts.join(wanted, same).groupBy("node").agg(F.first("text").alias("text"))


def _rest(
    texts: DataFrame, nodes: DataFrame, members: DataFrame, centers: DataFrame, roots: DataFrame
) -> DataFrame:
    """Links between nodes of one bucket that are neither centers nor in one class."""
    rows = stored(_blocks(members, centers, roots), "rest")
    asked = rows.select("node").distinct()
    labels = _one_text_each(texts, nodes, asked).mapInArrow(
        _labelled, "node binary, labels array<long>"
    )
    labels = stored(labels, "labels")
    # Blocks of one class are met by all blocks but those of that class.
    blocks = rows.select("bucket", "block", "only").distinct()
    second = blocks.withColumnsRenamed({"block": "b", "only": "other_only"})
    unlike = F.coalesce(F.col("only") != F.col("other_only"), F.lit(True))
    met = blocks.withColumnRenamed("block", "a").join(second, "bucket")
    met = met.filter((F.col("a") <= F.col("b")) & unlike).select("bucket", "a", "b")
    first = met.withColumns({"side": F.lit(0), "block": F.col("a")})
    other = met.filter("a < b").withColumns({"side": F.lit(1), "block": F.col("b")})
    held = first.union(other).join(rows.drop("only"), ["bucket", "block"])
    full = held.join(labels, "node").select("bucket", "a", "b", "side", "node", "root", "labels")
    found = full.groupBy("bucket", "a", "b").applyInArrow(
        _block_links, "node binary, other binary"
    )
    return stored(found.distinct(), "rest-links")


def links(
    docs: DataFrame, id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Nodes (``node``, ``doc``: the smallest id of its text) and their ``root``, if another."""
    texts = _texts(docs, id, text)
    schema = "node binary, doc long, shingles long, sketches array<long>"
    nodes = texts.mapInArrow(_sketched, schema).groupBy("node").agg(
        F.min("doc").alias("doc"),
        F.first("shingles").alias("shingles"),
        F.first("sketches").alias("sketches"),
    )
    nodes = stored(nodes, "sketches")
    members = _members(nodes)
    pairs, centers = candidates(members)
    pairs = stored(pairs, "pairs")
    asked = pairs.select("node").union(pairs.select("other")).distinct()
    told = stored(_one_text_each(texts, nodes, asked), "texts")
    others = told.select(F.col("node").alias("other"), F.col("text").alias("other_text"))
    compared = pairs.join(told, "node").join(others, "other").mapInArrow(
        _compared, "node binary, other binary, similarity double"
    )
    linked = stored(compared.filter("similarity > 0").select("node", "other"), "links")
    roots = components(linked, "node", "other")
    more = _rest(texts, nodes, members, centers, roots)
    if not more.isEmpty():
        roots = components(linked.union(more), "node", "other")
    return nodes.select("node", "doc"), roots


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``node`` (a text), ``class_id``, the smallest id of its class of near copies, ``first``.

    ``first`` marks one node of each class: the smallest with that id.
    """
    nodes, roots = links(docs, id, text)
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Null ids come last.
    order = F.struct(F.col("doc").isNull(), F.col("doc"), F.col("node"))
    least = rooted.groupBy("root").agg(
        F.min("doc").alias("class_id"), F.min_by("node", order).alias("chosen")
    )
    first = (F.col("node") == F.col("chosen")).alias("first")
    return rooted.join(least, "root").select("node", "class_id", first)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its ``class_id`` and whether it is the one that is ``kept``.

    Of rows with one id and text one is kept, as by :func:`one_of_each`.
    """
    known = stored(classes(docs, id, text), "classes")
    rows = stored(with_row_number(_texts(docs, id, text).drop("text")), "rows")
    rows = rows.join(known, "node")
    least = rows.filter(F.col("first") & F.col("doc").eqNullSafe(F.col("class_id")))
    chosen = least.groupBy("node").agg(F.min(ROW).alias(ROW)).select(ROW, F.lit(True).alias("_kept"))
    kept = F.coalesce("_kept", F.lit(False)).alias("kept")
    return rows.join(chosen, ROW, "left").select(F.col("doc").alias(id), "class_id", kept)


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class, all columns as they were."""
    known = stored(classes(docs, id, text), "classes")
    node = F.unhex(F.md5(text_or_empty(text)))
    # "_node" and "_class" are no columns of documents; any there are give way.
    plain = docs.drop("_node", "_class").withColumn("_node", node)
    known = known.filter("first").select(
        F.col("node").alias("_node"), F.col("class_id").alias("_class")
    )
    kept = plain.join(known, "_node").filter(F.col(id).try_cast("long").eqNullSafe(F.col("_class")))
    return kept.dropDuplicates(["_node"]).drop("_node", "_class")
