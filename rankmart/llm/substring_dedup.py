"""Substring deduplication with difference-cover anchors.

A window is ``WINDOW`` consecutive words. Words of a window that also starts in a document
with a smaller ``doc_id`` are repeats. To find the windows that occur in more than one
document without shuffling every one, only windows of ``ANCHOR`` words that start at a
*cover* place are hashed: places whose remainder modulo ``PERIOD`` is in ``COVER``. The
differences of ``COVER`` give every remainder, so for two equal windows at any places i
and j there is a shift below ``PERIOD`` that puts i and j on cover places at once; as
``PERIOD - 1 + ANCHOR <= WINDOW``, the anchors there lie inside both windows and are equal.

1. Each text is cut and hashed once; its anchors are stored by ``SLICES`` slices of the
   hashes. Slice by slice, anchors are counted by document; those of one document only
   are dropped, and the places of the others are gathered by document.
2. Every window of full length around those places is hashed (128 bits), once, and stored
   by slices of the hashes.
3. Slice by slice, the smallest ``doc_id`` of each window is joined back; windows of later
   documents are repeats.

Equal hashes are in one slice, so slices change no result; they bound the disk that shuffles
take. Stored tables are emptied once their step is done.

A frequent passage is one key. It is summed before the shuffle. The joins that bring the sums
back send the keys that hold more than one of ``HOT`` rows of the slice to all tasks (fewer
than ``HOT`` by construction) and shuffle the rows of the others.

Words are told apart by two 64-bit hashes; the result is exact but for a chance of about
1e-13 on 10^13 words.

Results for odd input: a null or empty text has no words; a null ``doc_id`` is smaller than
no other and no other is smaller, so its text stays and takes part in nothing, as does that of an id that is no
whole number; rows of one
``doc_id`` (equal or not) never repeat one another; an empty table gives an empty result;
all other columns are kept as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

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
from rankmart.llm.common import scratch, stored, text_key

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
SLICES = 4
#: A key is hot if it has more than this part of the rows.
HOT = 1000
_ON_COVER = np.isin(np.arange(PERIOD), COVER)
_RESULTS = ("span_words", "span_removed", "span_kept", "span_sha256")
_DOC, _KEY, _STARTS = "_span_doc", "_span_key", "_span_starts"


def _hashed(batch: pa.RecordBatch, seed: int = 0):
    """Word hashes, each text's first word, and the place of each word in its text."""
    data, offsets = utf8(batch.column("text"))
    starts, ends, first = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends, seed)
    owner = owners(first)
    return hashes, first, owner, np.arange(len(starts)) - first[owner]


def _slice(hashes: np.ndarray, parts: int) -> pa.Array:
    return pa.array(((hashes >> np.uint64(32)) % np.uint64(parts)).astype(np.int32))


def _anchors(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            hashes, first, owner, place = _hashed(batch)
            anchors = window_hashes(hashes, ANCHOR)
            count = len(anchors)
            if not count:
                continue
            fits = owner[:count] == owner[ANCHOR - 1 :]
            fits &= _ON_COVER[place[:count] % PERIOD]
            chosen = np.flatnonzero(fits)
            rows = owner[chosen]
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor": signed(anchors[chosen]),
                    "doc": batch.column("doc").take(rows),
                    "key": batch.column("key").take(rows),
                    "place": pa.array(place[chosen].astype(np.int32)),
                    "part": _slice(anchors[chosen], parts),
                }
            )


def _windows(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Windows of full length that hold one of the anchors at ``places``."""
    for whole in batches:
        for batch in slices(whole, "text"):
            hashes, first, owner, place = _hashed(batch)
            again, *_ = _hashed(batch, seed=1)
            count = max(0, len(hashes) - WINDOW + 1)
            found = batch.column("places")
            at = found.flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(found.offsets.to_numpy())
            at = at + np.repeat(first[:-1], sizes)
            marked = np.zeros(len(hashes) + 1, np.int64)
            # A window holds the anchor at p if it starts at p - (WINDOW - ANCHOR) to p.
            np.add.at(marked, np.maximum(at - (WINDOW - ANCHOR), np.repeat(first[:-1], sizes)), 1)
            np.add.at(marked, at + 1, -1)
            near = np.cumsum(marked)[:count] > 0
            near &= owner[:count] == owner[WINDOW - 1 :]
            ones = window_hashes(hashes, WINDOW)
            chosen = np.flatnonzero(near)
            rows = owner[chosen]
            yield pa.RecordBatch.from_pydict(
                {
                    "one": signed(ones[chosen]),
                    "two": signed(mix(window_hashes(again, WINDOW)[chosen])),
                    "doc": batch.column("doc").take(rows),
                    "key": batch.column("key").take(rows),
                    "place": pa.array(place[chosen].astype(np.int32)),
                    "part": _slice(ones[chosen], parts),
                }
            )


def repeated_windows(
    docs: DataFrame, id: str = "doc_id", text: str = "text", slices_of_hashes: int = SLICES
) -> DataFrame:
    """``doc``, ``key`` and the first words (``starts``) of its repeated windows.

    Documents without any have no row. ``key`` tells rows of one ``doc_id`` apart.
    """
    spark, parts = docs.sparkSession, slices_of_hashes
    texts = docs.select(
        F.col(id).try_cast("long").alias("doc"),
        text_key(text).alias("key"),
        F.col(text).cast("string").alias("text"),
    ).filter("doc IS NOT NULL AND text IS NOT NULL")
    with scratch(spark):
        with scratch(spark):
            schema = "anchor long, doc long, key long, place int, part int"
            anchors = texts.mapInArrow(lambda b: _anchors(b, parts), schema)
            anchors = stored(anchors, "anchors", ["part"])
            placed = [_shared(anchors, ["anchor"], part) for part in range(parts)]
            held = _gathered(_union(placed), "place", "places")
            held = stored(held, "places", outlives=True)
        located = texts.join(held, ["doc", "key"])
        schema = "one long, two long, doc long, key long, place int, part int"
        windows = located.mapInArrow(lambda b: _windows(b, parts), schema)
        windows = stored(windows, "windows", ["part"])
        repeats = [
            _shared(windows, ["one", "two"], part, later=True) for part in range(parts)
        ]
        return stored(_gathered(_union(repeats), "place", "starts"), "spans", outlives=True)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _gathered(rows: DataFrame, lists: str, name: str) -> DataFrame:
    """The numbers of all lists of a document, each once."""
    every = F.array_distinct(F.flatten(F.collect_list(lists))).alias(name)
    return rows.groupBy("doc", "key").agg(every)


def _shared(rows: DataFrame, by: list[str], part: int, later: bool = False) -> DataFrame:
    """Places of the hashes of one slice that occur in several documents, by document.

    With ``later``, only of documents after the first that has the hash.
    """
    rows = rows.filter(F.col("part") == part).drop("part")
    counted = rows.groupBy(*by).agg(
        F.min("doc").alias("least"), F.max("doc").alias("most"), F.count(F.lit(1)).alias("n")
    )
    counted = stored(counted.filter("least < most").drop("most"), "shared")
    total = rows.count()
    hot = F.broadcast(counted.filter(F.col("n") * HOT > total))
    rest = counted.filter(F.col("n") * HOT <= total)
    found = rows.join(hot, by).unionByName(rows.join(hot, by, "left_anti").join(rest, by))
    if later:
        found = found.filter("least < doc")
    places = F.collect_set("place").alias("place")
    return stored(found.groupBy("doc", "key").agg(places), "places")


def _cut(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, text):
            data, offsets = utf8(batch.column(text))
            starts, ends, first = word_bounds(data, offsets)
            texts = data.tobytes()
            n_words, n_removed, kept, digests = [], [], [], []
            for row, places in enumerate(batch.column(_STARTS).to_pylist()):
                low, high = int(first[row]), int(first[row + 1])
                words = texts[offsets[row] : offsets[row + 1]].split()
                left = words
                if places:
                    edges = np.zeros(high - low + 1, np.int64)
                    np.add.at(edges, np.asarray(places), 1)
                    np.add.at(edges, np.asarray(places) + WINDOW, -1)
                    stays = np.cumsum(edges)[:-1] == 0
                    left = [words[i] for i in np.flatnonzero(stays)]
                joined = b" ".join(left)
                n_words.append(high - low)
                n_removed.append(high - low - len(left))
                digests.append(hashlib.sha256(joined).hexdigest())
                kept.append(joined.decode() if places else None)
            columns = [c for n, c in zip(batch.schema.names, batch.columns) if n != _STARTS]
            names = [n for n in batch.schema.names if n != _STARTS]
            yield pa.RecordBatch.from_arrays(
                [
                    *columns,
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(digests, pa.string()),
                ],
                names=[*names, *_RESULTS],
            )


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with what is left of each text after its repeated words are taken out.

    Adds ``span_words`` and ``span_removed`` (numbers of words), ``span_sha256`` of the
    words that stay, joined by one space, and ``span_kept``, those words as a text; it is
    null where nothing was removed and the text stands as it was.
    """
    spans = repeated_windows(docs, id, text).select(
        F.col("doc").alias(_DOC), F.col("key").alias(_KEY), F.col("starts").alias(_STARTS)
    )
    same = (F.col(id).try_cast("long") == F.col(_DOC)) & (text_key(text) == F.col(_KEY))
    # Columns that have the name of a result give way to it.
    docs = docs.drop(*_RESULTS, _DOC, _KEY, _STARTS)
    joined = docs.join(spans, same, "left").drop(_DOC, _KEY)
    schema = (
        StructType(list(docs.schema.fields))
        .add("span_words", "long")
        .add("span_removed", "long")
        .add("span_kept", "string")
        .add("span_sha256", "string")
    )
    return joined.mapInArrow(lambda b: _cut(b, text), schema)
