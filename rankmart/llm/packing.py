"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

A sequence is filled greedily: the longest piece left, then again and again the longest
that still fits. Where a gap is left, its smallest piece is taken out again and replaced by
the two unpacked pieces that fill the larger gap best, if they fill it better.

The method needs only the number of pieces of each length, at most ``capacity`` numbers,
whatever the size of the table. Spark counts them, the driver makes a plan of a few
thousand *patterns* (lengths of one sequence, and how many such sequences), and Spark deals
the pieces of each length out to the places that the plan has for it, by their number
within the length. No task holds more than its share, however many pieces have one length.

The task that cuts a piece also numbers it among its own pieces of that length. The numbers
that other tasks come before are known from the counts of pieces by task and length: where
those are at most ``MAX_STARTS`` they are sent to the tasks, beyond that joined. So pieces
are stored once, and their ids move once, to their sequence. ``write_sequences`` gathers
them, ``read_pieces`` reads them back.

Results for odd input: a null or empty text is one piece with the end id; equal rows are
packed each; a null ``doc_id`` is kept; an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankmart.llm.common import shuffle_files_dropped, stored
from rankmart.llm.tokens import encoder

CAPACITY = 4096
#: Counts by task and length that may be sent to all tasks, 16 bytes each.
MAX_STARTS = 2_000_000
_PART, _NUMBER, _START = "_part", "_number", "_start"
_WRITTEN = """sequence_id long, ids binary,
    pieces array<struct<doc: long, piece: int, start: long, length: long>>"""


def _cut(
    batches: Iterator[pa.RecordBatch],
    tokenizer: str,
    end_id: int,
    capacity: int,
    with_ids: bool,
    narrow: bool,
) -> Iterator[pa.RecordBatch]:
    known = encoder(tokenizer)
    half = narrow and max(known.size, end_id + 1) <= 1 << 16
    end = np.array([end_id], np.uint32)
    for batch in batches:
        docs: list[int | None] = []
        rows: list[tuple[int, int, int, int]] = []
        data: list[bytes] = []

        def out() -> pa.RecordBatch:
            numbers = np.array(rows, np.int64).reshape(-1, 4)
            columns = {
                "doc": pa.array(docs, pa.int64()),
                "piece": pa.array(numbers[:, 0].astype(np.int32)),
                "start": pa.array(numbers[:, 1]),
                "length": pa.array(numbers[:, 2]),
                "crc": pa.array(numbers[:, 3]),
            }
            if with_ids:
                columns["ids"] = pa.array(data, pa.binary())
            return pa.RecordBatch.from_pydict(columns)

        texts = batch.column("text").to_pylist()
        for doc, ids in zip(batch.column("doc").to_pylist(), known.encode(texts), strict=True):
            ids = np.append(ids, end).astype("<u4")
            for number, at in enumerate(range(0, len(ids), capacity)):
                part = ids[at : at + capacity].tobytes()
                docs.append(doc)
                rows.append((number, at, len(part) // 4, zlib.crc32(part)))
                if with_ids:
                    data.append(ids[at : at + capacity].astype("<u2").tobytes() if half else part)
            if len(rows) >= 4096:
                yield out()
                docs, rows, data = [], [], []
        yield out()


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
    narrow: bool = False,
    numbered: bool = False,
) -> DataFrame:
    """Each document's ids with the end id, cut where longer than ``capacity``.

    ``ids`` are little-endian unsigned 32-bit numbers, ``ids_crc32`` their checksum. With
    ``narrow`` they have 16 bits where the vocabulary allows; the checksum is the same.
    ``numbered`` numbers them for :func:`deal` in the task that cuts them.
    """
    schema = "doc long, piece int, start long, length long, crc long" + ", ids binary" * with_ids
    schema += f", {_PART} int, {_NUMBER} long" * numbered
    rows = docs.select(
        F.col(id).cast("long").alias("doc"), F.col(text).cast("string").alias("text")
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _cut(batches, tokenizer, end_id, capacity, with_ids, narrow)
        return _numbered(cut) if numbered else cut

    cut = rows.mapInArrow(pieces, schema)
    return cut.withColumnsRenamed({"doc": id, "crc": "ids_crc32"})


@dataclass(frozen=True)
class Plan:
    """Where pieces go: entry i takes the pieces of one length numbered from ``first[i]`` on.

    ``each[i]`` of them go to one sequence, from ``offset[i]`` on; the sequences count up
    from ``sequence[i]``. Entries are sorted by length and number.
    """

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    each: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by their length and number within it."""
        # Lengths are few, numbers many: a pair becomes one number by counting entries.
        heads = np.searchsorted(self.length, length)
        ends = np.searchsorted(self.length, length, "right")
        while (open_ := ends - heads > 1).any():
            middle = (heads + ends) // 2
            above = open_ & (self.first[np.minimum(middle, len(self.first) - 1)] > rank)
            ends = np.where(above, middle, ends)
            heads = np.where(open_ & ~above, middle, heads)
        within = rank - self.first[heads]
        turn, place = np.divmod(within, self.each[heads])
        return self.sequence[heads] + turn, self.offset[heads] + place * length


def _fill(left: np.ndarray, lengths: list[int], capacity: int) -> tuple[dict[int, int], int]:
    """Greedy filling: how many of each length, and the gap."""
    taken: dict[int, int] = {}
    gap, limit = capacity, len(lengths)
    while gap and limit:
        limit = bisect_right(lengths, gap, 0, limit)
        if not limit:
            break
        length = lengths[limit - 1]
        count = min(gap // length, int(left[length]))
        taken[length] = count
        gap -= count * length
        limit -= 1
    return taken, gap


def _two_for_smallest(
    taken: dict[int, int], gap: int, left: np.ndarray, lengths: np.ndarray
) -> dict[int, int]:
    """Replaces the smallest piece by two that fill its place and the gap more tightly."""
    smallest = min(taken)
    room = gap + smallest
    free = left[lengths].copy()
    for length, count in taken.items():
        free[np.searchsorted(lengths, length)] -= count
    free[np.searchsorted(lengths, smallest)] += 1
    open_ = lengths[free > 0]
    partner = np.searchsorted(open_, room - open_, "right") - 1
    partner = np.minimum(partner, np.arange(len(open_)))
    single = free[free > 0] < 2
    partner = np.where((partner == np.arange(len(open_))) & single, partner - 1, partner)
    sums = np.where(partner >= 0, open_ + open_[partner], 0)
    sums[sums > room] = 0
    best = int(sums.argmax()) if len(sums) else 0
    if not len(sums) or sums[best] <= smallest:
        return taken
    changed = dict(taken)
    changed[smallest] -= 1
    for length in (int(open_[best]), int(open_[partner[best]])):
        changed[length] = changed.get(length, 0) + 1
    return {length: count for length, count in changed.items() if count}


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Packs pieces, given as the number of each length, into few sequences."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not in 1..{capacity}")
        left[length] = count
    used = np.zeros(capacity + 1, np.int64)
    entries: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    while (lengths := np.flatnonzero(left)).size:
        taken, gap = _fill(left, lengths.tolist(), capacity)
        if gap:
            taken = _two_for_smallest(taken, gap, left, lengths)
        times = min(int(left[length]) // count for length, count in taken.items())
        offset = 0
        for length in sorted(taken, reverse=True):
            count = taken[length]
            entries.append((length, int(used[length]), sequences, offset, count))
            used[length] += count * times
            left[length] -= count * times
            offset += count * length
        sequences += times
    columns = np.array(sorted(entries), np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences=sequences)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the rows of this task among those of their length."""
    part = TaskContext.get().partitionId()
    used = np.zeros(1, np.int64)
    for batch in batches:
        length = batch.column("length").to_numpy()
        if len(length):
            used = np.append(used, np.zeros(max(0, length.max() + 1 - len(used)), np.int64))
        order = np.argsort(length, kind="stable")
        values, first, sizes = np.unique(length[order], return_index=True, return_counts=True)
        number = np.empty(len(length), np.int64)
        number[order] = np.arange(len(length)) - np.repeat(first, sizes)
        number += used[length]
        used[values] += sizes
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(length), part, np.int32)), pa.array(number)],
            names=[*batch.schema.names, _PART, _NUMBER],
        )


@dataclass(frozen=True)
class Starts:
    """Number of the first piece of each (task, length), sorted by both."""

    keys: np.ndarray
    first: np.ndarray

    def of(self, part: np.ndarray, length: np.ndarray) -> np.ndarray:
        return self.first[np.searchsorted(self.keys, (part.astype(np.int64) << 32) + length)]


def best_two_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, with ``length``) with ``sequence_id`` and ``offset``."""
    # Columns that have the name of a result give way to it.
    pieces = pieces.drop("sequence_id", "offset", _PART, _NUMBER, _START)
    pieces = pieces.withColumn("length", F.col("length").cast("long"))
    schema = StructType(list(pieces.schema.fields)).add(_PART, "integer").add(_NUMBER, "long")
    return deal(pieces.mapInArrow(_numbered, schema), capacity)


def deal(
    numbered: DataFrame, capacity: int = CAPACITY, max_starts: int = MAX_STARTS
) -> DataFrame:
    """Plans the sequences and gives each piece its place."""
    spark = numbered.sparkSession
    rows = stored(numbered, "pieces")
    fields = [f for f in rows.schema.fields if f.name not in (_PART, _NUMBER)]
    sizes = stored(rows.groupBy(_PART, "length").agg(F.count(F.lit(1)).alias("n")), "sizes")
    # At most one row for each length.
    counts = sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()
    made = plan({r["length"]: r["n"] for r in counts}, capacity)
    # One row for each task that cut pieces of a length.
    before = W.partitionBy("length").orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        _PART, "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_START)
    )
    known = None
    if sizes.count() <= max_starts:
        table = starts.orderBy(_PART, "length").toArrow()
        part, length, first = (table[c].to_numpy() for c in (_PART, "length", _START))
        known = Starts((part.astype(np.int64) << 32) + length, first)
    else:
        rows = rows.join(starts, [_PART, "length"])
    shared = spark.sparkContext.broadcast((made, known))
    names = [f.name for f in fields]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, known = shared.value
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", _NUMBER))
            if known is None:
                first = batch.column(_START).to_numpy()
            else:
                first = known.of(batch.column(_PART).to_numpy(), length)
            sequence, offset = made.place(length, first + number)
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    schema = StructType(list(fields)).add("sequence_id", "long").add("offset", "long")
    return rows.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
    narrow: bool = False,
) -> DataFrame:
    """The pieces of all documents with their sequence and place there."""
    cut = token_pieces(docs, tokenizer, end_id, capacity, id, text, with_ids, narrow, True)
    return deal(cut, capacity)


def write_sequences(packed: DataFrame, path: str, id: str = "doc_id") -> None:
    """Writes the sequences: ``sequence_id``, ``ids`` and, in their order, the ``pieces``.

    ``packed`` is the result of ``pack_documents`` with ids, narrow or not. A piece is the document, its
    number there and its first id there, and the number of its ids.
    """
    part = F.struct("offset", F.col(id).alias("doc"), "piece", "start", "length", "ids")
    parts = packed.groupBy("sequence_id").agg(F.collect_list(part).alias("parts"))
    with shuffle_files_dropped(packed.sparkSession):
        parts.mapInArrow(_written, _WRITTEN).write.mode("overwrite").parquet(path)


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, len(whole), 256):
            yield _sequences_of(whole.slice(at, 256))


def _sequences_of(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Some sequences with their pieces in order of the offset."""
    lists = batch.column("parts")
    parts = lists.flatten()
    counts = np.diff(lists.offsets.to_numpy())
    sequence = np.repeat(np.arange(len(batch)), counts)
    order = np.lexsort((parts.field("offset").to_numpy(zero_copy_only=False), sequence))
    data = parts.field("ids").to_pylist()
    ends = np.cumsum(counts)
    ids = [
        b"".join([data[k] for k in order[end - count : end]])
        for end, count in zip(ends, counts, strict=True)
    ]
    names = ["doc", "piece", "start", "length"]
    told = pa.StructArray.from_arrays(
        [parts.field(n).take(pa.array(order)) for n in names], names=names
    )
    offsets = pa.array(np.append(0, ends).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("sequence_id"),
            pa.array(ids, pa.binary()),
            pa.ListArray.from_arrays(offsets, told),
        ],
        names=["sequence_id", "ids", "pieces"],
    )


def _read(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        # Some sequences at a time: those of a batch together can be large.
        for at in range(0, len(whole), 256):
            yield _pieces_of(whole.slice(at, 256), with_ids)


def _pieces_of(batch: pa.RecordBatch, with_ids: bool) -> pa.RecordBatch:
    """The pieces of some sequences, one behind the other."""
    lists = batch.column("pieces")
    pieces = lists.flatten()
    counts = np.diff(lists.offsets.to_numpy())
    sizes = pieces.field("length").to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    heads = np.cumsum(counts) - counts
    # Ids before each sequence, and of it.
    before = np.append(0, ends)[heads]
    totals = np.append(0, ends)[heads + counts] - before
    data = batch.column("ids").to_pylist()
    each: list[bytes] = []
    for row, ids in enumerate(data):
        total = int(totals[row])
        wide = len(ids) // max(1, total)
        if wide not in (2, 4) or wide * total != len(ids):
            raise ValueError(f"sequence {batch.column('sequence_id')[row]} is not its pieces")
        if wide == 2:
            ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
        bounds = np.append(0, np.cumsum(sizes[heads[row] : heads[row] + counts[row]])) * 4
        each += [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    columns = {
        "doc": pieces.field("doc"),
        "piece": pieces.field("piece"),
        "start": pieces.field("start"),
        "length": pa.array([len(x) // 4 for x in each], pa.int64()),
        "crc": pa.array([zlib.crc32(x) for x in each], pa.int64()),
    }
    if with_ids:
        columns["ids"] = pa.array(each, pa.binary())
    sequence = np.repeat(batch.column("sequence_id").to_numpy(), counts)
    columns["sequence_id"] = pa.array(sequence)
    columns["offset"] = pa.array(ends - sizes - np.repeat(before, counts))
    return pa.RecordBatch.from_pydict(columns)


def read_pieces(
    spark: SparkSession, path: str, id: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """One row per piece, from the written sequences: its place, length and checksum there."""
    schema = "doc long, piece int, start long, length long, crc long" + ", ids binary" * with_ids
    rows = spark.read.schema(_WRITTEN).parquet(path)
    found = rows.mapInArrow(
        lambda b: _read(b, with_ids), f"{schema}, sequence_id long, offset long"
    )
    return found.withColumnsRenamed({"doc": id, "crc": "ids_crc32"})


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [
            b"".join(p["ids"] for p in sorted(parts, key=lambda p: p["offset"]))
            for parts in batch.column("parts").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("sequence_id"), pa.array(parts, pa.binary())],
            names=["sequence_id", "ids"],
        )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id`` and ``ids`` (32-bit, little-endian).

    A sequence gathers at most ``capacity`` ids.
    """
    parts = F.collect_list(F.struct("offset", "ids")).alias("parts")
    return packed.groupBy("sequence_id").agg(parts).mapInArrow(
        _joined, "sequence_id long, ids binary"
    )
