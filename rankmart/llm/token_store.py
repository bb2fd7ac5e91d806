"""Token ids in fixed-width bit-packed blocks.

Each id takes the bits that the largest id of the vocabulary needs. 64 ids make as many
64-bit words as an id has bits, so that packing and unpacking are a few numpy operations on
whole blocks and the id at any place is found by arithmetic. A block holds whole documents,
about ``BLOCK_IDS`` ids together (a longer document has a block of its own). Blocks are rows
of a Parquet table, so that any store that Spark writes to will do:

    part, block     order of the blocks: parts are ranges of ``doc_id``
    before          ids of the part before the block
    bits, ids       width of an id, ids in the block
    doc_ids, sizes  the documents of the block, in order, and their ids
    payload         little-endian 64-bit words

Results for odd input: a null or empty text has the end id alone; a null ``doc_id`` comes
first; rows of equal ``doc_id`` are ordered by a hash of their text; equal rows are stored
each; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankmart.llm.tokens import encoder

BLOCK_IDS = 1 << 16
_GROUP = 64
SCHEMA = """part int, block int, before long, bits int, ids long,
    doc_ids array<long>, sizes array<long>, payload binary"""


def width(vocabulary: int) -> int:
    """Bits of the largest id of a vocabulary."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """The ids, ``bits`` wide each."""
    groups = -(-len(ids) // _GROUP)
    padded = np.zeros(groups * _GROUP, np.uint64)
    padded[: len(ids)] = ids
    columns = padded.reshape(groups, _GROUP)
    words = np.zeros((groups, bits), np.uint64)
    for i in range(_GROUP):
        word, shift = divmod(i * bits, 64)
        words[:, word] |= columns[:, i] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= columns[:, i] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(payload: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids."""
    words = np.frombuffer(payload, "<u8").reshape(-1, bits)
    mask = np.uint64((1 << bits) - 1)
    out = np.empty((len(words), _GROUP), np.uint32)
    for i in range(_GROUP):
        word, shift = divmod(i * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, i] = value & mask
    return out.ravel()[:count]


def id_at(payload: bytes, bits: int, place: int) -> int:
    """One id, without unpacking the others."""
    group, i = divmod(place, _GROUP)
    first, shift = divmod(i * bits, 64)
    at = 8 * (group * bits + first)
    return (int.from_bytes(payload[at : at + 16], "little") >> shift) & ((1 << bits) - 1)


def _blocks(
    batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int
) -> Iterator[pa.RecordBatch]:
    part, number, before = TaskContext.get().partitionId(), 0, 0
    known = encoder(tokenizer)
    bits = width(max(known.size, end_id + 1))
    docs: list[int | None] = []
    held: list[np.ndarray] = []
    size = 0

    def block() -> pa.RecordBatch:
        ids = np.concatenate(held)
        row = (part, number, before, bits, len(ids), docs, [len(h) for h in held])
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
        types += [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        values = [*row, pack(ids, bits)]
        names = ["part", "block", "before", "bits", "ids", "doc_ids", "sizes", "payload"]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names
        )

    end = np.array([end_id], np.uint32)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for doc, ids in zip(batch.column("doc").to_pylist(), known.encode(texts), strict=True):
            if held and size + len(ids) + 1 > BLOCK_IDS:
                yield block()
                number, before = number + 1, before + size
                docs, held, size = [], [], 0
            docs.append(doc)
            held.append(np.append(ids, end))
            size += len(ids) + 1
    if held:
        yield block()


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encodes all texts and writes them in ascending order of ``id``."""
    rows = docs.select(
        F.col(id).cast("long").alias("doc"), F.col(text).cast("string").alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc", "tie").sortWithinPartitions("doc", "tie")
    packed = ordered.drop("tie").mapInArrow(lambda b: _blocks(b, tokenizer, end_id), SCHEMA)
    packed.write.mode("overwrite").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks, with ``start``: the ids of all blocks before."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    # One row for each part, i.e. for each task that wrote.
    parts = blocks.groupBy("part").agg(F.sum("ids").alias("_ids"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_s"))
    return blocks.join(F.broadcast(starts), "part").withColumn(
        "start", F.col("_s") + F.col("before")
    ).drop("_s")


def _documents(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            (block,) = batch.slice(row, 1).to_pylist()
            sizes = np.array(block["sizes"], np.int64)
            ids = unpack(block["payload"], block["bits"], block["ids"])
            ends = np.cumsum(sizes)
            data = ids.astype("<u4").tobytes()
            each = [data[4 * (e - s) : 4 * e] for s, e in zip(sizes, ends, strict=True)]
            columns = {
                "doc": pa.array(block["doc_ids"], pa.int64()),
                "start": pa.array(block["start"] + ends - sizes),
                "size": pa.array(sizes),
                "crc": pa.array([zlib.crc32(x) for x in each], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(each, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)


def read_tokens(
    spark: SparkSession, path: str, id: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """One row per document, from the files: its place in the stream, size and checksum.

    ``with_ids`` adds ``ids``, the ids as little-endian unsigned 32-bit numbers.
    """
    schema = "doc long, start long, size long, crc long" + ", ids binary" * with_ids
    blocks = read_blocks(spark, path).select(
        "bits", "ids", "start", "doc_ids", "sizes", "payload"
    )
    found = blocks.mapInArrow(lambda b: _documents(b, with_ids), schema)
    return found.select(
        F.col("doc").alias(id),
        "start",
        F.col("size").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"),
        *(["ids"] * with_ids),
    )
