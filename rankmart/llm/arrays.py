"""Texts of an Arrow batch as numpy arrays: bytes, words, hashes, windows of words.

The functions work on the bytes of many texts at once and hold temporary arrays for a
megabyte or so of them, whatever the size of the batch or of one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text looked at together.
CHUNK = 1 << 20
_BLOCK = 1 << 16
_ODD = np.uint64(0x9E3779B97F4A7C15)

#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins (with the end of the last)."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, where, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together, at least one text each."""
    first, last = 0, len(offsets) - 1
    while first < last:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(last, max(first + 1, end))
        yield first, end
        first = end


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts have about ``limit`` bytes together."""
    _, offsets = utf8(batch.column(column))
    for first, end in groups(offsets, limit):
        yield batch.slice(first, end - first)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, spaces: np.ndarray = SPACES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and each text's first word (with the end of the last)."""
    inside = ~spaces[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    edges = offsets[1:][offsets[1:] > 0] - 1
    finishes[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, offsets)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0
) -> np.ndarray:
    """A 64-bit hash of each word's bytes; other seeds give independent hashes."""
    draw = np.random.default_rng(seed)
    letters = draw.integers(1, 1 << 63, 256, dtype=np.uint64)
    powers = np.cumprod(np.full(_BLOCK, draw.integers(1, 1 << 63, dtype=np.uint64) * 2 + 1))
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        end = int(np.searchsorted(ends, starts[first] + CHUNK, "right"))
        end = max(first + 1, end)
        sizes = ends[first:end] - starts[first:end]
        heads = np.cumsum(sizes) - sizes
        within = np.arange(sizes.sum()) - np.repeat(heads, sizes)
        at = within + np.repeat(starts[first:end], sizes)
        values = letters[data[at]] * powers[within & (_BLOCK - 1)]
        if sizes.max() > _BLOCK:
            values *= (2 * (within // _BLOCK) + 1).astype(np.uint64)
        out[first:end] = np.add.reduceat(values, heads)
        first = end
    return mix(out)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive words, from each word on where they exist."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(width):
        total = total * _ODD + words[k : k + count]
    return mix(total)


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each word, from each text's first word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def signed(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit numbers as Spark's long."""
    return pa.array(values.view(np.int64))
