"""Periodic runs of words, found with an enhanced suffix array.

A *run* is a stretch of words with smallest period q (words q apart are equal), of at least
``MIN_WORDS`` words and ``MIN_PERIODS`` periods, that no neighbouring word extends.

1. The suffixes of a text are sorted by prefix doubling; every round sorts only those that
   are not told apart yet. The ranks of all rounds also give the common prefix (LCP) of
   neighbours in the order.
2. Each border between two neighbours with an LCP of d > 0 splits a range of suffixes that
   share d words into two sides. For the suffixes i of the smaller side, i + d and i - d are
   looked up in the inverse array: if one lies on the other side, the first d words are
   followed by themselves and by another word then, a *branching* square. Listing smaller
   sides alone costs n log n at most. No tree is built; a side is a pair of numbers.
3. A run ends with exactly one branching square of its period. Squares are rotated to the
   left as far as the words agree. At each end shorter periods come first, and longer
   squares inside a run found there are multiples of its period.

Many short texts are sorted together, about a megabyte at a time, with a word of its own at
the end of each text. A text is looked at whole, so memory grows with the longest text (about
10 numbers of 8 bytes a word, and 8 bytes a word for each doubling round).

Results for odd input: a null or empty text, or one of white space, has no words and no runs;
equal rows have equal results; a null id is never looped; an empty table gives an empty result;
other columns are kept, those named like a result give way to it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankmart.llm.arrays import slices

MIN_WORDS = 6
MIN_PERIODS = 4
#: Suffixes of smaller sides looked up together.
_TOGETHER = 1 << 21
_ID, _TEXT = "_run_id", "_run_text"
_RESULTS = {
    "n_runs": "long",
    "start": "long",
    "length": "long",
    "period": "long",
    "exponent_milli": "long",
    "runs_sha256": "string",
    "collapsed_sha256": "string",
    "runs": "array<struct<start: long, length: long, period: long>>",
    "collapsed": "string",
}

#: From an id and the words of its text to the words that are looked at.
Change = Callable[[object, list[bytes]], list[bytes]]


def suffixes(codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes in order, and ranks by round: ``ranks[k]`` is equal for two suffixes
    where their first 2^k codes are. The last code of each text occurs nowhere else."""
    count = len(codes)
    order = np.argsort(codes, kind="stable")
    slots = np.arange(count)
    rank = np.empty(count, np.int64)
    keys = codes[order]
    ranks: list[np.ndarray] = []
    step = 0
    while True:
        first = np.ones(len(slots), bool)
        first[1:] = keys[1:] != keys[:-1]
        head = np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))
        rank = rank.copy()
        rank[order[slots]] = slots[head]
        ranks.append(rank)
        alone = first.copy()
        alone[:-1] &= first[1:]
        slots = slots[~alone]
        if not len(slots):
            return order, ranks
        step = 2 * step or 1
        # A suffix that equals another so far has not met the end of its text.
        found = order[slots]
        keys = rank[found] * count + rank[found + step]
        sorted_ = np.argsort(keys)
        order[slots] = found[sorted_]
        keys = keys[sorted_]


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """``lcp[k]``: equal codes at the start of the suffixes in places k - 1 and k.

    The first and one after the last are -1.
    """
    lcp = np.zeros(len(order) + 1, np.int64)
    lcp[[0, -1]] = -1
    near = np.flatnonzero(ranks[0][order[:-1]] == ranks[0][order[1:]])
    one, two = order[near], order[near + 1]
    shared = np.zeros(len(near), np.int64)
    for level in reversed(range(len(ranks))):
        equal = ranks[level][one] == ranks[level][two]
        ahead = equal.astype(np.int64) << level
        shared += ahead
        one, two = one + ahead, two + ahead
    lcp[near + 1] = shared
    return lcp


def _sides(lcp: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each border: the nearest one before that is not larger, and after that is smaller."""
    before, after = np.arange(len(lcp)) - 1, np.arange(len(lcp)) + 1
    # What a larger border has passed over is larger still: jump to where it points.
    open_ = nodes
    while len(open_ := open_[lcp[before[open_]] > lcp[open_]]):
        before[open_] = before[before[open_]]
    open_ = nodes
    while len(open_ := open_[lcp[after[open_]] >= lcp[open_]]):
        after[open_] = after[after[open_]]
    return before[nodes], after[nodes]


def branching_squares(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and half of all squares whose second half is not followed by its first code."""
    order, ranks = suffixes(codes)
    lcp = common_prefixes(order, ranks)
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.arange(len(order))
    nodes = np.flatnonzero(lcp > 0)
    before, after = _sides(lcp, nodes)
    left = nodes - before <= after - nodes
    sizes = np.where(left, nodes - before, after - nodes)
    low = np.where(left, before, nodes)
    other_low, other_high = np.where(left, nodes, before), np.where(left, after, nodes)
    starts: list[np.ndarray] = []
    halves: list[np.ndarray] = []
    ends = np.cumsum(sizes)
    at = 0
    while at < len(nodes):
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + _TOGETHER, "right")))
        size = sizes[at:end]
        node = np.repeat(np.arange(at, end), size)
        within = np.arange(len(node)) - np.repeat(ends[at:end] - size - done, size)
        suffix, half = order[low[node] + within], lcp[nodes[node]]
        for ahead in (True, False):
            partner = suffix + half if ahead else suffix - half
            place = inverse[np.maximum(partner, 0)]
            met = (partner >= 0) & (place >= other_low[node]) & (place < other_high[node])
            starts.append((suffix if ahead else partner)[met])
            halves.append(half[met])
        at = end
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *starts]), np.concatenate([none, *halves])


def _rotated(codes: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How far to the left codes a period apart are equal, from each start on."""
    at = start.copy()
    going = np.arange(len(at))
    for _ in range(32):
        left = at[going] - 1
        agree = (left >= 0) & (codes[left] == codes[left + period[going]])
        going = going[agree]
        at[going] -= 1
        if not len(going):
            return at
    for one in going:
        high, apart, width = int(at[one]), int(period[one]), 256
        while high:
            low = max(0, high - width)
            differ = np.flatnonzero(codes[low:high] != codes[low + apart : high + apart])
            if len(differ):
                high = low + int(differ[-1]) + 1
                break
            high, width = low, 2 * width
        at[one] = high
    return at


def find_runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs, by start, then period.

    ``codes`` may hold several texts, each with codes of its own and a last one that occurs
    nowhere else.
    """
    start, period = branching_squares(codes)
    end = start + 2 * period
    # A run of the least length agrees there and beside the square.
    least = end - np.maximum(MIN_WORDS, MIN_PERIODS * period)
    likely = least >= 0
    start, period, end, least = (x[likely] for x in (start, period, end, least))
    likely = codes[least] == codes[least + period]
    likely &= codes[start - 1] == codes[start - 1 + period]
    start, period, end = (x[likely] for x in (start, period, end))
    order = np.lexsort((period, end))
    start, period, end = (x[order] for x in (start, period, end))
    found: list[np.ndarray] = []
    while len(end):
        first = np.ones(len(end), bool)
        first[1:] = end[1:] != end[:-1]
        left = _rotated(codes, start[first], period[first])
        q, until = period[first], end[first]
        long_ = until - left >= np.maximum(MIN_WORDS, MIN_PERIODS * q)
        found.append(np.stack((left, until, q))[:, long_])
        # What begins inside the run that ends there too has a multiple of its period.
        reach = left[np.cumsum(first) - 1]
        next_ = ~first & (start < reach)
        start, period, end = (x[next_] for x in (start, period, end))
    left, until, q = np.concatenate([np.zeros((3, 0), np.int64), *found], axis=1)
    order = np.lexsort((q, left))
    return left[order], until[order], q[order]


def planted_loop(id: object, words: list[bytes]) -> list[bytes]:
    """Every tenth text, by the checksum of its id, gets a loop in place of its end."""
    if id is None or not words:
        return words
    h = zlib.crc32(str(id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def _coded(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number per word, equal for equal words of one text, and each text's first place."""
    codes: list[int] = []
    first = [0]
    used = 0
    for words in texts:
        known: dict[bytes, int] = {}
        codes += [known.setdefault(word, used + len(known)) for word in words]
        used += len(known)
        codes.append(used)
        used += 1
        first.append(len(codes))
    return np.array(codes, np.int64), np.array(first, np.int64)


def _found(
    batches: Iterator[pa.RecordBatch], kept: list[str], change: Change | None, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, _TEXT):
            texts = [(t or "").encode().split() for t in batch.column(_TEXT).to_pylist()]
            if change:
                ids = batch.column(_ID).to_pylist()
                texts = [change(i, words) for i, words in zip(ids, texts, strict=True)]
            codes, first = _coded(texts)
            left, until, period = find_runs(codes)
            bounds = np.searchsorted(left, first)
            rows: list[tuple] = []
            for row, words in enumerate(texts):
                mine = slice(bounds[row], bounds[row + 1])
                starts = left[mine] - first[row]
                lengths, periods = until[mine] - left[mine], period[mine]
                rows.append(_result(words, starts, lengths, periods))
            columns = [batch.column(name) for name in kept]
            results = zip(*rows, strict=True) if rows else [[] for _ in _RESULTS]
            types = [schema.field(len(kept) + k).type for k in range(len(_RESULTS))]
            columns += [pa.array(list(v), t) for v, t in zip(results, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)


def _result(
    words: list[bytes], starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray
) -> tuple:
    if not len(starts):
        text = b" ".join(words)
        empty = hashlib.sha256().hexdigest()
        return (0, None, None, None, None, empty, hashlib.sha256(text).hexdigest(), [], text)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts + periods, 1)
    np.add.at(edges, starts + lengths, -1)
    text = b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edges)[:-1] == 0)])
    told = list(zip(starts.tolist(), lengths.tolist(), periods.tolist(), strict=True))
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in told).encode())
    # The longest; max takes the first of equals, and runs are by start, then period.
    start, length, period = max(told, key=lambda run: run[1])
    return (
        len(told),
        start,
        length,
        period,
        1000 * length // period,
        digest.hexdigest(),
        hashlib.sha256(text).hexdigest(),
        [{"start": s, "length": n, "period": q} for s, n, q in told],
        text,
    )


def periodic_runs(
    docs: DataFrame, id: str = "doc_id", text: str = "text", change: Change | None = None
) -> DataFrame:
    """``docs`` without its text, with the runs of each text's words.

    Adds ``n_runs``, ``start`` (word number), ``length``, ``period`` and ``exponent_milli``
    of the longest run (null without any; of equals the first), ``runs`` by start, then
    period, ``collapsed`` (the words, joined by one space, without those that a run repeats
    after its first period) and the SHA-256 of both. ``change`` may alter a text's words.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = [c for c in docs.columns if c != text and c not in _RESULTS]
    fields = [f for f in docs.schema.fields if f.name in kept]
    schema = StructType(list(fields))
    for name, type_ in _RESULTS.items():
        schema = schema.add(name, StructType.fromDDL(f"x {type_}")[0].dataType)
    rows = docs.select(
        *kept, F.col(id).cast("string").alias(_ID), F.col(text).cast("string").alias(_TEXT)
    )
    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(lambda batches: _found(batches, kept, change, arrow), schema)
