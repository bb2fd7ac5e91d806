"""Language identification: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased; ASCII characters that are no letters count as one blank. The
n-grams of one to three characters are hashed into ``BUCKETS``. Training counts n-grams by
language on a bounded sample of the labelled rows (``TRAIN_ROWS`` for each language, chosen
by a hash of id and text, so that a frequent text brings no more than its share). The matrix of log-probabilities (languages x buckets) is broadcast,
and a batch of texts is scored at once: the matrix rows of all its n-grams are added up by
text.

Results for odd input: a text that is null or has no letter is ``und`` with score 0; rows
are scored one by one, so equal rows and null ids do no harm; an empty table gives an empty
result; without any labelled row every text is ``und``. Very long texts are read in
segments. Columns other than the text are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankmart.llm.arrays import mix

GRAMS = (1, 2, 3)
BUCKETS = 1 << 15
TRAIN_ROWS = 4_000
MAX_LANGUAGES = 500
SEGMENT = 1 << 18
UNKNOWN = "und"
_BLANK = np.uint32(32)
_LETTER = np.zeros(128, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1)]] = True
_CHOICE = 1 << 30
# Lower case by character (lower() of a whole text may change its length): Latin to Armenian.
_LOWER = np.array([ord(chr(c).lower()[0]) for c in range(0x590)], np.uint32)


@dataclass(frozen=True)
class Model:
    """``weights`` has a row for each bucket and a column for each language."""

    languages: tuple[str, ...]
    prior: np.ndarray
    weights: np.ndarray


def _segments(texts: Sequence[str | None]) -> Iterator[tuple[list[str], list[int], list[int]]]:
    """Parts of texts of about a segment together: parts, their text, their own size.

    A part holds the first characters of the next one after its own, so that each n-gram
    starts in exactly one part.
    """
    parts, rows, sizes, held = [], [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text or ""), SEGMENT):
            part = text[at : at + SEGMENT + max(GRAMS) - 1]
            parts.append(part)
            rows.append(row)
            sizes.append(min(SEGMENT, len(text) - at))
            held += len(part)
            if held >= SEGMENT:
                yield parts, rows, sizes
                parts, rows, sizes, held = [], [], [], 0
    if parts:
        yield parts, rows, sizes


def _grams(parts: list[str], sizes: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: the part of each n-gram that counts, and its bucket."""
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), np.uint32)
    cased = codes < len(_LOWER)
    codes = np.where(cased, _LOWER[codes * cased], codes)
    ascii = codes < 128
    codes = np.where(ascii & ~_LETTER[codes & 127], _BLANK, codes)
    lengths = np.array([len(p) for p in parts])
    owner = np.repeat(np.arange(len(parts)), lengths)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(codes)) - starts[owner]
    own = place < np.array(sizes)[owner]
    blank = codes == _BLANK
    total = np.zeros(len(codes), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        count = len(codes) - n + 1
        if count <= 0:
            return
        total = total[:count] * np.uint64(0x100000001B3) + codes[n - 1 :].astype(np.uint64)
        if n not in GRAMS:
            continue
        counts = own[:count] & (owner[:count] == owner[n - 1 :])
        if n == 1:
            counts &= ~blank
        for k in range(n - 1):
            counts &= ~(blank[k : k + count] & blank[k + 1 : k + 1 + count])
        chosen = np.flatnonzero(counts)
        buckets = mix(total[chosen] + np.uint64(n)) % np.uint64(BUCKETS)
        yield owner[chosen], buckets.astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams by language and bucket, and rows by language (bucket -1)."""
    totals: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        languages = batch.column("lang").to_pylist()
        texts = batch.column("text").to_pylist()
        for language in languages:
            rows[language] = rows.get(language, 0) + 1
            totals.setdefault(language, np.zeros(BUCKETS, np.int64))
        for parts, owners, sizes in _segments(texts):
            for part, buckets in _grams(parts, sizes):
                spoken = np.array([languages[r] for r in owners], dtype=object)[part]
                for language in set(spoken):
                    totals[language] += np.bincount(
                        buckets[spoken == language], minlength=BUCKETS
                    )
    for language, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([language] * (len(at) + 1), pa.string()),
                "bucket": pa.array(np.append(at, -1).astype(np.int32)),
                "n": pa.array(np.append(counts[at], rows[language])),
            }
        )


def train(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    rows: int = TRAIN_ROWS,
    id: str = "doc_id",
) -> Model:
    """Fits the model on about ``rows`` rows of each language; null languages are left out.

    The rows of a language are chosen by a hash of id and text, all of them where there are
    fewer; rows equal in both are chosen together. Without a column ``id`` the text alone
    decides. What comes to the driver is bounded by languages times buckets.
    """
    known = [F.col(id).cast("string")] if id in docs.columns else []
    labelled = docs.select(
        F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(text).cast("string"), F.lit(1), *known).alias("draw"),
    ).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in _language_sizes(labelled)}
    if not sizes:
        return Model((), np.zeros(0), np.zeros((BUCKETS, 0)))
    spark = docs.sparkSession
    shares = [(name, int(min(1.0, rows / n) * _CHOICE)) for name, n in sizes.items()]
    share = F.broadcast(spark.createDataFrame(shares, "lang string, below long"))
    chosen = (
        labelled.join(share, "lang")
        .filter(F.pmod("draw", F.lit(_CHOICE)) < F.col("below"))
        .select("lang", "text")
    )
    counts = (
        chosen.mapInArrow(_counted, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    languages = tuple(sorted(sizes))
    number = {name: i for i, name in enumerate(languages)}
    column = np.array([number[x] for x in counts["lang"].to_pylist()], np.int64)
    bucket = counts["bucket"].to_numpy()
    n = counts["n"].to_numpy()
    grams = bucket >= 0
    weights = np.ones((BUCKETS, len(languages)))
    np.add.at(weights, (bucket[grams], column[grams]), n[grams])
    weights = np.log(weights) - np.log(weights.sum(axis=0))
    seen = np.array([sizes[name] for name in languages], float)
    return Model(languages, np.log(seen / seen.sum()), weights)


def _language_sizes(labelled: DataFrame) -> list:
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    found = sizes.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return found


def _scored(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """For each text the number of its language (-1 if it has none) and the probability."""
    totals = np.tile(model.prior, (len(texts), 1))
    step = max(1 << 14, (1 << 21) // max(1, len(model.languages)))
    for parts, rows, sizes in _segments(texts):
        rows = np.array(rows)
        for part, buckets in _grams(parts, sizes):
            for at in range(0, len(part), step):
                these = part[at : at + step]
                heads = np.flatnonzero(np.append(True, these[1:] != these[:-1]))
                sums = np.add.reduceat(model.weights[buckets[at : at + step]], heads, axis=0)
                np.add.at(totals, rows[these[heads]], sums)
    lettered = np.array([any(map(str.isalpha, t or "")) for t in texts], dtype=bool)
    best = totals.argmax(axis=1)
    top = totals[np.arange(len(texts)), best]
    score = 1.0 / np.exp(totals - top[:, None]).sum(axis=1)
    return np.where(lettered, best, -1), np.where(lettered, score, 0.0)


def identify(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    language: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """``docs`` with the likeliest language and its probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.columns[-1].to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if texts and known.languages:
                found, scores = _scored(texts, known)
                names = [known.languages[i] if i >= 0 else UNKNOWN for i in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores)],
                names=[*batch.schema.names[:-1], language, score],
            )

    # A column that has the name of a result gives way to it.
    texts = F.col(text).cast("string").alias("_text")
    kept = docs.select("*", texts).drop(*{language, score} - {text})
    fields = [f for f in docs.schema.fields if f.name in kept.columns]
    schema = StructType(fields).add(language, "string").add(score, "double")
    return kept.mapInArrow(predict, schema)


def held_out(id: Column, folds: int, fold: int) -> Column:
    """Whether a document is kept from training: its crc32 modulo ``folds`` is ``fold``."""
    return F.coalesce(F.crc32(id.cast("string")) % folds == fold, F.lit(False))
