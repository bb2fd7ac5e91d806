"""Quality classifier: regularised quadratic discriminant analysis.

A text is described by a few statistics, transformed to be closer to normal (logarithms of
sizes, square roots of shares). For each class the mean and covariance of the statistics
come from sums that Spark gathers over all labelled rows; only those sums reach the driver.
Labels in a table of their own are joined to the statistics, so that no text is shuffled.
Covariances are shrunk towards the common covariance and that towards its diagonal, and
factored once. The score is the logistic of the difference of the two log densities
(Mahalanobis distances by the cached Cholesky factors) and log priors.

Results for odd input: a null or empty text has statistics like any other and gets a score;
labels that are null or not 0 or 1 are not learned from; with one class only, or none, the
score is 1, 0 or 0.5 for all; an empty table gives an empty result; equal rows get equal
scores. Columns other than the text are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from rankmart.llm.arrays import SPACES, owners, slices, utf8, word_bounds, word_hashes

TOWARDS_COMMON = 0.2
TOWARDS_DIAGONAL = 0.1
FLOOR = 1e-4

STATISTICS = [
    "log_bytes",
    "log_words",
    "word_length",
    "upper",
    "digits",
    "sentence_marks",
    "symbols",
    "beyond_ascii",
    "log_lines",
    "different_words",
    "repeated_next",
    "short_words",
    "capitalised",
    "spaces",
]


def _kind(characters: str) -> np.ndarray:
    table = np.zeros(256)
    table[list(characters.encode())] = 1
    return table


_UPPER = _kind("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _kind("abcdefghijklmnopqrstuvwxyz")
_DIGITS = _kind("0123456789")
_MARKS = _kind(".,;:?!'\"")
_LINES = _kind("\n")
_HIGH = np.arange(256) >= 128
_SYMBOLS = 1.0 - np.clip(_UPPER + _LOWER + _DIGITS + _MARKS + _HIGH + SPACES, 0, 1)
_KINDS = [_UPPER, _DIGITS, _MARKS, _SYMBOLS, _HIGH.astype(float), _LINES, SPACES.astype(float)]


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` by text, 0 for a text without any."""
    return np.diff(np.append(0.0, np.cumsum(values, dtype=np.float64))[first])


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` for each text."""
    data, offsets = utf8(texts)
    size = np.diff(offsets).astype(float)
    starts, ends, first = word_bounds(data, offsets)
    words = np.diff(first).astype(float)
    hashes, owner = word_hashes(data, starts, ends), owners(first)
    lengths = (ends - starts).astype(float)
    share = np.maximum(size, 1)
    each = np.maximum(words, 1)
    upper, digits, marks, symbols, high, lines, spaces = (
        _sums(kind[data], offsets) for kind in _KINDS
    )
    pairs = hashes * np.uint64(0x9E3779B97F4A7C15) + owner.astype(np.uint64)
    order = np.argsort(pairs)
    new = np.append(True, pairs[order][1:] != pairs[order][:-1]) if len(order) else []
    different = np.bincount(owner[order], weights=new, minlength=len(size))
    again = np.append(False, (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]))
    again = again[: len(hashes)]
    return np.column_stack(
        [
            np.log1p(size),
            np.log1p(words),
            np.log1p(_sums(lengths, first) / each),
            np.sqrt(upper / share),
            np.sqrt(digits / share),
            np.sqrt(marks / share),
            np.sqrt(symbols / share),
            np.sqrt(high / share),
            np.log1p(lines),
            different / each,
            np.sqrt(_sums(again, first) / each),
            np.sqrt(_sums(lengths <= 3, first) / each),
            np.sqrt(_sums(_UPPER[data[starts]], first) / each),
            spaces / share,
        ]
    )


@dataclass(frozen=True)
class Model:
    """Class means, inverse Cholesky factors, half log determinants and log priors."""

    means: np.ndarray
    factors: np.ndarray
    logs: np.ndarray
    priors: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        densities = []
        for k in (0, 1):
            if not np.isfinite(self.priors[k]):
                densities.append(np.full(len(rows), -np.inf))
                continue
            away = (rows - self.means[k]) @ self.factors[k].T
            densities.append(self.priors[k] - self.logs[k] - 0.5 * (away**2).sum(axis=1))
        if not np.isfinite(self.priors).any():
            return np.full(len(rows), 0.5)
        return 1.0 / (1.0 + np.exp(np.clip(densities[0] - densities[1], -700, 700)))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The statistics of each text as a list, after the other columns."""
    width = len(STATISTICS)
    for whole in batches:
        for batch in slices(whole, "text"):
            rows = statistics(batch.column("text"))
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))],
                names=[*batch.schema.names[:-1], "statistics"],
            )


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number, sums and sums of products by class, as one list of numbers for each class."""
    width = len(STATISTICS) + 1
    totals = np.zeros((2, width, width))
    for batch in batches:
        rows = batch.column("statistics").flatten().to_numpy().reshape(-1, width - 1)
        rows = np.column_stack([np.ones(len(rows)), rows])
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        for k in (0, 1):
            mine = rows[labels == k]
            totals[k] += mine.T @ mine
    yield pa.RecordBatch.from_pydict(
        {
            "label": pa.array(np.repeat([0, 1], width * width).astype(np.int32)),
            "cell": pa.array(np.tile(np.arange(width * width), 2).astype(np.int32)),
            "total": pa.array(totals.ravel()),
        }
    )


def train(labelled: DataFrame, text: str = "text", label: str = "quality") -> Model:
    """Fits the model on all rows with a label of 0 or 1."""
    rows = labelled.select(
        F.col(label).cast("int").alias("label"), F.col(text).cast("string").alias("text")
    ).filter("label IN (0, 1)")
    return _trained(rows.mapInArrow(_described, "label int, statistics array<double>"))


def train_by_id(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Model:
    """The same with labels in a table of their own. Null ids have no label; an id of
    several rows counts once for each pair of them."""
    texts = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    schema = StructType().add(texts.schema["id"])
    schema = schema.add("statistics", ArrayType(DoubleType()))
    known = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("label"))
    rows = texts.mapInArrow(_described, schema).join(known.filter("label IN (0, 1)"), "id")
    return _trained(rows.select("label", "statistics"))


def _trained(rows: DataFrame) -> Model:
    """The model from the label and the statistics of each row."""
    width = len(STATISTICS) + 1
    sums = (
        rows.mapInArrow(_moments, "label int, cell int, total double")
        .groupBy("label", "cell")
        .agg(F.sum("total").alias("total"))
        .toArrow()
    )
    totals = np.zeros((2, width * width))
    totals[sums["label"].to_numpy(), sums["cell"].to_numpy()] = sums["total"].to_numpy()
    return fit(totals.reshape(2, width, width))


def fit(totals: np.ndarray) -> Model:
    """The model from the sums of products of (1, statistics) of both classes."""
    counts = totals[:, 0, 0]
    known = np.maximum(counts, 1)[:, None]
    means = totals[:, 0, 1:] / known
    spread = totals[:, 1:, 1:] - counts[:, None, None] * np.einsum("ki,kj->kij", means, means)
    common = spread.sum(axis=0) / max(1.0, counts.sum())
    factors, logs = [], []
    for k in (0, 1):
        own = (1 - TOWARDS_COMMON) * spread[k] / known[k] + TOWARDS_COMMON * common
        level = np.diag(np.maximum(np.diag(own), FLOOR))
        own = (1 - TOWARDS_DIAGONAL) * own + TOWARDS_DIAGONAL * level + FLOOR * np.eye(len(own))
        lower = np.linalg.cholesky(own)
        factors.append(np.linalg.inv(lower))
        logs.append(np.log(np.diag(lower)).sum())
    with np.errstate(divide="ignore"):
        priors = np.log(counts / max(1.0, counts.sum()))
    return Model(means, np.array(factors), np.array(logs), priors)


def classify(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    score: str = "score",
    predicted: str = "predicted",
) -> DataFrame:
    """``docs`` with the probability of label 1 and whether it is at least one half."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_quality_text"):
                scores = shared.value.score(statistics(batch.column("_quality_text")))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:-1],
                        pa.array(scores),
                        pa.array((scores >= 0.5).astype(np.int32)),
                    ],
                    names=[*batch.schema.names[:-1], score, predicted],
                )

    # Columns that have the name of a result give way to it.
    texts = F.col(text).cast("string").alias("_quality_text")
    kept = docs.drop("_quality_text").select("*", texts).drop(*{score, predicted} - {text})
    fields = [f for f in docs.schema.fields if f.name in kept.columns]
    schema = StructType(fields).add(score, "double").add(predicted, "integer")
    return kept.mapInArrow(predict, schema)
