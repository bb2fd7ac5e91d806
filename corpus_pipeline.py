"""From raw documents to packed token sequences, stage by stage.

Each stage works on all rows that the one before kept, is written as Parquet and read
again. All but the last return the columns of ``documents``.

What a stage stores on its way is given back when the next one begins, as its result has been
written then.

Results for odd input: a document whose text is null, empty or without a letter is rejected
by the first stage; equal rows are near duplicates of each other; an empty table goes
through all stages and gives an empty result; extra columns are carried to the last stage.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmart.llm import (
    decontaminate,
    language_id,
    near_dedup,
    substring_dedup,
)
from rankmart.llm.common import emptied, scratch, stored
from rankmart.llm.queries import packed, table

#: A text whose likeliest language is less likely than this has no language.
LANGUAGE_SCORE = 0.5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


_STAGE = threading.local()


def _give_back(spark: SparkSession) -> None:
    """Empties what the stage before stored."""
    for path, schema in vars(_STAGE).pop("left", []):
        emptied(spark, path, schema)


def stage(run: Stage) -> Stage:
    """A stage whose stored tables last until the next stage of this thread begins."""

    @wraps(run)
    def wrapped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _give_back(spark)
        _STAGE.left = []
        with scratch(spark, keep=_STAGE.left):
            return run(spark, docs, sf_dir)

    return wrapped


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose text has a language that the labelled rows teach."""
    model = language_id.train(docs)
    names = {"language": "_language", "score": "_language_score"}
    scored = language_id.identify(docs, model, **names)
    known = (F.col("_language") != language_id.UNKNOWN) & (
        F.col("_language_score") >= LANGUAGE_SCORE
    )
    return scored.filter(known).select(*docs.columns)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class of near copies."""
    return near_dedup.one_of_each(docs)


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out of the texts; a text with nothing else goes."""
    cut = substring_dedup.without_repeats(docs)
    left = cut.filter(F.col("span_removed") < F.col("span_words"))
    text = F.coalesce("span_kept", "text")
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(
            F.col("span_kept").isNotNull(), F.length("span_kept").cast("long")
        ).otherwise(F.col("n_chars"))
    return left.withColumns(changed).select(*docs.columns)


@stage
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no passage of a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


@stage
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, with ids, from the packed sequences as written."""
    return packed(spark, docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark),
    ("packing", sequences),
]

#: Tokenizers, learned models and alignments are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stored(step(spark, docs, sf_dir), f"stage-{name}")
    return docs
