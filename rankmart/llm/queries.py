"""The operators over the driver tables, one query each."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmart.llm import (
    ann,
    decontaminate,
    hard_negatives,
    language_id,
    license_scan,
    mixing,
    near_dedup,
    packing,
    periodic_runs,
    quality,
    sharding,
    substring_dedup,
    token_store,
)
from rankmart.llm.common import scratch
from rankmart.llm.oracle import ORACLE as ORACLE
from rankmart.session import scratch_path

END_OF_TEXT = 2
END_OF_PIECE = 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file, the same on every machine."""
    import public_tokenizers

    return str(Path(public_tokenizers.path(name)))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return decontaminate.leaks(documents, table(spark, sf_dir, "benchmark"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.without_repeats(documents).select(
        "doc_id",
        F.col("span_words").alias("n_words"),
        F.col("span_removed").alias("n_removed"),
        F.col("span_sha256").alias("kept_sha256"),
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language_id.held_out(F.col("doc_id"), 4, 2)
    model = language_id.train(documents.filter(~held_out))
    texts = documents.select("doc_id", held_out.alias("held_out"), "text")
    return language_id.identify(texts, model).drop("text")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = language_id.held_out(F.col("doc_id"), 3, 1)
    model = quality.train_by_id(documents.filter(~held_out), labels.filter(~held_out))
    texts = documents.select("doc_id", held_out.alias("held_out"), "text")
    return quality.classify(texts, model).drop("text")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=16)
    return placed.withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-tokens")
    documents = table(spark, sf_dir, "documents")
    token_store.write_tokens(documents, path, tokenizer("byte_bpe_50k.json"), END_OF_TEXT)
    return token_store.read_tokens(spark, path)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks = F.col("vec_id") % 20 == 0
    return ann.neighbours(table(spark, sf_dir, "embeddings"), asks, k=20)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark, table(spark, sf_dir, "documents"))


def packed(spark: SparkSession, documents: DataFrame, with_ids: bool = False) -> DataFrame:
    """Packs the documents, writes the sequences and tells the pieces found in the files."""
    path = scratch_path(spark, "llm-sequences")
    model = tokenizer("word_bpe_49k.json")
    with scratch(spark):
        pieces = packing.pack_documents(documents, model, END_OF_PIECE, narrow=True)
        packing.write_sequences(pieces, path)
    return packing.read_pieces(spark, path, with_ids=with_ids)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = (F.col("label") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(documents, change=periodic_runs.planted_loop)
    return found.drop("runs", "collapsed")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.mixed(table(spark, sf_dir, "documents"))
    return drawn.select(
        "doc_id", "size", "source_size", "target", mixing.taken().alias("taken")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_decontamination,
        op3_substring_dedup,
        op4_language_id,
        op5_near_dedup,
        op6_quality,
        op7_sharding,
        op8_token_store,
        op9_neighbours,
        op10_packing,
        op11_hard_negatives,
        op12_periodic_runs,
        op13_mixing,
    )
}
