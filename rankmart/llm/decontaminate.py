"""Benchmark decontamination by spaced-seed hashing.

A seed is a mask over consecutive words that looks at six of them and ignores the rest, so
that a passage still hits when a word under an ignored place was exchanged. The three masks
below are chosen so that *any* 13 words of which at most two were exchanged share at least
one seed (all 78 pairs of places were tried). Seeds of the benchmark are joined to the
seeds of the documents; each hit fixes an alignment, and the aligned words are compared:

* items of at least 13 words leak where 11 of 13 aligned words are equal;
* items of 6 to 12 words leak where they stand whole and unchanged;
* shorter items are no evidence.

So the result is that of comparing every window with every item, without doing so.

Everything is DataFrame functions. The bytes of the benchmark's seeds are added up first: up
to ``MAX_BROADCAST`` they are broadcast, beyond that both sides are shuffled by seed. A seed
then travels without its text; the texts of documents with hits are fetched afterwards.

Results for odd input: null or empty texts, on either side, leak nothing; a null ``doc_id``
or ``item_id`` is kept as such; equal rows give one result row; empty tables give an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmart.llm.common import ascii_words, stored, text_key, text_or_empty

#: Each mask is three pairs of neighbouring words, by the offset of the pair.
MASKS = [(0, 2, 4), (0, 2, 5), (0, 3, 8)]
WINDOW = 13
EQUAL = 11
#: Bytes of the benchmark's seeds that are broadcast at most.
MAX_BROADCAST = 64 << 20
#: Five numbers and what a row costs besides; the item's id comes on top.
SEED_BYTES = 64


def _span(mask: tuple[int, ...]) -> int:
    return mask[-1] + 2


def _seeds(pairs: Column, size: Column, number: int) -> Column:
    """Hashes of one mask at every word where it fits."""
    _, second, third = MASKS[number]
    every = F.transform(
        pairs,
        lambda pair, i: F.xxhash64(
            F.lit(number), pair, F.get(pairs, i + second), F.get(pairs, i + third)
        ),
    )
    return F.slice(every, 1, F.greatest(size - _span(MASKS[number]) + 1, F.lit(0)))


def _with_seeds(df: DataFrame) -> DataFrame:
    """One row for each seed of ``words``: its hash and its place in the list of all seeds."""
    words = F.col("words")
    pairs = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1)))
    # The outer form keeps Spark from filtering on the size of the list, for which it would
    # compute the list once more below, with all its parts in one expression.
    paired = df.withColumn("pairs", pairs).withColumn("n_words", F.size("words"))
    seeds = F.concat(
        *[_seeds(F.col("pairs"), F.col("n_words"), m) for m in range(len(MASKS))]
    )
    return paired.withColumn("seeds", seeds).select(
        *df.columns, "n_words", F.posexplode_outer("seeds").alias("place", "seed")
    )


def _word_of(place: str, size: str, mask: Column) -> Column:
    """Where a seed starts: its place in the list less the seeds of the masks before."""
    counts = [F.greatest(F.col(size) - _span(m) + 1, F.lit(0)) for m in MASKS]
    start = F.when(mask == 0, F.lit(0)).when(mask == 1, counts[0])
    return F.col(place) - start.otherwise(counts[0] + counts[1])


def _mask_of(place: str, size: str) -> Column:
    counts = [F.greatest(F.col(size) - _span(m) + 1, F.lit(0)) for m in MASKS]
    first, second = counts[0], counts[0] + counts[1]
    return F.when(F.col(place) < first, 0).when(F.col(place) < second, 1).otherwise(2)


def test_seeds(items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """Seeds of the benchmark: ``seed``, ``item``, ``mask``, ``item_word``, ``item_size``."""
    worded = items.select(
        F.col(id).alias("item"),
        text_key(text).alias("item_key"),
        ascii_words(text_or_empty(text)).alias("words"),
    ).distinct()
    each = _with_seeds(worded).withColumn("mask", _mask_of("place", "n_words"))
    return each.select(
        "seed",
        "item",
        "item_key",
        "mask",
        _word_of("place", "n_words", F.col("mask")).alias("item_word"),
        F.col("n_words").alias("item_size"),
    )


def _held_bytes(seeds: DataFrame) -> int:
    """What the seeds take in memory, by the length of their ids."""
    id_bytes = F.coalesce(F.octet_length(F.col("item").cast("string")), F.lit(0))
    return seeds.agg(F.sum(id_bytes + SEED_BYTES)).first()[0] or 0


def _hits(worded: DataFrame, seeds: DataFrame, max_broadcast: int) -> DataFrame:
    """``doc``, ``key``, ``words``, ``n_words``, the item and the diagonal of each hit."""
    diagonal = _word_of("place", "n_words", F.col("mask")) - F.col("item_word")
    place = ["doc", "key", "n_words", "item", "item_key", "item_size", "diagonal"]
    if _held_bytes(seeds) <= max_broadcast:
        hits = _with_seeds(worded).join(F.broadcast(seeds), "seed")
        return hits.withColumn("diagonal", diagonal).select(*place, "words")
    hits = _with_seeds(worded).drop("words").join(seeds, "seed")
    places = hits.withColumn("diagonal", diagonal).select(*place).distinct()
    texts = worded.select(F.col("doc").alias("_doc"), F.col("key").alias("_key"), "words")
    same = (F.col("key") == F.col("_key")) & F.col("doc").eqNullSafe(F.col("_doc"))
    return places.join(texts, same).select(*place, "words")


def _passages(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """The rows of ``leaks`` by ``doc``, ``key`` (of its text), ``item`` and ``item_key``."""
    seeds = stored(test_seeds(items, item_id, item_text), "test-seeds")
    worded = docs.select(
        F.col(id).alias("doc"),
        text_key(text).alias("key"),
        ascii_words(text_or_empty(text)).alias("words"),
    )
    hits = _hits(worded, seeds, max_broadcast)
    begin = F.greatest(F.col("diagonal"), F.lit(0))
    end = F.least(F.col("n_words"), F.col("diagonal") + F.col("item_size"))
    # A hit takes along the document's words that lie against the item, and no others.
    aligned = (
        hits.select(
            "doc",
            "key",
            "item",
            "item_key",
            "diagonal",
            F.slice("words", begin + 1, F.greatest(end - begin, F.lit(0))).alias("doc_words"),
        )
        .groupBy("doc", "key", "item", "item_key", "diagonal")
        .agg(F.first("doc_words").alias("doc_words"))
    )
    texts = items.select(
        F.col(item_id).alias("_item"),
        text_key(item_text).alias("_item_key"),
        ascii_words(text_or_empty(item_text)).alias("item_words"),
    ).distinct()
    same_item = F.col("item").eqNullSafe(F.col("_item")) & (
        F.col("item_key") == F.col("_item_key")
    )
    compared = aligned.join(texts, same_item).withColumn(
        "equal",
        F.zip_with(
            "doc_words",
            F.slice(
                "item_words", F.greatest(-F.col("diagonal"), F.lit(0)) + 1, F.size("doc_words")
            ),
            lambda a, b: (a == b).cast("int"),
        ),
    )
    size = F.size("item_words")
    window = F.least(size, F.lit(WINDOW))
    needed = F.when(size < WINDOW, size).otherwise(EQUAL)
    starts = F.when(
        F.size("equal") >= window, F.sequence(F.lit(0), F.size("equal") - window)
    ).otherwise(F.array().cast("array<int>"))
    passing = F.filter(
        starts,
        lambda s: F.aggregate(
            F.slice(F.col("equal"), s + 1, window), F.lit(0), lambda n, x: n + x
        )
        >= needed,
    )
    begin = F.greatest(F.col("diagonal"), F.lit(0))
    return (
        compared.withColumn("passing", passing)
        .filter(F.size("passing") > 0)
        .withColumn("equal_here", F.aggregate("equal", F.lit(0), lambda n, x: n + x))
        .groupBy("doc", "item", "key", "item_key")
        .agg(
            F.min(begin + F.array_min("passing")).cast("long").alias("first_word"),
            F.max(begin + F.array_max("passing") + window - 1).cast("long").alias("last_word"),
            F.max("equal_here").cast("long").alias("equal_words"),
            F.max(F.col("equal_here") / size).alias("overlap"),
        )
    )


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """One row for each document and benchmark item of which it holds a passage.

    ``first_word`` and ``last_word`` bound the passage in the document's words,
    ``equal_words`` is the number of the item's words found there on one alignment and
    ``overlap`` its share of the item.
    """
    found = _passages(docs, items, id, text, item_id, item_text, max_broadcast)
    return found.select(
        F.col("doc").alias(id),
        F.col("item").alias(item_id),
        "first_word",
        "last_word",
        "equal_words",
        "overlap",
    )


def without_leaks(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **columns: str
) -> DataFrame:
    """The documents that hold no benchmark passage, with all their columns.

    Rows are told apart by id and text, so that another text with the id of a leaking one,
    or a null id, stays. A null ``doc_id`` is compared as a value.
    """
    found = _passages(docs, items, id, text, **columns)
    found = found.select(F.col("doc").alias("_leak"), F.col("key").alias("_leak_key")).distinct()
    same = (text_key(text) == F.col("_leak_key")) & F.col(id).eqNullSafe(F.col("_leak"))
    return docs.join(found, same, "left_anti")
