"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source is to give a share of the mixture by its weight, at most ``most`` times its words;
what is above goes to the other sources by weight until none is above (``targets``).

1. The documents of a source are dealt by a hash into blocks of about ``block_words`` words.
   A source gives as many *whole passes* over its blocks as its target holds, and the rest
   from the front of one more pass. Every pass has the blocks in another random order.
   Where the rest ends inside a block, documents there are taken in random order, the last
   of them as far as needed, so that a source gives its target to the word.
2. That makes an exact number of block draws of each source, its *quota*. The tree parts all
   quotas among the output shards: the shards of a node are halved, and the left half gets
   quotas drawn from the multivariate hypergeometric distribution, i.e. as if all draws were
   shuffled and dealt out, but without listing them. The leaves are the quotas of the shards.
3. A source's draws are numbered pass by pass, in the random order of the pass. A shard takes
   the next numbers of each source, as many as its quota: disjoint blocks. ``mix_order`` is a
   random order of the documents within a shard.

All random choices are hashes of contents or draws from generators seeded by place in the
tree, so reruns agree whatever the partitions of the table.

A hot source is many blocks. Sources may be many: the tree works on ``_FAN`` of them at a time,
groups of sources first, so that no task holds the quotas of all. Tables of a row per source
or block are ordered in parts of bounded size. Equal rows (one id, source and text) are counted before
they are shuffled and numbered after.

Results for odd input: a null source is a source, the last; a null or empty text has no words,
and a document without words is never drawn; a null id is an id; equal rows are separate
documents (which of them is drawn makes no difference); sources without words have the target
0; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankmart.llm.common import stored, text_or_empty
from rankmart.operators.slices import slice_rows, with_row_number

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SHARDS = 16
BLOCK_WORDS = 1 << 16
BLOCK_ROWS = 1 << 14
#: More draws than this make larger blocks; the generator takes up to 10^9.
MAX_DRAWS = 100_000_000
SEED = 13
_FAN = 1024
_PART = 1024
_COPIES = 4096
WORD = r"[^\x20\x09-\x0D]+"


def _random(*of: Column | str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *of)


def sized(docs: DataFrame, id: str, text: str, source: str) -> DataFrame:
    """Different documents: ``id``, ``source``, ``size``, a ``key`` of the text, ``copies``."""
    rows = docs.select(
        F.col(id).alias("id"),
        F.col(source).cast("string").alias("source"),
        F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text_or_empty(text)).alias("key"),
    )
    return rows.groupBy("id", "source", "size", "key").agg(F.count(F.lit(1)).alias("copies"))


def targets(
    sources: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """Adds ``number`` (from 0, by code point, null last), ``weight`` and ``target`` to sources
    with ``source`` and ``source_size``.

    Each round is one sum over the sources; once a source is at its most it stays there.
    """
    ordered = sources.withColumn("_null", F.col("source").isNull())
    ranked = with_row_number(slice_rows(ordered, [], ["_null", "source"]), "number").result()
    number = F.col("number") - 1
    weight = F.get(F.array(*map(F.lit, map(float, weights))), (number % len(weights)).cast("int"))
    ranked = ranked.drop("_null").withColumns({"weight": weight, "number": number})
    ranked = stored(ranked, "sources")
    cap = F.col("source_size") * F.lit(float(most))
    wanted = (ranked.agg(F.sum("source_size").alias("n")).first()["n"] or 0) * share
    level, full = 0.0, -1
    while True:
        above = cap <= F.lit(level) * F.col("weight")
        now = ranked.agg(
            F.count_if(above).alias("full"),
            F.sum(F.when(above, cap)).alias("given"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
        ).first()
        if now["full"] == full or not now["weight"]:
            break
        full = now["full"]
        level = (wanted - (now["given"] or 0.0)) / now["weight"]
    return ranked.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def split(quotas: np.ndarray, sizes: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Deals out ``quotas`` (by source) among shards of ``sizes``: a row per source."""
    if len(sizes) == 1:
        return quotas[:, None]
    half = len(sizes) // 2
    left = draw.multivariate_hypergeometric(quotas, int(sizes[:half].sum()), method="marginals")
    return np.hstack([split(left, sizes[:half], draw), split(quotas - left, sizes[half:], draw)])


def _dealing(seed: int, level: int) -> Callable[[pa.Table], pa.Table]:
    def deal(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("child")
        draw = np.random.default_rng([seed, level, rows["node"][0].as_py()])
        sizes = np.array(rows["quotas"][0].as_py(), np.int64)
        parts = split(rows["draws"].to_numpy(), sizes, draw)
        quotas = pa.array(parts.tolist(), pa.list_(pa.int64()))
        return pa.table([rows["child"], quotas], names=["node", "quotas"])

    return deal


def shard_quotas(sources: DataFrame, shards: int, seed: int = SEED, fan: int = _FAN) -> DataFrame:
    """``number`` and ``quotas`` (a number per shard) of sources with ``number`` and ``draws``.

    A node of the tree of sources is ``fan`` neighbouring nodes of the level below. What a
    node has for each shard is split among them as if they were the shards' whole content.
    """
    last, total = sources.agg(F.max("number"), F.sum("draws")).first()
    if last is None:
        return sources.select("number", F.array().cast("array<long>").alias("quotas"))
    levels = 1
    while fan**levels <= last:
        levels += 1
    sizes = [(total + shards - 1 - k) // shards for k in range(shards)]
    spark = sources.sparkSession
    held = spark.createDataFrame([(0, sizes)], "node long, quotas array<long>")
    for level in reversed(range(levels)):
        child = F.floor(F.col("number") / F.lit(fan**level)).cast("long")
        children = sources.groupBy(child.alias("child")).agg(F.sum("draws").alias("draws"))
        children = children.withColumn("node", F.floor(F.col("child") / F.lit(fan)).cast("long"))

        held = (
            children.join(held, "node")
            .groupBy("node")
            .applyInArrow(_dealing(seed, level), "node long, quotas array<long>")
        )
    return held.withColumnRenamed("node", "number")


def _ordered(blocks: DataFrame) -> DataFrame:
    """Adds ``place`` from 0 and the ``words`` before, in the random order of each pass.

    Blocks are dealt by their hash into parts of about ``_PART``, ordered there, and moved by
    the sums of the parts before.
    """
    parts = F.ceil(F.col("blocks") / F.lit(_PART))
    # The upper bits of the hash, scaled; parts are in the order of the hash.
    upper = F.shiftrightunsigned("turn", 33)
    rows = blocks.withColumn("part", F.floor(upper * parts / F.lit(float(1 << 31))).cast("long"))
    by = ["number", "pass", "part"]
    sums = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.sum("words").alias("_w"))
    earlier = W.partitionBy("number", "pass").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    moved = sums.select(
        *by,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_w0"),
    )
    inside = W.partitionBy(*by).orderBy(F.shiftrightunsigned("turn", 1), "turn", "block")
    placed = rows.withColumns(
        {
            "place": F.row_number().over(inside) - 1,
            "before": F.sum("words").over(inside.rowsBetween(W.unboundedPreceding, 0))
            - F.col("words"),
        }
    )
    return placed.join(moved, by).withColumns(
        {"place": F.col("place") + F.col("_n0"), "before": F.col("before") + F.col("_w0")}
    ).drop("_n0", "_w0", "part")


def _numbered_copies(rows: DataFrame) -> DataFrame:
    """One row per document: ``copy`` tells equal ones apart."""
    few = rows.filter(F.col("copies") <= _COPIES).withColumn("_first", F.lit(0).cast("long"))
    many = rows.filter(F.col("copies") > _COPIES)
    starts = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(_COPIES).cast("long"))
    many = many.withColumn("_first", F.explode(starts)).repartition("key", "_first")
    last = F.least(F.col("copies"), F.col("_first") + _COPIES) - 1
    return few.unionByName(many).withColumn("copy", F.explode(F.sequence("_first", last))).drop(
        "_first", "copies"
    )


def mixed(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    shards: int = SHARDS,
    block_words: int = BLOCK_WORDS,
    block_rows: int = BLOCK_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``id``, ``source``, ``size``, ``key`` (hash of the text), ``copy``,
    ``source_size``, ``target``, and its ``draws`` into the mixture.

    A draw has its ``pass``, ``shard``, ``order`` there, and the ``words`` it takes (all, or
    the first ones of the document where the source's target ends).
    """
    rows = stored(sized(docs, id, text, source), "sized")
    size = F.sum(F.col("size") * F.col("copies")).alias("source_size")
    sources = rows.groupBy("source").agg(size, F.sum("copies").alias("rows"))
    sources = targets(sources, weights, share, most)
    total = sources.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    block_words = max(block_words, -(-int(total * (most + 1)) // MAX_DRAWS))
    many = F.greatest(
        F.ceil(F.col("source_size") / block_words), F.ceil(F.col("rows") / block_rows), F.lit(1)
    )
    wanted = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0)
    sources = sources.withColumns({"blocks": many.cast("long"), "passes": whole.cast("long")})
    rest = wanted - F.col("passes") * F.col("source_size")
    sources = stored(sources.withColumn("rest", rest), "targets").drop("rows", "weight")

    told = sources.select(
        F.col("source").alias("_source"), "number", "blocks", "source_size", "target"
    )
    on = F.col("source").eqNullSafe(F.col("_source"))
    block = F.pmod(_random("id", "key", "copy", seed=seed), F.col("blocks"))
    dealt = _numbered_copies(rows).join(told, on).withColumn("block", block)
    dealt = dealt.drop("_source", "blocks")

    blocks = dealt.groupBy("number", "block").agg(F.sum("size").alias("words"))
    of = sources.select("number", "blocks", "passes", "rest")
    # An empty block has no row, so a pass may have fewer than ``blocks``.
    blocks = stored(blocks, "blocks").join(of, "number")
    drawn = blocks.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), "passes")))
    drawn = drawn.withColumn("turn", _random("number", "block", "pass", seed=seed + 1))
    drawn = _ordered(drawn)
    last = F.col("pass") == F.col("passes")
    drawn = drawn.filter(~last | (F.col("before") < F.col("rest")))
    # How many words of the block are taken, from its front.
    cut = F.when(last, F.least("words", F.col("rest") - F.col("before"))).otherwise(F.col("words"))
    drawn = stored(drawn.select("number", "block", "pass", "place", cut.alias("cut")), "draws")
    counts = drawn.groupBy("number", "pass").agg(F.count(F.lit(1)).alias("n"))
    passes = W.partitionBy("number").orderBy("pass")
    counts = counts.select(
        "number",
        "pass",
        "n",
        (F.sum("n").over(passes) - F.col("n")).alias("first"),
    )
    counts = stored(counts, "passes")
    quotas = shard_quotas(
        counts.groupBy("number").agg(F.sum("n").alias("draws")), shards, seed
    )
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda k: F.aggregate(F.slice("quotas", 1, k), F.lit(0).cast("long"), lambda a, x: a + x),
    )
    starts = counts.drop("n").join(quotas.select("number", ends.alias("ends")), "number")
    turn = F.col("first") + F.col("place")
    shard = F.size(F.filter("ends", lambda end: end <= turn))
    dealt_out = drawn.join(starts, ["number", "pass"]).select(
        "number", "block", F.struct("pass", shard.alias("shard"), "cut").alias("draw")
    )
    # At most one draw for each pass.
    draws = F.array_sort(F.collect_list("draw")).alias("drawn")
    by_block = dealt_out.groupBy("number", "block").agg(draws)

    mixed_order = W.partitionBy("number", "block").orderBy(
        _random("id", "key", "copy", seed=seed + 2), "key", "copy", "size"
    )
    before = F.sum("size").over(mixed_order.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    # Blocks without a draw are kept: a document not drawn has a row.
    found = dealt.withColumn("before", before).join(by_block, ["number", "block"], "left")

    def draw(one: Column) -> Column:
        words = F.greatest(F.lit(0), F.least(F.col("size"), one["cut"] - F.col("before")))
        order = F.xxhash64(F.lit(seed + 3), one["pass"], F.col("id"), F.col("key"), F.col("copy"))
        return F.struct(
            one["pass"].cast("int").alias("pass"),
            one["shard"].alias("shard"),
            order.alias("order"),
            words.alias("words"),
        )

    none = F.array().cast(
        "array<struct<pass: int, shard: int, order: long, words: long>>"
    )
    draws = F.filter(
        F.coalesce(F.transform("drawn", draw), none), lambda one: one["words"] > 0
    )
    return found.withColumn("draws", draws).select(
        F.col("id").alias(id),
        F.col("source").alias(source),
        "size",
        "key",
        "copy",
        "source_size",
        "target",
        "draws",
    )


def taken() -> Column:
    """The words that the mixture takes of a row of :func:`mixed`."""
    return F.aggregate("draws", F.lit(0).cast("long"), lambda total, one: total + one["words"])


def mixture(
    mixed: DataFrame, docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The mixture itself: a row per draw, with the text (its first words where cut).

    ``mix_shard`` and ``mix_order`` say where it stands; rows of one shard are to be read in
    ascending ``mix_order``. A cut text has its words joined by one space.
    """
    drawn = mixed.select(
        F.col(id).alias("_id"),
        F.col(source).alias("_source"),
        F.col("key").alias("_key"),
        "size",
        F.inline("draws"),
    )
    texts = docs.select(
        id, F.col(source).cast("string").alias(source), text_or_empty(text).alias(text)
    )
    texts = texts.withColumn("_text_key", F.xxhash64(text)).dropDuplicates([id, source, "_text_key"])
    same = F.col("_key") == F.col("_text_key")
    same &= F.col("_id").eqNullSafe(F.col(id)) & F.col("_source").eqNullSafe(F.col(source))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    first = F.array_join(F.slice(words, 1, F.col("words").cast("int")), " ")
    return drawn.join(texts, same).select(
        F.col("shard").alias("mix_shard"),
        F.col("order").alias("mix_order"),
        F.col("pass").alias("mix_pass"),
        id,
        source,
        "words",
        F.when(F.col("words") < F.col("size"), first).otherwise(F.col(text)).alias(text),
    )


def write_mixture(rows: DataFrame, path: str, parts: int = 8) -> None:
    """Writes rows of :func:`mixture` as one folder per shard, each file in random order.

    A shard is cut into ``parts`` by ``mix_order``, so that no task holds a whole shard.
    """
    part = F.floor(F.shiftrightunsigned("mix_order", 33) * parts / F.lit(float(1 << 31)))
    (
        rows.withColumn("_part", part)
        .repartition("mix_shard", "_part")
        .sortWithinPartitions("mix_shard", "_part", "mix_order")
        .drop("_part")
        .write.mode("overwrite")
        .partitionBy("mix_shard")
        .parquet(path)
    )
