"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmart.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, its component's smallest node, for all nodes but the roots.

    Large-star and small-star steps in turn: each node hangs its larger neighbours, then
    its smaller ones, below the smallest node it knows. Every round works on the edges by
    plain aggregates and joins and is stored; the number of rounds grows with the
    logarithm of the graph's size. Loops and repeated edges do no harm.
    """
    high, low = F.greatest(a, b).alias("node"), F.least(a, b).alias("root")
    links = stored(edges.filter(F.col(a) != F.col(b)).select(high, low).distinct(), "edges")
    before = _shape(links)
    while True:
        links = stored(_small_star(_large_star(links)), "stars")
        now = _shape(links)
        if now == before:
            return links
        before = now


def _shape(links: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(
        links.agg(
            F.count(F.lit(1)),
            F.bit_xor(F.xxhash64("node", "root")),
            F.sum(F.shiftright(F.xxhash64("root", "node"), 24)),
        ).first()
    )


def _large_star(links: DataFrame) -> DataFrame:
    ways = links.union(links.select("root", "node"))
    least = ways.groupBy("node").agg(F.least("node", F.min("root")).alias("least"))
    return (
        ways.join(least, "node")
        .filter(F.col("root") > F.col("node"))
        .select(F.col("root").alias("node"), F.col("least").alias("root"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("node").agg(F.min("root").alias("least"))
    moved = (
        links.join(least, "node")
        .filter(F.col("root") != F.col("least"))
        .select(F.col("root").alias("node"), F.col("least").alias("root"))
    )
    return moved.union(least.select("node", F.col("least").alias("root"))).distinct()
