"""Rules on rows, all judged in one pass that also parts good rows from bad ones.

A rule is a name and a condition that a good row meets, a column or SQL; a condition that is
null is not met.
Every row gets the names of the rules it breaks, in the order of the rules. A required column
that is not there is a rule that every row breaks, so such a load is reported with its rows
instead of raising.

An empty load breaks nothing, writes no file and is reported with zero rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

BROKEN, GOOD = "broken", "good"

Rules = Mapping[str, Column | str]


def required(df: DataFrame, columns: Iterable[str]) -> dict[str, Column]:
    """A rule for each column: it is there and not null."""
    here = set(df.columns)
    return {
        f"{c} given": F.col(c).isNotNull() if c in here else F.lit(False) for c in columns
    }


def judged(df: DataFrame, rules: Rules, name: str = BROKEN) -> DataFrame:
    """``df`` with the names of the rules that each row breaks."""
    conditions = [(r, F.expr(met) if isinstance(met, str) else met) for r, met in rules.items()]
    names = [F.when(~F.coalesce(met, F.lit(False)), F.lit(rule)) for rule, met in conditions]
    none = F.array().cast("array<string>")
    return df.withColumn(name, F.array_compact(F.array(*names)) if names else none)


@dataclass(frozen=True)
class Gate:
    """What a load came to: both tables, the number of its rows and of those breaking a rule."""

    good: DataFrame
    quarantined: DataFrame
    rows: int
    good_rows: int
    broken: dict[str, int]

    @property
    def quarantined_rows(self) -> int:
        return self.rows - self.good_rows


def gate(df: DataFrame, rules: Rules, path: str) -> Gate:
    """Write good and bad rows below ``path``, which is new, and tell how many there are.

    One pass over ``df`` and no shuffle: each task writes its rows to the two parts, and the
    counts are gathered on the way. Quarantined rows carry ``BROKEN``.
    """
    clash = {BROKEN, GOOD} & set(df.columns)
    if clash:
        raise ValueError(f"columns of the gate's own: {', '.join(sorted(clash))}")
    counted = Observation()
    marked = judged(df, rules).withColumn(GOOD, F.size(BROKEN) == 0)
    counts = [
        F.count_if(F.array_contains(BROKEN, rule)).alias(f"rule {i}")
        for i, rule in enumerate(rules)
    ]
    watched = marked.observe(
        counted, F.count(F.lit(1)).alias("rows"), F.count_if(GOOD).alias("good"), *counts
    )
    watched.write.partitionBy(GOOD).parquet(path)
    found = counted.get
    both = df.sparkSession.read.schema(marked.schema).parquet(path)
    return Gate(
        both.filter(GOOD).drop(GOOD, BROKEN),
        both.filter(f"NOT {GOOD}").drop(GOOD),
        found["rows"],
        found["good"],
        {rule: found[f"rule {i}"] for i, rule in enumerate(rules)},
    )
