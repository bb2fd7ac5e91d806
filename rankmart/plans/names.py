"""Name search from stored postings instead of reading every row.

    <root>/part=<n>/...     gram, name

A gram is one, two or three letters in a row, in lower case; a posting is a gram and a name it
occurs in. A name that contains a text contains all its grams, so the names are looked for among
the postings of *one* of them, the rarest, and each is then tested against the whole text. That
reads one partition of ``PARTS`` and, as the grams lie sorted in a file, few of its row groups;
nothing is shuffled. A text of up to three letters is a gram itself.

Names are added as they appear and are never written again; a name stands as the posting of the
empty gram as well, which is the list of all names. One load at a time may write. A load that
died is run again: a name that was then written twice is found once.

The rows found are those of the literal search that ignores case: a null name is never found, an
empty text finds all names, signs such as ``%`` or ``.`` stand for themselves. No names
give no postings, and nothing is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankmart.plans.views import search
from rankmart.sources.tables import COMPRESSION, SHORT_ROW_GROUP_BYTES, table_at

GRAM, NAME, PART = "gram", "name", "part"
LONGEST = 3
PARTS = 64


def grams(text: Column) -> Column:
    """The different grams of a text."""

    def every(size: int) -> Column:
        count = F.length(text) - (size - 1)
        starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(starts, lambda at: text.substr(at, F.lit(size)))

    return F.array_distinct(F.concat(*[every(size) for size in range(1, LONGEST + 1)]))


def part_of(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(PARTS)).cast("int")


class NameIndex:
    """Postings below ``root``."""

    schema = StructType().add(GRAM, "string").add(NAME, "string").add(PART, "integer")

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.table = table_at(spark, root, self.schema, [PART])

    def postings(self) -> DataFrame:
        return self.spark.table(self.table)

    def _of(self, *wanted: str) -> DataFrame:
        """The postings of some grams, from their partitions alone."""
        parts = [part_of(F.lit(gram)) for gram in wanted]
        return self.postings().filter(F.col(PART).isin(*parts) & F.col(GRAM).isin(*wanted))

    def names(self) -> DataFrame:
        return self._of("").select(NAME).distinct()

    def add(self, rows: DataFrame, name: str = NAME) -> None:
        """Add the names in ``rows`` that are not known yet."""
        seen = rows.filter(F.col(name).isNotNull()).select(F.col(name).alias(NAME)).distinct()
        fresh = seen.join(self.names(), NAME, "left_anti")
        every = F.concat(F.array(F.lit("")), grams(F.lower(NAME)))
        posted = fresh.select(F.explode(every).alias(GRAM), NAME)
        # A frequent gram may make a large partition, which is written by several tasks.
        sized = posted.withColumn(PART, part_of(F.col(GRAM))).hint("rebalance", PART)
        (
            sized.sortWithinPartitions(PART, GRAM, NAME)
            .write.option("compression", COMPRESSION)
            .option("parquet.block.size", SHORT_ROW_GROUP_BYTES)
            .insertInto(self.table)
        )

    def _rarest(self, text: str) -> str:
        """The gram of ``text`` with the fewest postings: one row a gram comes back."""
        if len(text) <= LONGEST:
            return text
        wanted = sorted({text[at : at + LONGEST] for at in range(len(text) - LONGEST + 1)})
        found = self._of(*wanted).groupBy(GRAM).count().collect()
        counts = {row[GRAM]: row["count"] for row in found}
        return min(wanted, key=lambda gram: counts.get(gram, 0))

    def find(self, text: str) -> DataFrame:
        """The names that contain ``text``, upper or lower case, each once."""
        gram = self._rarest(text.strip().lower())
        return self._of(gram).filter(search(NAME, text)).select(NAME).distinct()

    def rows(self, df: DataFrame, text: str, name: str = NAME) -> DataFrame:
        """The rows of ``df`` whose name contains ``text``."""
        found = self.find(text).withColumnRenamed(NAME, "_found")
        return df.join(found, F.col(name) == F.col("_found"), "left_semi")
