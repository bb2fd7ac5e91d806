"""What is versioned in each domain."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from rankmart.operators.scd2 import scd2_apply
from rankmart.sources.domain import TABLES
from rankmart.sources.history import History


@dataclass(frozen=True)
class Domain:
    """Business key and tracked attributes of a silver table."""

    name: str
    keys: tuple[str, ...]
    tracked: tuple[str, ...]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(TABLES[f"silver.{self.name}"][0])

    def apply(
        self,
        state: DataFrame,
        updates: DataFrame,
        as_of: datetime | Column,
        close_missing: bool = False,
    ) -> DataFrame:
        return scd2_apply(state, updates, self.keys, self.tracked, as_of, close_missing)

    def history(self, spark: SparkSession, root: str) -> History:
        return History(spark, root, self.schema, self.keys, self.tracked)


# The tracked columns and their order decide the change hash.
VOCATION = Domain("vocation", ("name", "world"), ("vocation", "level", "experience", "world_type"))
SKILLS = Domain("skills", ("name", "world", "category"), ("vocation", "skill_level"))
EXTRA = Domain("extra", ("name", "world", "category", "title"), ("vocation", "points"))
DOMAINS = {d.name: d for d in (VOCATION, SKILLS, EXTRA)}
