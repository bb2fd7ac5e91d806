"""Refresh the gold tables from the versioned state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from rankmart.plans import gold
from rankmart.plans.silver import SKILLS, VOCATION
from rankmart.sources.history import History
from rankmart.sources.progressions import END, Progressions
from rankmart.sources.tables import (
    SHORT_ROW_GROUP_BYTES,
    overwrite_partitions,
    replace_table,
)


def refresh_marts(
    vocation: DataFrame,
    skills: DataFrame,
    as_of: datetime | Column,
    location: str,
    database: str = "gold",
) -> dict[str, str]:
    """Write all five marts and return their tables. A failure raises.

    The two rankings replace the snapshot of ``as_of``'s day and keep other days; their
    tables exist already. They lie by rank, so that a read of the first ranks passes over the rest. The other marts are replaced, below ``location``.
    """
    names = {}
    for mart, rows, order in (
        ("experience_global_rank", gold.experience_global_rank(vocation, as_of), ["rank"]),
        ("skills_global_rank", gold.skills_global_rank(skills, as_of), ["skill_name", "rank"]),
    ):
        names[mart] = f"{database}.{mart}"
        overwrite_partitions(rows, names[mart], order, SHORT_ROW_GROUP_BYTES)
    for mart, rows in (
        ("world_summary", gold.world_summary(vocation, as_of)),
        ("player_progression", gold.player_progression(vocation, as_of)),
        ("skills_progression", gold.skills_progression(skills, as_of)),
    ):
        names[mart] = f"{database}.{mart}"
        replace_table(rows, names[mart], f"{location}/{mart}")
    return names


class PlayerProgressions(Progressions):
    """The player progression, kept up to date from the stored history."""

    def __init__(self, spark: SparkSession, root: str):
        versions = gold.player_versions(spark.createDataFrame([], VOCATION.schema), END)
        order = ["current_start_date", "world"]
        super().__init__(spark, root, versions.schema, ["name"], order, gold.PLAYER_BEFORE)

    def refresh(self, vocation: History, since: datetime) -> None:
        """Take in the loads of ``since`` and later."""
        self.load(gold.player_versions(vocation.since(since), END), since)

    def mart(self, as_of: datetime | Column) -> DataFrame:
        return gold.player_gains(self.pairs(), as_of)


class SkillProgressions(Progressions):
    """The skill progression, kept up to date from the stored history."""

    def __init__(self, spark: SparkSession, root: str):
        versions = gold.skill_versions(spark.createDataFrame([], SKILLS.schema), END)
        keys, order = ["name", "category"], ["to_date", "world"]
        super().__init__(spark, root, versions.schema, keys, order, gold.SKILL_BEFORE)

    def refresh(self, skills: History, since: datetime) -> None:
        """Take in the loads of ``since`` and later."""
        self.load(gold.skill_versions(skills.since(since), END), since)

    def mart(self, as_of: datetime | Column) -> DataFrame:
        return gold.skill_gains(self.pairs(), as_of)
