"""The marts derived from the versioned state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmart.operators.rank import global_rank, group_rank
from rankmart.operators.slices import ROWS_PER_SLICE, slice_rows, with_previous


def _as_of(t: datetime | Column) -> Column:
    return t if isinstance(t, Column) else F.lit(t)


def experience_global_rank(
    vocation: DataFrame, as_of: datetime | Column, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """All current players by level, experience and name; a daily snapshot."""
    current = vocation.filter("is_current").select(
        "name", "world", "vocation", "level", "experience", "world_type"
    )
    ranked = global_rank(
        current, ["-level", "-experience", "name", "world"], rows_per_slice=rows_per_slice
    )
    return ranked.select(
        "rank",
        *current.columns,
        _as_of(as_of).alias("updated_at"),
        F.to_date(_as_of(as_of)).alias("snapshot_date"),
    )


def skills_global_rank(
    skills: DataFrame, as_of: datetime | Column, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Current players of each category by skill level and name; a daily snapshot."""
    current = skills.filter("is_current").select(
        "name", "world", F.col("category").alias("skill_name"), "vocation", "skill_level"
    )
    ranked = group_rank(
        current,
        ["skill_name"],
        ["-skill_level", "name", "world"],
        rows_per_slice=rows_per_slice,
    )
    return ranked.select(
        "rank",
        *current.columns,
        _as_of(as_of).alias("updated_at"),
        F.to_date(_as_of(as_of)).alias("snapshot_date"),
    )


def world_summary(vocation: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Distinct current players by world, world type and vocation."""
    return (
        vocation.filter("is_current")
        .groupBy("world", "world_type", "vocation")
        .agg(F.count_distinct("name").alias("players_count"))
        .withColumn("updated_at", _as_of(as_of))
    )


def per_day(gain: Column, days: Column, same_day: str) -> Column:
    """Gain per day, two decimals. Two versions on one day count as ``"one_day"``
    or have a ``"null"`` rate."""
    if same_day == "one_day":
        divisor = F.greatest(days, F.lit(1))
    elif same_day == "null":
        divisor = F.nullif(days, F.lit(0))
    else:
        raise ValueError(f"unknown same_day: {same_day}")
    return F.round(gain / divisor, 2)


#: What a progression takes over from the version before.
PLAYER_BEFORE = {
    "previous_level": "current_level",
    "previous_experience": "current_experience",
    "previous_start_date": "current_start_date",
}
SKILL_BEFORE = {"skill_before": "skill_after", "from_date": "to_date"}


def player_versions(vocation: DataFrame, *others: str) -> DataFrame:
    """The columns of a version that the player progression compares."""
    return vocation.select(
        "name",
        "world",
        "vocation",
        "world_type",
        F.col("level").cast("int").alias("current_level"),
        F.col("experience").cast("bigint").alias("current_experience"),
        F.col("start_date").alias("current_start_date"),
        "is_current",
        *others,
    )


def skill_versions(skills: DataFrame, *others: str) -> DataFrame:
    """The columns of a version that the skill progression compares."""
    return skills.select(
        "name",
        "world",
        "vocation",
        "category",
        F.col("skill_level").cast("int").alias("skill_after"),
        F.col("start_date").alias("to_date"),
        "is_current",
        *others,
    )


def player_progression(
    vocation: DataFrame,
    as_of: datetime | Column,
    same_day: str = "one_day",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Level and experience gained between consecutive versions of a name.

    A name is followed across worlds. First versions, and those after a version
    without a level, have no predecessor and are left out.
    """
    versions = player_versions(vocation)
    sliced = slice_rows(versions, ["name"], ["current_start_date", "world"], rows_per_slice)
    return player_gains(with_previous(sliced, PLAYER_BEFORE).result(), as_of, same_day)


def player_gains(
    pairs: DataFrame, as_of: datetime | Column, same_day: str = "one_day"
) -> DataFrame:
    """The progression from versions beside the values of their predecessors."""
    gain = F.col("current_experience") - F.col("previous_experience")
    days = F.date_diff(F.to_date("current_start_date"), F.to_date("previous_start_date"))
    return pairs.filter("previous_level IS NOT NULL").select(
        "name",
        "world",
        "vocation",
        "world_type",
        "previous_level",
        "current_level",
        (F.col("current_level") - F.col("previous_level")).alias("level_gain"),
        "previous_experience",
        "current_experience",
        gain.alias("experience_gain"),
        "previous_start_date",
        "current_start_date",
        days.alias("days_between_updates"),
        per_day(gain, days, same_day).alias("avg_xp_per_day"),
        "is_current",
        _as_of(as_of).alias("updated_at"),
    )


def skills_progression(
    skills: DataFrame,
    as_of: datetime | Column,
    same_day: str = "null",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Skill gained between consecutive versions of a name in a category."""
    versions = skill_versions(skills)
    sliced = slice_rows(versions, ["name", "category"], ["to_date", "world"], rows_per_slice)
    return skill_gains(with_previous(sliced, SKILL_BEFORE).result(), as_of, same_day)


def skill_gains(
    pairs: DataFrame, as_of: datetime | Column, same_day: str = "null"
) -> DataFrame:
    """The progression from versions beside the values of their predecessors."""
    gain = F.col("skill_after") - F.col("skill_before")
    days = F.date_diff(F.to_date("to_date"), F.to_date("from_date"))
    return pairs.filter("skill_before IS NOT NULL").select(
        "name",
        "world",
        "vocation",
        "category",
        "skill_before",
        "skill_after",
        gain.alias("skill_gain"),
        "from_date",
        "to_date",
        days.alias("days_between_updates"),
        per_day(gain, days, same_day).alias("avg_skill_per_day"),
        "is_current",
        _as_of(as_of).alias("updated_at"),
    )
