"""Reads, filters and key figures on the marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmart.functions.text import show_amount, show_timestamp, title_case

EXPERIENCE_RANK = [
    "rank",
    "name",
    "world",
    "vocation",
    "level",
    "experience",
    "world_type",
    "updated_at",
    "snapshot_date",
]
SKILLS_RANK = [
    "rank",
    "name",
    "world",
    "skill_name",
    "vocation",
    "skill_level",
    "updated_at",
    "snapshot_date",
]
WORLD_SUMMARY = ["world", "world_type", "vocation", "players_count", "updated_at"]
PLAYER_PROGRESSION = [
    "name",
    "world",
    "vocation",
    "world_type",
    "previous_level",
    "current_level",
    "level_gain",
    "previous_experience",
    "current_experience",
    "experience_gain",
    "previous_start_date",
    "current_start_date",
    "days_between_updates",
    "avg_xp_per_day",
    "is_current",
]
SKILLS_PROGRESSION = [
    "name",
    "world",
    "vocation",
    "category",
    "skill_before",
    "skill_after",
    "skill_gain",
    "from_date",
    "to_date",
    "days_between_updates",
    "avg_skill_per_day",
    "is_current",
]


SKILLS_DISPLAY = ["rank", "name", "world", "vocation", "skill_level", "updated_at"]
PLAYER_HISTORY = [
    "previous_level",
    "current_level",
    "level_gain",
    "experience_gain",
    "avg_xp_per_day",
    "days_between_updates",
    "previous_start_date",
    "current_start_date",
]
SKILL_HISTORY = [
    "category",
    "skill_before",
    "skill_after",
    "skill_gain",
    "days_between_updates",
    "avg_skill_per_day",
    "from_date",
    "to_date",
]


def _snapshot(day: date | str) -> Column:
    return F.lit(str(day)[:10]).cast("date")


def experience_rank_rows(mart: DataFrame, snapshot: date | str | None = None) -> DataFrame:
    """Distinct rows of one snapshot by rank, or of all by newest snapshot and rank."""
    rows = mart.select(*EXPERIENCE_RANK)
    if snapshot is not None:
        rows = rows.filter(F.col("snapshot_date") == _snapshot(snapshot))
        return rows.distinct().orderBy("rank")
    return rows.distinct().orderBy(F.desc("snapshot_date"), "rank")


def skills_rank_rows(mart: DataFrame, snapshot: date | str | None = None) -> DataFrame:
    """Rows of one snapshot by skill and rank, or all rows."""
    rows = mart.select(*SKILLS_RANK)
    if snapshot is None:
        return rows
    chosen = rows.filter(F.col("snapshot_date") == _snapshot(snapshot))
    return chosen.orderBy("skill_name", "rank")


def read_experience_rank(
    spark: SparkSession,
    snapshot: date | str | None = None,
    table: str = "gold.experience_global_rank",
) -> DataFrame:
    return experience_rank_rows(spark.table(table), snapshot)


def read_skills_rank(
    spark: SparkSession,
    snapshot: date | str | None = None,
    table: str = "gold.skills_global_rank",
) -> DataFrame:
    return skills_rank_rows(spark.table(table), snapshot)


def read_world_summary(spark: SparkSession, table: str = "gold.world_summary") -> DataFrame:
    return spark.table(table).select(*WORLD_SUMMARY)


def read_player_progression(
    spark: SparkSession, table: str = "gold.player_progression"
) -> DataFrame:
    return spark.table(table).select(*PLAYER_PROGRESSION)


def read_skills_progression(
    spark: SparkSession, table: str = "gold.skills_progression"
) -> DataFrame:
    return spark.table(table).select(*SKILLS_PROGRESSION)


def latest_snapshot(mart: DataFrame) -> DataFrame:
    """Rows of the newest snapshot."""
    # A scalar subquery, unlike a join, prunes the partitions of a stored mart.
    return mart.filter(F.col("snapshot_date") == mart.agg(F.max("snapshot_date")).scalar())


def _one_of(column: str, values: Sequence[str]) -> Column:
    return F.lower(column).isin([v.lower() for v in values])


def search(column: str, text: str, regex: bool = False) -> Column:
    """Case-insensitive search for ``text``, literal unless ``regex``."""
    if regex:
        return F.col(column).rlike(f"(?i){text}")
    return F.lower(column).contains(text.strip().lower())


def _filtered(
    df: DataFrame,
    worlds: Sequence[str] | None,
    world_types: Sequence[str] | None,
    vocations: Sequence[str] | None,
    text: str | None,
    regex: bool,
) -> DataFrame:
    """Apply the filters that are set; None means no filter."""
    choices = {"world": worlds, "world_type": world_types, "vocation": vocations}
    for column, values in choices.items():
        if values is not None:
            df = df.filter(_one_of(column, values))
    return df.filter(search("name", text, regex)) if text else df


def ranking_view(
    mart: DataFrame,
    top: int = 100,
    snapshot: date | str | None = None,
    skill: str | None = None,
    world: str | None = None,
    world_types: Sequence[str] | None = None,
    vocations: Sequence[str] | None = None,
    text: str | None = None,
    regex: bool = False,
) -> DataFrame:
    """Ranks up to ``top`` of a snapshot (default: the newest) that pass the filters.

    The limit is on the stored rank, before the other filters.
    """
    if snapshot is None:
        rows = latest_snapshot(mart)
    else:
        rows = mart.filter(F.col("snapshot_date") == _snapshot(snapshot))
    rows = rows.filter(F.col("rank") <= top)
    if skill is not None:
        rows = rows.filter(_one_of("skill_name", [skill]))
    worlds = None if world is None else [world]
    return _filtered(rows, worlds, world_types, vocations, text, regex).orderBy("rank")


def ranking_kpis(view: DataFrame, value: str = "level") -> DataFrame:
    """One row: players, highest and lowest ``value``, worlds, last update, and the
    highest experience where the view has one."""
    figures = [
        F.count(F.lit(1)).alias("players"),
        F.max(value).alias(f"max_{value}"),
        F.min(value).alias(f"min_{value}"),
        F.count_distinct("world").alias("worlds"),
        F.max("updated_at").alias("last_update"),
    ]
    if "experience" in view.columns:
        figures.append(F.max("experience").alias("max_experience"))
    return view.agg(*figures)


def ranking_display(view: DataFrame) -> DataFrame:
    """A ranking view as text for people, in rank order."""
    titled = [c for c in ("world", "vocation", "world_type", "skill_name") if c in view.columns]
    shown = view.withColumns({c: title_case(c) for c in titled})
    shown = shown.withColumn("updated_at", show_timestamp("updated_at"))
    if "skill_name" in view.columns:
        return shown.select(*SKILLS_DISPLAY).orderBy("rank")
    shown = shown.withColumn("experience", show_amount("experience"))
    return shown.drop("snapshot_date").orderBy("rank")


def filter_options(mart: DataFrame, column: str, newest_first: bool = False) -> DataFrame:
    """The distinct values of a column in order, without NULL."""
    values = mart.select(column).filter(F.col(column).isNotNull()).distinct()
    return values.orderBy(F.col(column).desc() if newest_first else F.col(column).asc())


def summary_view(
    summary: DataFrame,
    worlds: Sequence[str] | None = None,
    world_types: Sequence[str] | None = None,
    vocations: Sequence[str] | None = None,
) -> DataFrame:
    """The detailed population table, largest groups first."""
    rows = _filtered(summary, worlds, world_types, vocations, None, False)
    return rows.orderBy(F.desc("players_count"), "world", "world_type", "vocation")


def summary_display(view: DataFrame) -> DataFrame:
    """A summary view as text for people, largest groups first."""
    titled = {c: title_case(c) for c in ("world", "world_type", "vocation")}
    shown = view.withColumns({**titled, "updated_at": show_timestamp("updated_at")})
    return shown.orderBy(F.desc("players_count"), "world", "world_type", "vocation")


def distribution(summary: DataFrame, by: str) -> DataFrame:
    """Players by world or by vocation, most first."""
    totals = summary.groupBy(by).agg(F.sum("players_count").alias("players_count"))
    return totals.orderBy(F.desc("players_count"), by)


def distribution_kpis(summary: DataFrame) -> DataFrame:
    """One row: all players, number of worlds and vocations, last update."""
    return summary.agg(
        F.sum("players_count").alias("total_players"),
        F.count_distinct("world").alias("worlds"),
        F.count_distinct("vocation").alias("vocations"),
        F.max("updated_at").alias("last_update"),
    )


def find_players(
    progression: DataFrame,
    world: str | None = None,
    vocation: str | None = None,
    category: str | None = None,
    text: str | None = None,
    regex: bool = False,
) -> DataFrame:
    """Progression rows that pass the filters that are set."""
    worlds = None if world is None else [world]
    vocations = None if vocation is None else [vocation]
    rows = _filtered(progression, worlds, None, vocations, text, regex)
    return rows if category is None else rows.filter(F.col("category") == category)


def player_history(progression: DataFrame, name: str) -> DataFrame:
    """The versions of one player in time order: level line and gain bars."""
    time = "current_start_date" if "current_start_date" in progression.columns else "to_date"
    return progression.filter(F.col("name") == name).orderBy(time, "world")


def _last(time: str, *columns: str) -> Column:
    """The columns of the last row in time."""
    return F.max_by(F.struct(*columns), F.struct(time, "world", *columns))


def _mean(rate: str) -> Column:
    """Mean of the per-period rates; NULL rates do not count. Rates have two
    decimals, so decimals make the sum exact whatever its order."""
    return F.avg(F.col(rate).cast("decimal(28,2)")).cast("double")


def progression_kpis(progression: DataFrame, by: Sequence[str] = ("name",)) -> DataFrame:
    """Experience figures per player: where they stand, what they gained, how fast."""
    last = ["current_level", "world", "vocation", "world_type"]
    figures = progression.groupBy(*by).agg(
        _last("current_start_date", *last).alias("_last"),
        F.sum("experience_gain").alias("total_experience_gain"),
        _mean("avg_xp_per_day").alias("avg_xp_per_day"),
        F.sum("days_between_updates").alias("days_monitored"),
    )
    return figures.select(
        *by,
        *[F.col("_last")[c].alias(c) for c in last],
        "total_experience_gain",
        "avg_xp_per_day",
        "days_monitored",
    )


def skill_kpis(progression: DataFrame, by: Sequence[str] = ("name",)) -> DataFrame:
    """Skill figures per player. The current skill is the highest one ever held; of
    several categories updated at the same time the last in order is shown."""
    last = [c for c in ("world", "vocation", "category") if c not in by]
    figures = progression.groupBy(*by).agg(
        F.max("skill_after").alias("current_skill"),
        _last("to_date", *last).alias("_last"),
        F.sum("skill_gain").alias("total_skill_gain"),
        F.round(_mean("avg_skill_per_day"), 2).alias("avg_skill_per_day"),
        F.sum("days_between_updates").alias("days_monitored"),
    )
    return figures.select(
        *by,
        "current_skill",
        *[F.col("_last")[c].alias(c) for c in last],
        "total_skill_gain",
        "avg_skill_per_day",
        "days_monitored",
    )


def progression_display(history: DataFrame) -> DataFrame:
    """A player's history as text for people."""
    amounts = ["experience_gain", "avg_xp_per_day", "skill_gain", "avg_skill_per_day"]
    times = ["previous_start_date", "current_start_date", "from_date", "to_date"]
    shown = {c: show_amount(c) for c in amounts if c in history.columns}
    shown |= {c: show_timestamp(c) for c in times if c in history.columns}
    chosen = SKILL_HISTORY if "skill_after" in history.columns else PLAYER_HISTORY
    return history.withColumns(shown).select(*chosen)


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per group, most first."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    return counted.orderBy(F.desc("rows"), *columns)
