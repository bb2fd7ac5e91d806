"""Fixed dimensions of the ranking pages, their routing, and the tables' schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The numbers are those used in the URLs of the ranking pages.
VOCATIONS = {
    "none": 1,
    "knight": 2,
    "paladin": 3,
    "sorcerer": 4,
    "druid": 5,
    "monk": 6,
}
WORLD_TYPES = {
    "Open PvP": 0,
    "Optional PvP": 1,
    "Hardcore PvP": 2,
    "Retro Open PvP": 3,
    "Retro Hardcore PvP": 4,
}
# Key: (category number, label, vocation number)
CATEGORIES = {
    "achievements": (1, "Achievements", 0),
    "axe": (2, "Axe Fighting", 2),
    "sword": (13, "Sword Fighting", 2),
    "club": (4, "Club Fighting", 2),
    "distance": (5, "Distance Fighting", 3),
    "magic_level": (11, "Magic Level", 4),
    "fist": (8, "Fist Fighting", 0),
    "shielding": (12, "Shielding", 0),
    "fishing": (7, "Fishing", 0),
    "loyalty": (10, "Loyalty Points", 0),
    "drome": (14, "Drome Score", 0),
    "boss": (15, "Boss Points", 0),
    "charm": (3, "Charm Points", 0),
    "goshnair": (9, "Goshnar's Taint", 0),
}
EXTRA_CATEGORIES = ["achievements", "loyalty", "drome", "boss", "charm", "goshnair"]
EXPERIENCE_CATEGORY = 6

# Columns of the landing files.
EXPERIENCE_HEADER = ["Rank", "Name", "Vocation", "World", "Level", "Points", "WorldType"]
SKILLS_HEADER = ["Rank", "Name", "Vocation", "World", "Skill Level", "Category"]

_AUDIT = """ingestion_time timestamp, ingestion_date date, source_system string,
    batch_id string"""
_VERSION = """ingestion_time timestamp, start_date timestamp, end_date timestamp,
    is_current boolean, hash_diff string"""

# Table: (columns, partition columns)
TABLES = {
    "bronze.vocation": (
        f"""name string, vocation string, level int, world string, experience bigint,
        world_type string, {_AUDIT}""",
        ["world", "ingestion_date"],
    ),
    "bronze.skills": (
        f"""name string, vocation string, world string, skill_level int, category string,
        {_AUDIT}""",
        ["world", "ingestion_date"],
    ),
    "bronze.extra": (
        f"""name string, vocation string, world string, category string, title string,
        points int, {_AUDIT}, source_file string""",
        ["world", "ingestion_date"],
    ),
    "silver.vocation": (
        f"""name string, world string, vocation string, level int, experience bigint,
        world_type string, {_VERSION}""",
        ["world"],
    ),
    "silver.skills": (
        f"""name string, world string, category string, vocation string, skill_level int,
        {_VERSION}""",
        ["world"],
    ),
    "silver.extra": (
        f"""name string, world string, category string, title string, vocation string,
        points int, source_file string, {_VERSION}""",
        ["world"],
    ),
    "gold.experience_global_rank": (
        """rank bigint, name string, world string, vocation string, level int,
        experience bigint, world_type string, updated_at timestamp, snapshot_date date""",
        ["snapshot_date"],
    ),
    "gold.skills_global_rank": (
        """rank bigint, name string, world string, skill_name string, vocation string,
        skill_level int, updated_at timestamp, snapshot_date date""",
        ["snapshot_date"],
    ),
}


def dim_vocation(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(VOCATIONS.items()), "vocation_key string, vocation_id int")


def dim_world_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(WORLD_TYPES.items()), "world_type string, world_type_id int")


def dim_category(spark: SparkSession) -> DataFrame:
    rows = [
        (key, number, label, vocation, category_domain(key))
        for key, (number, label, vocation) in CATEGORIES.items()
    ]
    return spark.createDataFrame(
        rows, "category_key string, category_id int, label string, vocation_id int, domain string"
    )


def category_domain(key: str) -> str:
    """The landing folder of a category; unknown keys are refused."""
    key = key.strip().lower()
    if key not in CATEGORIES:
        raise ValueError(f"unknown category: {key}")
    return "extra" if key in EXTRA_CATEGORIES else "skills"


def vocation_id(key: str) -> int:
    key = key.strip().lower()
    if key not in VOCATIONS:
        raise ValueError(f"unknown vocation: {key}")
    return VOCATIONS[key]


def with_dimension(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """``df`` with the other columns of a dimension, NULL where ``key`` is not in it.

    The dimensions above are fixed lists of a few rows, so they are broadcast.
    """
    return df.join(F.broadcast(dimension), key, "left")


def unknown_values(df: DataFrame, column: str, known: Sequence) -> DataFrame:
    """Rows whose ``column`` is not one of the ``known`` keys (NULL included)."""
    return df.filter(~F.coalesce(F.col(column).isin(list(known)), F.lit(False)))
