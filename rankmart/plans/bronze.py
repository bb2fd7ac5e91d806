"""Landing text to typed, stamped, deduplicated batches."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmart.functions.text import clean_text, is_rejected, parse_grouped_number, parse_number
from rankmart.operators.conform import conform, normalise_columns, rename_synonyms, stamp
from rankmart.operators.dedup import dedup
from rankmart.operators.quality import reject_counts, require_columns
from rankmart.sources.domain import EXPERIENCE_HEADER, SKILLS_HEADER
from rankmart.sources.landing import ORIGIN

EXTRA_COLUMNS = {
    "name": "string",
    "vocation": "string",
    "world": "string",
    "category": "string",
    "title": "string",
    "points": "string",
}
SYNONYMS = {"score": "points"}

VOCATION_KEYS = ["name", "world"]
SKILLS_KEYS = ["name", "world", "category"]
EXTRA_KEYS = ["name", "world", "category", "title"]


def _load(
    raw: DataFrame,
    columns: list[Column],
    keys: Sequence[str],
    batch_id: str,
    as_of: datetime | Column | str,
) -> DataFrame:
    """Typed rows, one per key, stamped. A later extraction wins over an earlier one."""
    origin = [c for c in ORIGIN if c in raw.columns]
    loads = [as_of] if isinstance(as_of, str) else []
    one = dedup(raw.select(*columns, *origin, *loads), [*keys, *loads], origin)
    time = F.col(as_of) if isinstance(as_of, str) else as_of
    return stamp(one.drop(*ORIGIN), batch_id, time).drop(*loads)


def bronze_vocation(
    raw: DataFrame,
    batch_id: str,
    as_of: datetime | Column | str,
    keys: Sequence[str] = VOCATION_KEYS,
) -> DataFrame:
    """Experience rankings: one row per key.

    ``as_of`` is the time of the load, or the name of a column with it when the frame
    holds several loads.
    """
    require_columns(raw, EXPERIENCE_HEADER)
    columns = [
        F.col("Name").alias("name"),
        clean_text("Vocation").alias("vocation"),
        parse_number("Level").alias("level"),
        clean_text("World").alias("world"),
        parse_grouped_number("Points").alias("experience"),
        F.col("WorldType").alias("world_type"),
    ]
    return _load(raw, columns, keys, batch_id, as_of)


def vocation_rejects(raw: DataFrame) -> DataFrame:
    """One row: texts of a landing frame that are not numbers."""
    return reject_counts(
        raw,
        {
            "level": is_rejected("Level", parse_number("Level")),
            "experience": is_rejected("Points", parse_grouped_number("Points")),
        },
    )


def bronze_skills(
    raw: DataFrame,
    batch_id: str,
    as_of: datetime | Column | str,
    keys: Sequence[str] = SKILLS_KEYS,
) -> DataFrame:
    """Skill rankings: one row per player, world and category."""
    require_columns(raw, SKILLS_HEADER)
    columns = [
        F.col("Name").alias("name"),
        clean_text("Vocation").alias("vocation"),
        clean_text("World").alias("world"),
        parse_number("Skill Level").alias("skill_level"),
        F.col("Category").alias("category"),
    ]
    return _load(raw, columns, keys, batch_id, as_of)


def bronze_extra(
    raw: DataFrame,
    batch_id: str,
    as_of: datetime | Column | str,
    keys: Sequence[str] = EXTRA_KEYS,
) -> DataFrame:
    """Other rankings, whatever their header; keeps the file of each row.

    ``as_of`` may be the name of a lower-case timestamp column, as for the other loads.
    """
    origin = {c: "string" for c in ORIGIN}
    loads = [as_of] if isinstance(as_of, str) else []
    named = rename_synonyms(normalise_columns(raw), SYNONYMS)
    columns = {**EXTRA_COLUMNS, **origin, **{c: "timestamp" for c in loads}}
    typed = conform(named, columns).withColumns(
        {
            "points": parse_grouped_number("points", "int"),
            "vocation": clean_text("vocation"),
            "world": clean_text("world"),
        }
    )
    one = dedup(typed, [*keys, *loads], ORIGIN).drop("landing_run")
    time = F.col(as_of) if isinstance(as_of, str) else as_of
    stamped = stamp(one, batch_id, time).drop(*loads)
    return stamped.select(*[c for c in stamped.columns if c != "source_file"], "source_file")
