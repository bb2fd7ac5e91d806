"""SQL building blocks for checking the queries with DuckDB."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-02-01 06:30:00'"

RAW = """raw AS (
  SELECT CAST(c_custkey + 1 AS VARCHAR) AS rank_text, c_name AS name,
    lower(trim(c_mktsegment)) AS vocation, lower(trim(n_name)) AS world,
    CASE WHEN c_acctbal < 500 THEN NULL ELSE CAST(floor(c_acctbal / 100) AS INTEGER) END AS level,
    CAST(floor(c_acctbal * 100) AS BIGINT) AS experience,
    r_name AS world_type, r_regionkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""

POPULATION_RANK = f"""SELECT
  row_number() OVER (ORDER BY level DESC NULLS LAST, experience DESC NULLS LAST, name, world)
    AS rank,
  name, world, vocation, level, experience, world_type,
  {AS_OF} AS updated_at, CAST({AS_OF} AS DATE) AS snapshot_date
FROM raw"""


def hashed(*columns: str) -> str:
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(1))" for c in columns)
    return f"sha256(concat_ws('||', {texts}))"


def _daily(name: str, columns: str, keys: str) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (ts, event_id, n) FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys}, day ORDER BY ts DESC, event_id DESC) AS n
    FROM (SELECT {columns}, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, ts, event_id
          FROM events))
  WHERE n = 1)"""


def _versions(name: str, daily: str, keys: str, tracked: tuple[str, ...]) -> str:
    w = f"OVER (PARTITION BY {keys} ORDER BY day)"
    return f"""{name} AS (
  SELECT * EXCLUDE (day, before), day AS start_date, lead(day) {w} AS end_date,
    lead(day) {w} IS NULL AS is_current
  FROM (SELECT *, lag(hash_diff) {w} AS before
        FROM (SELECT *, {hashed(*tracked)} AS hash_diff FROM {daily}))
  WHERE before IS DISTINCT FROM hash_diff)"""


DAILY_VOCATION = _daily(
    "daily_vocation",
    """'player ' || user_id AS name,
    'world ' || ((user_id + CASE WHEN day(ts) >= 16 THEN 1 ELSE 0 END) % 10) AS world,
    event_type AS vocation, CAST(floor(value / 25) AS INTEGER) AS level,
    CAST(floor(value * 100) AS BIGINT) AS experience, 'type ' || (user_id % 5) AS world_type""",
    "name, world",
)
DAILY_SKILLS = _daily(
    "daily_skills",
    """'player ' || user_id AS name, 'world ' || (user_id % 10) AS world,
    event_type AS category, 'vocation ' || (user_id % 6) AS vocation,
    CAST(floor(value / 25) AS INTEGER) AS skill_level""",
    "name, world, category",
)
DAILY_EXTRA = _daily(
    "daily_extra",
    """'player ' || user_id AS name, 'world' AS world, event_type AS category,
    CASE WHEN value >= 20 THEN 'title ' || CAST(floor(value / 50) AS BIGINT) END AS title,
    'vocation ' || (user_id % 6) AS vocation, CAST(floor(value) AS INTEGER) AS points""",
    "name, world, category, title",
)
VOCATION_STATE = ",\n".join(
    [
        DAILY_VOCATION,
        _versions(
            "vocation_state",
            "daily_vocation",
            "name, world",
            ("vocation", "level", "experience", "world_type"),
        ),
    ]
)
SKILLS_STATE = ",\n".join(
    [
        DAILY_SKILLS,
        _versions(
            "skills_state", "daily_skills", "name, world, category", ("vocation", "skill_level")
        ),
    ]
)
EXTRA_STATE = ",\n".join(
    [
        DAILY_EXTRA,
        _versions(
            "extra_state", "daily_extra", "name, world, category, title", ("vocation", "points")
        ),
    ]
)


def rounded_rate(gain: str, days: str) -> str:
    """gain / days rounded half away from zero to two decimals, on whole numbers."""
    return (
        f"sign({gain}) * ((abs(CAST({gain} AS HUGEINT)) * 200 + {days}) // (2 * {days})) / 100.0"
    )


def progression(source: str) -> str:
    """CTE ``progression`` over a CTE or table of vocation versions."""
    w = "OVER (PARTITION BY name ORDER BY start_date, world)"
    rate = rounded_rate("experience_gain", "greatest(days_between_updates, 1)")
    return f"""progression AS (
  SELECT *, CAST({rate} AS DOUBLE) AS avg_xp_per_day, {AS_OF} AS updated_at
  FROM (
    SELECT name, world, vocation, world_type, previous_level, level AS current_level,
      level - previous_level AS level_gain, previous_experience,
      experience AS current_experience, experience - previous_experience AS experience_gain,
      previous_start_date, start_date AS current_start_date,
      CAST(date_diff('day', CAST(previous_start_date AS DATE), CAST(start_date AS DATE))
        AS INTEGER) AS days_between_updates, is_current
    FROM (SELECT *, lag(level) {w} AS previous_level, lag(experience) {w} AS previous_experience,
            lag(start_date) {w} AS previous_start_date FROM {source})
    WHERE previous_level IS NOT NULL))"""


_SKILL_W = "OVER (PARTITION BY name, category ORDER BY start_date, world)"
SKILLS_PROGRESSION = f"""progression AS (
  SELECT *, CASE WHEN days_between_updates <> 0 THEN CAST(
      {rounded_rate("skill_gain", "days_between_updates")} AS DOUBLE) END AS avg_skill_per_day,
    {AS_OF} AS updated_at
  FROM (
    SELECT name, world, vocation, category, skill_before, skill_level AS skill_after,
      skill_level - skill_before AS skill_gain, from_date, start_date AS to_date,
      CAST(date_diff('day', CAST(from_date AS DATE), CAST(start_date AS DATE)) AS INTEGER)
        AS days_between_updates, is_current
    FROM (SELECT *, lag(skill_level) {_SKILL_W} AS skill_before,
            lag(start_date) {_SKILL_W} AS from_date FROM skills_state)
    WHERE skill_before IS NOT NULL))"""

ORDER_VERSIONS = """order_versions AS (
  SELECT 'customer ' || o_custkey AS name, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS world,
    o_orderpriority AS vocation, o_orderstatus AS world_type,
    CAST(floor(o_totalprice / 1000) AS INTEGER) AS level,
    CAST(floor(o_totalprice * 100) AS BIGINT) AS experience, o_orderdate AS start_date,
    o_orderstatus = 'O' AS is_current
  FROM orders)"""

SNAPSHOTS = f"""{DAILY_VOCATION}, snapshots AS (
  SELECT row_number() OVER (PARTITION BY day ORDER BY level DESC NULLS LAST,
      experience DESC NULLS LAST, name, world) AS rank,
    name, world, vocation, level, experience, world_type, day AS updated_at,
    CAST(day AS DATE) AS snapshot_date
  FROM daily_vocation)"""
SKILL_SNAPSHOTS = f"""{DAILY_SKILLS}, snapshots AS (
  SELECT row_number() OVER (PARTITION BY day, category
      ORDER BY skill_level DESC NULLS LAST, name, world) AS rank,
    name, world, category AS skill_name, vocation, skill_level, day AS updated_at,
    CAST(day AS DATE) AS snapshot_date
  FROM daily_skills)"""
SUMMARY = f"""{RAW}, summary AS (
  SELECT world, world_type, vocation, count(DISTINCT name) AS players_count,
    {AS_OF} AS updated_at
  FROM raw GROUP BY world, world_type, vocation)"""
