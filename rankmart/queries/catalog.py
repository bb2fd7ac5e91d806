"""Every operator as a query over the driver tables, with the SQL to check it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from rankmart.functions.hashing import hash_diff
from rankmart.functions.text import show_amount, show_timestamp
from rankmart.operators import conform, quality, rank, scd2
from rankmart.operators.as_of import as_of_join
from rankmart.operators.dedup import dedup
from rankmart.operators.distinct import distinct_players, numbered, player_bitmaps
from rankmart.operators.rules import Gate, Rules, gate, required
from rankmart.plans import bronze, gold, views
from rankmart.plans.marts import PlayerProgressions, SkillProgressions, refresh_marts
from rankmart.plans.names import NameIndex
from rankmart.plans.silver import EXTRA, SKILLS, VOCATION
from rankmart.queries import oracle as o
from rankmart.queries import standin as s
from rankmart.queries.standin import AS_OF, moment, table
from rankmart.session import scratch_path
from rankmart.sources import landing, pages, tables
from rankmart.sources.domain import (
    CATEGORIES,
    EXPERIENCE_HEADER,
    VOCATIONS,
    WORLD_TYPES,
    category_domain,
    dim_category,
    dim_vocation,
    dim_world_type,
    unknown_values,
    with_dimension,
)
from rankmart.streaming.ingest import ingest_available, landed_at

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Small enough that the test tables are cut into several slices.
FEW_ROWS = 400
MIDDLE = "2024-01-16"


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the checking database has them."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def _stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table of their own, as one stage leaves them for the next."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _positioned(df: DataFrame) -> DataFrame:
    """A small sorted result with the place of each row, so that its order is checked."""
    placed = df.withColumn("_at", F.monotonically_increasing_id())
    position = F.row_number().over(W.orderBy("_at")).cast("long")
    return placed.withColumn("position", position).drop("_at")


def _vocation_table(spark, sf_dir):
    return _stored(s.vocation_state(spark, sf_dir), "silver")


def _skills_table(spark, sf_dir):
    return _stored(s.skills_state(spark, sf_dir), "silver")


def _snapshot_table(spark, sf_dir):
    return _stored(s.snapshots(spark, sf_dir), "gold")


def _skill_snapshot_table(spark, sf_dir):
    return _stored(s.skill_snapshots(spark, sf_dir), "gold")


# --- bronze -------------------------------------------------------------------


@query(f"""WITH {o.RAW}
SELECT name, vocation, level, world, experience, world_type, {o.AS_OF} AS ingestion_time,
  CAST({o.AS_OF} AS DATE) AS ingestion_date, 'highscore_page' AS source_system,
  'batch 1' AS batch_id
FROM raw""")
def bronze_normalize(spark, sf_dir):
    return bronze.bronze_vocation(s.raw_experience(spark, sf_dir), "batch 1", moment(AS_OF))


@query("""SELECT count(*) FILTER (c_acctbal < 500) AS level, CAST(0 AS BIGINT) AS experience
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def bronze_rejects(spark, sf_dir):
    return bronze.vocation_rejects(s.raw_experience(spark, sf_dir))


def _raw_skills(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.lit(None).cast("string").alias("Rank"),
        F.concat(F.lit("player "), F.col("user_id").cast("string")).alias("Name"),
        F.concat(F.lit(" Vocation "), (F.col("user_id") % 6).cast("string")).alias("Vocation"),
        F.concat(F.lit("WORLD "), (F.col("user_id") % 10).cast("string")).alias("World"),
        F.floor(F.col("value") / 25).cast("string").alias("Skill Level"),
        F.col("event_type").alias("Category"),
        F.date_format("ts", "HHmmss").alias("landing_run"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("source_file"),
        F.to_date("ts").cast("timestamp_ntz").alias("day"),
    )


@query(f"""SELECT name, vocation, world, skill_level, category, {o.AS_OF} AS ingestion_time,
  CAST({o.AS_OF} AS DATE) AS ingestion_date, 'highscore_page' AS source_system,
  'batch 1' AS batch_id
FROM (SELECT *, row_number() OVER (PARTITION BY name, category ORDER BY run DESC, event_id DESC) n
  FROM (SELECT 'player ' || user_id AS name, 'vocation ' || (user_id % 6) AS vocation,
    'world ' || (user_id % 10) AS world, CAST(floor(value / 25) AS INTEGER) AS skill_level,
    event_type AS category, strftime(ts, '%H%M%S') AS run, event_id FROM events))
WHERE n = 1""")
def bronze_skills(spark, sf_dir):
    return bronze.bronze_skills(_raw_skills(spark, sf_dir), "batch 1", moment(AS_OF))


@query("""SELECT name, vocation, world, skill_level, category, day AS ingestion_time,
  CAST(day AS DATE) AS ingestion_date, 'highscore_page' AS source_system, 'all' AS batch_id
FROM (SELECT *, row_number() OVER (PARTITION BY name, category, day
    ORDER BY run DESC, event_id DESC) n
  FROM (SELECT 'player ' || user_id AS name, 'vocation ' || (user_id % 6) AS vocation,
    'world ' || (user_id % 10) AS world, CAST(floor(value / 25) AS INTEGER) AS skill_level,
    event_type AS category, strftime(ts, '%H%M%S') AS run, event_id,
    CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM events))
WHERE n = 1""")
def bronze_skills_many_loads(spark, sf_dir):
    return bronze.bronze_skills(_raw_skills(spark, sf_dir), "all", "day")


@query(f"""SELECT name, vocation, world, category, CAST(NULL AS VARCHAR) AS title, points,
  {o.AS_OF} AS ingestion_time, CAST({o.AS_OF} AS DATE) AS ingestion_date,
  'highscore_page' AS source_system, 'batch 1' AS batch_id, source_file
FROM (SELECT c_name AS name, lower(c_mktsegment) AS vocation, 'w' AS world,
    o_orderpriority AS category, CAST(floor(o_totalprice) AS INTEGER) AS points,
    lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS source_file,
    row_number() OVER (PARTITION BY c_custkey, o_orderpriority ORDER BY o_orderkey DESC) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey)
WHERE n = 1""")
def bronze_extra(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    raw = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("Name"),
        F.col("c_mktsegment").alias("Vocation"),
        F.lit(" W").alias("World"),
        F.col("o_orderpriority").alias("Category"),
        F.format_number(F.floor("o_totalprice"), 0).alias("Score"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("source_file"),
    )
    return bronze.bronze_extra(raw, "batch 1", moment(AS_OF))


@query("""SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) n
  FROM events) WHERE n = 1""")
def bronze_dedup(spark, sf_dir):
    return dedup(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"])


@query("""SELECT c_name AS name, c_mktsegment AS vocation,
  CAST(floor(c_acctbal) AS BIGINT) AS points, CAST(NULL AS VARCHAR) AS title FROM customer
UNION ALL
SELECT s_name, NULL, CAST(floor(s_acctbal) AS BIGINT), CAST(s_nationkey AS VARCHAR)
FROM supplier""")
def conform_union(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("Name"),
        F.col("c_mktsegment").alias("Vocation"),
        F.floor("c_acctbal").alias("Score"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.floor("s_acctbal").alias("Points"),
        F.col("s_nationkey").alias("Title"),
        F.col("s_name").alias("Name"),
    )
    columns = {"name": "string", "vocation": "string", "points": "bigint", "title": "string"}
    frames = [
        conform.conform(
            conform.rename_synonyms(conform.normalise_columns(f), bronze.SYNONYMS), columns
        )
        for f in (customer, supplier)
    ]
    return conform.union_all(frames)


def _loads(spark, sf_dir):
    """Events as bronze rows, one batch a day."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.date_format("ts", "yyyyMMdd").alias("batch_id"),
        F.to_date("ts").cast("timestamp_ntz").alias("ingestion_time"),
    )


@query("""SELECT event_id, user_id, event_type, strftime(ts, '%Y%m%d') AS batch_id,
  CAST(CAST(ts AS DATE) AS TIMESTAMP) AS ingestion_time
FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def latest_batch(spark, sf_dir):
    return scd2.latest_batch(_loads(spark, sf_dir))


# --- versions -----------------------------------------------------------------


@query(f"""SELECT event_id, {o.hashed("event_type", "user_id", "title")} AS hash_diff
FROM (SELECT *, CASE WHEN value >= 20 THEN event_type END AS title FROM events)""")
def hash_diff_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    events = events.withColumn("title", F.when(F.col("value") >= 20, F.col("event_type")))
    digest = hash_diff(["event_type", "user_id", "title"])
    return events.select("event_id", digest.alias("hash_diff"))


_VOCATION_STATE = f"WITH {o.VOCATION_STATE} SELECT * FROM vocation_state"


@query(_VOCATION_STATE)
def scd2_from_batches(spark, sf_dir):
    return s.vocation_state(spark, sf_dir)


@query(_VOCATION_STATE)
def scd2_from_batches_sliced(spark, sf_dir):
    """The same with slices small enough to be needed here."""
    return s.vocation_state(spark, sf_dir, rows_per_slice=FEW_ROWS)


@query(f"""WITH {o.DAILY_VOCATION}, one AS (
  SELECT vocation, day, max(level) AS level FROM daily_vocation GROUP BY vocation, day),
kept AS (SELECT * FROM (SELECT *, lag(level) OVER (PARTITION BY vocation ORDER BY day) AS b,
  row_number() OVER (PARTITION BY vocation ORDER BY day) AS n FROM one)
  WHERE n = 1 OR b IS DISTINCT FROM level)
SELECT vocation, level, day AS start_date, lead(day) OVER w AS end_date,
  lead(day) OVER w IS NULL AS is_current
FROM kept WINDOW w AS (PARTITION BY vocation ORDER BY day)""")
def scd2_best_level(spark, sf_dir):
    """Few keys with many rows each: the best level of every vocation by day."""
    daily = s.daily_vocation(spark, sf_dir)
    best = daily.groupBy("vocation", "day").agg(F.max("level").alias("level"))
    versions = scd2.scd2_from_batches(best, ["vocation"], ["level"], "day", rows_per_slice=20)
    return versions.drop("day", "hash_diff")


@query(f"WITH {o.SKILLS_STATE} SELECT * FROM skills_state")
def scd2_skills(spark, sf_dir):
    return s.skills_state(spark, sf_dir)


@query(f"WITH {o.EXTRA_STATE} SELECT * FROM extra_state")
def scd2_null_keys(spark, sf_dir):
    return s.extra_state(spark, sf_dir)


def _before_and_last(daily: DataFrame) -> tuple[DataFrame, DataFrame, datetime]:
    """All days but the last, the last one as a batch, and its time."""
    end = daily.agg(F.max("day")).first()[0]
    last = F.col("day") == moment(str(end))
    return daily.filter(~last), daily.filter(last).drop("day"), end


@query(_VOCATION_STATE)
def scd2_apply(spark, sf_dir):
    """All days but the last in one pass, then the last day as a batch of its own."""
    before, last, end = _before_and_last(s.daily_vocation(spark, sf_dir))
    state = scd2.scd2_from_batches(before, VOCATION.keys, VOCATION.tracked, "day").drop("day")
    return VOCATION.apply(state, last, moment(str(end)))


@query(f"WITH {o.EXTRA_STATE} SELECT * FROM extra_state")
def scd2_apply_null_keys(spark, sf_dir):
    before, last, end = _before_and_last(s.daily_extra(spark, sf_dir))
    state = scd2.scd2_from_batches(before, EXTRA.keys, EXTRA.tracked, "day").drop("day")
    return EXTRA.apply(state, last, moment(str(end)))


@query(f"""WITH {o.SKILLS_STATE}
SELECT * EXCLUDE (end_date, is_current, seen),
  CASE WHEN is_current AND seen IS NULL THEN (SELECT max(day) FROM daily_skills)
    ELSE end_date END AS end_date,
  is_current AND seen IS NOT NULL AS is_current
FROM (SELECT v.*, d.day FROM skills_state v LEFT JOIN
    (SELECT * FROM daily_skills WHERE day = (SELECT max(day) FROM daily_skills)) d
  ON d.name = v.name AND d.world = v.world AND d.category = v.category) AS t(name, world, category, vocation, skill_level,
  hash_diff, start_date, end_date, is_current, seen)""")
def scd2_close_missing(spark, sf_dir):
    before, last, end = _before_and_last(s.daily_skills(spark, sf_dir))
    state = scd2.scd2_from_batches(before, SKILLS.keys, SKILLS.tracked, "day").drop("day")
    return SKILLS.apply(state, last, moment(str(end)), close_missing=True)


@query(_VOCATION_STATE)
def scd2_catch_up(spark, sf_dir):
    """State of the first half of the month, continued with all later days at once."""
    daily = s.daily_vocation(spark, sf_dir)
    early = daily.filter(F.col("day") < moment(MIDDLE))
    late = daily.filter(F.col("day") >= moment(MIDDLE))
    state = scd2.scd2_from_batches(early, VOCATION.keys, VOCATION.tracked, "day").drop("day")
    later = scd2.scd2_from_batches(
        late, VOCATION.keys, VOCATION.tracked, "day", current=state.filter("is_current")
    )
    return state.filter("NOT is_current").unionByName(later)


@query(f"""WITH {o.VOCATION_STATE} SELECT * FROM vocation_state
WHERE start_date <= TIMESTAMP '2024-01-15 12:00:00'
  AND (end_date IS NULL OR end_date > TIMESTAMP '2024-01-15 12:00:00')""")
def scd2_as_of(spark, sf_dir):
    return scd2.scd2_as_of(s.vocation_state(spark, sf_dir), moment("2024-01-15 12:00:00"))


_LAST_EXTRA = """last_day AS (SELECT * EXCLUDE (day) FROM daily_extra
  WHERE day = (SELECT max(day) FROM daily_extra)),
before AS (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY name, world, category, title ORDER BY day DESC) AS n FROM daily_extra
  WHERE day < (SELECT max(day) FROM daily_extra)) WHERE n = 1)"""


def _extra_before(spark, sf_dir):
    before, last, _ = _before_and_last(s.daily_extra(spark, sf_dir))
    state = scd2.scd2_from_batches(before, EXTRA.keys, EXTRA.tracked, "day").drop("day")
    return state.filter("is_current"), last


@query(f"""WITH {o.DAILY_EXTRA}, {_LAST_EXTRA}
SELECT * FROM last_day u WHERE NOT EXISTS (SELECT 1 FROM before c WHERE c.name = u.name
  AND c.world = u.world AND c.category = u.category AND c.title IS NOT DISTINCT FROM u.title)""")
def new_keys(spark, sf_dir):
    current, updates = _extra_before(spark, sf_dir)
    return scd2.new_keys(current, updates, EXTRA.keys)


@query(f"""WITH {o.DAILY_EXTRA}, {_LAST_EXTRA}
SELECT u.name, u.world, u.category, u.title, {o.hashed("u.vocation", "u.points")} AS new_hash,
  {o.hashed("c.vocation", "c.points")} AS old_hash
FROM last_day u JOIN before c ON c.name = u.name AND c.world = u.world
  AND c.category = u.category AND c.title IS NOT DISTINCT FROM u.title
WHERE c.points <> u.points OR c.vocation <> u.vocation""")
def changed_keys(spark, sf_dir):
    current, updates = _extra_before(spark, sf_dir)
    return scd2.changed_keys(current, updates, EXTRA.keys, EXTRA.tracked)


@query(f"""WITH {o.VOCATION_STATE} SELECT count(*) AS total_rows,
  count(*) FILTER (is_current) AS current_rows FROM vocation_state""")
def scd2_audit(spark, sf_dir):
    return quality.audit(s.vocation_state(spark, sf_dir))


@query(f"""WITH {o.VOCATION_STATE} SELECT name, count(*) AS rows FROM vocation_state
WHERE is_current GROUP BY name HAVING count(*) > 1""")
def duplicate_current_keys(spark, sf_dir):
    """Names that are current in more than one world."""
    return quality.duplicate_current_keys(s.vocation_state(spark, sf_dir), ["name"])


@query(f"""WITH {o.VOCATION_STATE} SELECT count(*) AS duplicates FROM (
  SELECT name, world FROM vocation_state WHERE is_current GROUP BY ALL HAVING count(*) > 1)""")
def duplicate_business_keys(spark, sf_dir):
    """How many business keys have several current versions: none in a sound history."""
    found = quality.duplicate_current_keys(s.vocation_state(spark, sf_dir), VOCATION.keys)
    return found.agg(F.count(F.lit(1)).alias("duplicates"))


@query("""SELECT 'rows' AS check_name, (SELECT count(*) FROM events) >= 1000 AS valid
UNION ALL SELECT 'too few', (SELECT count(*) FROM events) >= 1000000000
UNION ALL SELECT 'no such column', false
UNION ALL SELECT 'no rows', (SELECT count(*) FROM events WHERE value < 0) >= 1""")
def batch_validation(spark, sf_dir):
    """Batches with enough rows and the columns asked for, and such that lack either."""
    events = table(spark, sf_dir, "events")
    found = [
        ("rows", quality.validate(events, ["event_id", "ts"], 1000)),
        ("too few", quality.validate(events, ["event_id"], 1_000_000_000)),
        ("no such column", quality.validate(events, ["event_id", "level"])),
        ("no rows", quality.validate(events.filter("value < 0"), ["event_id"])),
    ]
    return spark.createDataFrame(found, "check_name string, valid boolean")


@query("""SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS rows FROM events
GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return quality.duplicate_keys(events, ["user_id", "event_type", "day"])


_ITEM_RULES = {
    "quantity at most 45": "l_quantity <= 45",
    "discount below a tenth": "l_discount < 0.1",
    "returned or open": "l_returnflag IN ('A', 'R') OR l_linestatus = 'O'",
}
_BROKEN_ITEMS = """SELECT l_orderkey, l_linenumber, l_partkey,
    NOT coalesce(l_quantity <= 45, false) AS a, NOT coalesce(l_discount < 0.1, false) AS b,
    NOT coalesce(l_returnflag IN ('A', 'R') OR l_linestatus = 'O', false) AS c FROM lineitem"""


def _gate(df: DataFrame, rules: Rules) -> Gate:
    return gate(df, rules, scratch_path(df.sparkSession, "gate"))


@query(f"""WITH judged AS ({_BROKEN_ITEMS})
SELECT l_orderkey, l_linenumber, l_partkey, NOT (a OR b OR c) AS accepted,
  concat_ws(', ', CASE WHEN a THEN 'quantity at most 45' END,
    CASE WHEN b THEN 'discount below a tenth' END,
    CASE WHEN c THEN 'returned or open' END) AS broken,
  count(*) FILTER (NOT (a OR b OR c)) OVER () AS good_rows,
  count(*) FILTER (a OR b OR c) OVER () AS quarantined_rows
FROM judged""")
def quality_gate(spark, sf_dir):
    """Accepted and quarantined rows as written, with the counts taken while writing."""
    found = _gate(table(spark, sf_dir, "lineitem"), _ITEM_RULES)
    key = ["l_orderkey", "l_linenumber", "l_partkey"]
    good = found.good.select(*key, F.lit(True).alias("accepted"), F.lit("").alias("broken"))
    broken = F.array_join("broken", ", ").alias("broken")
    bad = found.quarantined.select(*key, F.lit(False).alias("accepted"), broken)
    return good.unionAll(bad).withColumns(
        {
            "good_rows": F.lit(found.good_rows).cast("long"),
            "quarantined_rows": F.lit(found.quarantined_rows).cast("long"),
        }
    )


@query(f"""WITH judged AS ({_BROKEN_ITEMS}), n AS (SELECT count(*) AS n, sum(a::INT) AS a,
  sum(b::INT) AS b, sum(c::INT) AS c FROM judged),
given AS (SELECT count(*) AS n, count(*) - count(props) AS p, count(*) - count(ts) AS t FROM events)
SELECT load_name, rule, CAST(broken AS BIGINT) AS broken, CAST(of_rows AS BIGINT) AS of_rows FROM (
  SELECT 'items' AS load_name, 'quantity at most 45' AS rule, a AS broken, n AS of_rows FROM n
  UNION ALL SELECT 'items', 'discount below a tenth', b, n FROM n
  UNION ALL SELECT 'items', 'returned or open', c, n FROM n
  UNION ALL SELECT 'events', 'ts given', t, n FROM given
  UNION ALL SELECT 'events', 'props given', p, n FROM given
  UNION ALL SELECT 'events', 'world given', n, n FROM given
  UNION ALL SELECT 'no events', 'ts given', 0, 0)""")
def quality_gate_counts(spark, sf_dir):
    """Rows that break each rule; a load that lacks a column, and one without rows."""
    events = table(spark, sf_dir, "events")
    loads = [
        ("items", table(spark, sf_dir, "lineitem"), _ITEM_RULES),
        ("events", events, required(events, ["ts", "props", "world"])),
        ("no events", events.filter("event_id < 0"), required(events, ["ts"])),
    ]
    found = [(name, _gate(df, rules)) for name, df, rules in loads]
    rows = [(name, rule, n, g.rows) for name, g in found for rule, n in g.broken.items()]
    return spark.createDataFrame(
        rows, "load_name string, rule string, broken long, of_rows long"
    )


def _player_bitmaps(spark, sf_dir):
    daily = _stored(s.daily_vocation(spark, sf_dir), "daily")
    numbers = _stored(numbered(daily, "name", "world"), "numbers")
    cells = ["day", "world", "vocation"]
    return _stored(player_bitmaps(daily, "name", cells, numbers), "bitmaps")


@query(f"""WITH {o.DAILY_VOCATION}
SELECT day, world, vocation, grouping(day, world, vocation) AS set_id,
  count(DISTINCT name) AS players_count
FROM daily_vocation
GROUP BY GROUPING SETS ((day), (day, world), (world, vocation), (vocation), ())""")
def distinct_players_by(spark, sf_dir):
    """Distinct players by several sets of columns at once, from stored bitmaps."""
    sets = [["day"], ["day", "world"], ["world", "vocation"], ["vocation"], []]
    return _plain(distinct_players(_player_bitmaps(spark, sf_dir), sets))


@query(f"""WITH {o.DAILY_VOCATION}
SELECT world, CAST(0 AS BIGINT) AS set_id, count(DISTINCT name) AS players_count
FROM daily_vocation WHERE day BETWEEN '2024-01-05' AND '2024-01-20' AND vocation <> 'view'
GROUP BY world""")
def distinct_players_where(spark, sf_dir):
    """Distinct players of some days and vocations: a filter on the stored cells."""
    cells = _player_bitmaps(spark, sf_dir)
    days = F.col("day").between(moment("2024-01-05"), moment("2024-01-20"))
    return distinct_players(cells.filter(days & (F.col("vocation") != "view")), [["world"]])


# --- marts --------------------------------------------------------------------


@query(_VOCATION_STATE)
def scd2_apply_small(spark, sf_dir):
    """The last day as a batch small enough to be sent to the current versions."""
    before, last, end = _before_and_last(s.daily_vocation(spark, sf_dir))
    state = scd2.scd2_from_batches(before, VOCATION.keys, VOCATION.tracked, "day").drop("day")
    stepped = scd2.scd2_step(
        state.filter("is_current"),
        last,
        VOCATION.keys,
        VOCATION.tracked,
        moment(str(end)),
        small_updates=True,
    )
    return state.filter("NOT is_current").unionByName(stepped)


@query(f"WITH {o.RAW} {o.POPULATION_RANK}")
def experience_global_rank(spark, sf_dir):
    return gold.experience_global_rank(s.population(spark, sf_dir), moment(AS_OF))


@query(f"WITH {o.RAW} {o.POPULATION_RANK}")
def experience_global_rank_sliced(spark, sf_dir):
    return gold.experience_global_rank(
        s.population(spark, sf_dir), moment(AS_OF), rows_per_slice=FEW_ROWS
    )


@query("""SELECT row_number() OVER (ORDER BY l_quantity DESC NULLS LAST, l_shipdate NULLS FIRST,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rank,
  l_orderkey, l_linenumber, l_quantity FROM lineitem""")
def global_rank_lineitem(spark, sf_dir):
    """A ranking of the largest table with long ties in its first column."""
    order = [
        "-l_quantity",
        "l_shipdate",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
    ]
    items = table(spark, sf_dir, "lineitem")
    ranked = rank.global_rank(items, order, rows_per_slice=20_000)
    return ranked.select("rank", "l_orderkey", "l_linenumber", "l_quantity")


_SKILLS_RANK = f"""WITH {o.SKILLS_STATE}
SELECT row_number() OVER (PARTITION BY category ORDER BY skill_level DESC NULLS LAST, name, world)
    AS rank, name, world, category AS skill_name, vocation, skill_level,
  {o.AS_OF} AS updated_at, CAST({o.AS_OF} AS DATE) AS snapshot_date
FROM skills_state WHERE is_current"""


@query(_SKILLS_RANK)
def skills_global_rank(spark, sf_dir):
    return gold.skills_global_rank(_skills_table(spark, sf_dir), moment(AS_OF))


@query(_SKILLS_RANK)
def skills_global_rank_sliced(spark, sf_dir):
    return gold.skills_global_rank(
        _skills_table(spark, sf_dir), moment(AS_OF), rows_per_slice=50
    )


@query(f"WITH {o.SUMMARY} SELECT * FROM summary")
def world_summary(spark, sf_dir):
    return gold.world_summary(s.population(spark, sf_dir), moment(AS_OF))


_PLAYER_PROGRESSION = f"""WITH {o.VOCATION_STATE}, {o.progression("vocation_state")}
SELECT * FROM progression"""


@query(_PLAYER_PROGRESSION)
def player_progression(spark, sf_dir):
    return gold.player_progression(_vocation_table(spark, sf_dir), moment(AS_OF))


_ORDER_PROGRESSION = f"""WITH {o.ORDER_VERSIONS}, {o.progression("order_versions")}
SELECT * FROM progression"""


@query(_ORDER_PROGRESSION)
def order_progression(spark, sf_dir):
    return gold.player_progression(s.order_versions(spark, sf_dir), moment(AS_OF))


@query(_ORDER_PROGRESSION.replace("'customer ' || o_custkey AS name", "o_orderstatus AS name"))
def order_progression_sliced(spark, sf_dir):
    """Three names only, each with a third of all orders."""
    versions = s.order_versions(spark, sf_dir).withColumn("name", F.col("world_type"))
    return gold.player_progression(versions, moment(AS_OF), rows_per_slice=FEW_ROWS)


_SKILLS_PROGRESSION = f"WITH {o.SKILLS_STATE}, {o.SKILLS_PROGRESSION} SELECT * FROM progression"


@query(_SKILLS_PROGRESSION)
def skills_progression(spark, sf_dir):
    return gold.skills_progression(_skills_table(spark, sf_dir), moment(AS_OF))


# --- reads, filters and figures -----------------------------------------------


@query(f"WITH {o.SNAPSHOTS} SELECT * FROM snapshots")
def rank_snapshots(spark, sf_dir):
    return views.experience_rank_rows(_snapshot_table(spark, sf_dir))


@query(f"WITH {o.SNAPSHOTS} SELECT * FROM snapshots WHERE snapshot_date = DATE '2024-01-20'")
def rank_snapshot_day(spark, sf_dir):
    return views.experience_rank_rows(_snapshot_table(spark, sf_dir), "2024-01-20 10:00:00")


@query(f"WITH {o.SKILL_SNAPSHOTS} SELECT * FROM snapshots")
def skill_snapshots(spark, sf_dir):
    return views.skills_rank_rows(_skill_snapshot_table(spark, sf_dir))


@query(f"WITH {o.SKILL_SNAPSHOTS} SELECT * FROM snapshots WHERE snapshot_date = DATE '2024-01-20'")
def skill_snapshot_day(spark, sf_dir):
    return views.skills_rank_rows(_skill_snapshot_table(spark, sf_dir), date(2024, 1, 20))


@query(f"""WITH {o.SNAPSHOTS} SELECT * FROM snapshots
WHERE snapshot_date = (SELECT max(snapshot_date) FROM snapshots) AND rank <= 100
  AND world_type IN ('type 1', 'type 2', 'type 4') AND vocation IN ('click', 'view')
  AND contains(lower(name), 'er 1')""")
def ranking_view(spark, sf_dir):
    return views.ranking_view(
        _snapshot_table(spark, sf_dir),
        top=100,
        world_types=["Type 1", "Type 2", "Type 4"],
        vocations=["Click", "View"],
        text="ER 1",
    )


@query(f"""WITH {o.SNAPSHOTS} SELECT * FROM snapshots
WHERE snapshot_date = DATE '2024-01-20' AND rank <= 1000 AND world = 'world 3'
  AND regexp_matches(name, 'player [1-4]+2$')""")
def ranking_view_regex(spark, sf_dir):
    return views.ranking_view(
        _snapshot_table(spark, sf_dir),
        top=1000,
        snapshot="2024-01-20",
        world="World 3",
        text="Player [1-4]+2$",
        regex=True,
    )


@query(f"""WITH {o.SNAPSHOTS} SELECT count(*) AS players, max(level) AS max_level,
  min(level) AS min_level, count(DISTINCT world) AS worlds, max(updated_at) AS last_update,
  max(experience) AS max_experience
FROM snapshots WHERE snapshot_date = DATE '2024-01-20' AND rank <= 50""")
def ranking_kpis(spark, sf_dir):
    view = views.ranking_view(_snapshot_table(spark, sf_dir), top=50, snapshot="2024-01-20")
    return views.ranking_kpis(view)


_SKILL_VIEW = f"""WITH {o.SKILL_SNAPSHOTS}, chosen AS (SELECT * FROM snapshots
WHERE snapshot_date = (SELECT max(snapshot_date) FROM snapshots) AND rank <= 100
  AND skill_name = 'purchase')"""


@query(f"{_SKILL_VIEW} SELECT * FROM chosen")
def skill_ranking_view(spark, sf_dir):
    return views.ranking_view(_skill_snapshot_table(spark, sf_dir), top=100, skill="Purchase")


@query(f"""{_SKILL_VIEW} SELECT count(*) AS players, max(skill_level) AS max_skill_level,
  min(skill_level) AS min_skill_level, count(DISTINCT world) AS worlds,
  max(updated_at) AS last_update FROM chosen""")
def skill_ranking_kpis(spark, sf_dir):
    view = views.ranking_view(_skill_snapshot_table(spark, sf_dir), top=100, skill="Purchase")
    return views.ranking_kpis(view, "skill_level")


@query(f"""WITH {o.SNAPSHOTS} SELECT rank, name,
  upper(world[1]) || world[2:] AS world, upper(vocation[1]) || vocation[2:] AS vocation, level,
  format('{{:,.2f}}', CAST(experience AS DOUBLE)) AS experience,
  upper(world_type[1]) || world_type[2:] AS world_type,
  strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM snapshots WHERE snapshot_date = DATE '2024-01-20' AND rank <= 500""")
def ranking_display(spark, sf_dir):
    view = views.ranking_view(_snapshot_table(spark, sf_dir), top=500, snapshot="2024-01-20")
    return views.ranking_display(view)


@query(f"""{_SKILL_VIEW} SELECT rank, name, upper(world[1]) || world[2:] AS world,
  upper(vocation[1]) || vocation[2:] AS vocation, skill_level,
  strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM chosen""")
def skill_ranking_display(spark, sf_dir):
    view = views.ranking_view(_skill_snapshot_table(spark, sf_dir), top=100, skill="Purchase")
    return views.ranking_display(view)


def _titled(column: str) -> str:
    words = f"[upper(x[1]) || lower(x[2:]) for x in string_split({column}, ' ')]"
    return f"array_to_string({words}, ' ') AS {column}"


@query(f"""WITH {o.SUMMARY} SELECT {_titled("world")}, {_titled("world_type")},
  {_titled("vocation")}, players_count,
  strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM summary""")
def summary_display(spark, sf_dir):
    summary = gold.world_summary(s.population(spark, sf_dir), moment(AS_OF))
    return views.summary_display(views.summary_view(summary))


_AMOUNT = "format('{{:,.2f}}', CAST({0} AS DOUBLE)) AS {0}"
_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"


@query(f"""WITH {o.VOCATION_STATE}, {o.progression("vocation_state")}
SELECT previous_level, current_level, level_gain, {_AMOUNT.format("experience_gain")},
  {_AMOUNT.format("avg_xp_per_day")}, days_between_updates,
  {_TIME.format("previous_start_date")}, {_TIME.format("current_start_date")} FROM progression""")
def progression_display(spark, sf_dir):
    progression = gold.player_progression(_vocation_table(spark, sf_dir), moment(AS_OF))
    return views.progression_display(progression)


@query(f"""WITH {o.SKILLS_STATE}, {o.SKILLS_PROGRESSION}
SELECT category, skill_before, skill_after, {_AMOUNT.format("skill_gain")},
  days_between_updates, {_AMOUNT.format("avg_skill_per_day")}, {_TIME.format("from_date")},
  {_TIME.format("to_date")} FROM progression""")
def skill_progression_display(spark, sf_dir):
    progression = gold.skills_progression(_skills_table(spark, sf_dir), moment(AS_OF))
    return views.progression_display(progression)


@query("""SELECT event_id, format('{:,.2f}', value) AS amount,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown FROM events""")
def display_format(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", show_amount("value").alias("amount"), show_timestamp("ts").alias("shown")
    )


@query(f"""WITH {o.RAW} SELECT row_number() OVER (ORDER BY level DESC NULLS LAST,
  experience DESC NULLS LAST, name) AS rank, name, level, experience FROM raw
QUALIFY rank <= 1000""")
def top_players(spark, sf_dir):
    people = s.population(spark, sf_dir).select("name", "level", "experience")
    return rank.top_n(people, ["-level", "-experience", "name"], 1000)


@query(f"""WITH {o.SUMMARY} SELECT * FROM summary
WHERE lower(world_type) IN ('asia', 'europe') AND vocation IN ('building', 'machinery')""")
def summary_view(spark, sf_dir):
    summary = gold.world_summary(s.population(spark, sf_dir), moment(AS_OF))
    return views.summary_view(
        summary, world_types=["Asia", "Europe"], vocations=["Building", "Machinery"]
    )


@query(f"""WITH {o.SUMMARY} SELECT world, CAST(sum(players_count) AS BIGINT) AS players_count
FROM summary GROUP BY world""")
def distribution_by_world(spark, sf_dir):
    summary = gold.world_summary(s.population(spark, sf_dir), moment(AS_OF))
    return views.distribution(summary, "world")


@query(f"""WITH {o.SUMMARY} SELECT vocation, CAST(sum(players_count) AS BIGINT) AS players_count
FROM summary GROUP BY vocation""")
def distribution_by_vocation(spark, sf_dir):
    summary = gold.world_summary(s.population(spark, sf_dir), moment(AS_OF))
    return views.distribution(summary, "vocation")


@query(f"""WITH {o.SUMMARY} SELECT CAST(sum(players_count) AS BIGINT) AS total_players,
  count(DISTINCT world) AS worlds, count(DISTINCT vocation) AS vocations,
  max(updated_at) AS last_update FROM summary""")
def distribution_kpis(spark, sf_dir):
    summary = gold.world_summary(s.population(spark, sf_dir), moment(AS_OF))
    return views.distribution_kpis(summary)


_MEAN = "CAST(sum(CAST(round({0} * 100) AS BIGINT)) AS DOUBLE) / (100 * count({0}))"


@query(f"""WITH {o.ORDER_VERSIONS}, {o.progression("order_versions")}
SELECT name, arg_max(current_level, (current_start_date, world)) AS current_level,
  arg_max(world, (current_start_date, world)) AS world,
  arg_max(vocation, (current_start_date, world)) AS vocation,
  arg_max(world_type, (current_start_date, world)) AS world_type,
  CAST(sum(experience_gain) AS BIGINT) AS total_experience_gain,
  round({_MEAN.format("avg_xp_per_day")}, 1) AS avg_xp_per_day,
  CAST(sum(days_between_updates) AS BIGINT) AS days_monitored
FROM progression GROUP BY name""")
def progression_kpis(spark, sf_dir):
    versions = s.order_versions(spark, sf_dir)
    figures = views.progression_kpis(gold.player_progression(versions, moment(AS_OF)))
    return figures.withColumn("avg_xp_per_day", F.round("avg_xp_per_day", 1))


@query(f"""WITH {o.SKILLS_STATE}, {o.SKILLS_PROGRESSION}
SELECT name, category, max(skill_after) AS current_skill,
  arg_max(world, (to_date, world)) AS world, arg_max(vocation, (to_date, world)) AS vocation,
  CAST(sum(skill_gain) AS BIGINT) AS total_skill_gain,
  CAST({o.rounded_rate("cents", "(100 * n)")} AS DOUBLE) AS avg_skill_per_day,
  CAST(sum(days_between_updates) AS BIGINT) AS days_monitored
FROM (SELECT *, sum(CAST(round(avg_skill_per_day * 100) AS BIGINT)) OVER w AS cents,
  count(avg_skill_per_day) OVER w AS n FROM progression WINDOW w AS (PARTITION BY name, category))
GROUP BY name, category, cents, n""")
def skill_kpis(spark, sf_dir):
    progression = gold.skills_progression(_skills_table(spark, sf_dir), moment(AS_OF))
    return views.skill_kpis(progression, ["name", "category"])


@query(f"{_PLAYER_PROGRESSION} WHERE name = 'player 7'")
def player_history(spark, sf_dir):
    progression = gold.player_progression(_vocation_table(spark, sf_dir), moment(AS_OF))
    return views.player_history(progression, "player 7")


@query(f"{_SKILLS_PROGRESSION} WHERE name = 'player 7'")
def skill_history(spark, sf_dir):
    progression = gold.skills_progression(_skills_table(spark, sf_dir), moment(AS_OF))
    return views.player_history(progression, "player 7")


@query(f"""WITH {o.SKILLS_STATE}, {o.SKILLS_PROGRESSION} SELECT DISTINCT name FROM progression
WHERE vocation = 'vocation 3' AND category = 'view' AND contains(name, 'r 1')""")
def find_players(spark, sf_dir):
    progression = gold.skills_progression(_skills_table(spark, sf_dir), moment(AS_OF))
    found = views.find_players(
        progression, vocation="Vocation 3", category="view", text="R 1"
    )
    return views.filter_options(found, "name")


@query(f"""WITH {o.DAILY_VOCATION} SELECT day, name, world, vocation FROM daily_vocation
WHERE contains(lower(name), 'yer 1')""")
def find_by_name(spark, sf_dir):
    """Rows of all names that hold a text, from postings written in two loads."""
    daily = _stored(s.daily_vocation(spark, sf_dir), "daily")
    index = NameIndex(spark, scratch_path(spark, "names"))
    index.add(daily.filter(F.col("day") < moment(MIDDLE)))
    index.add(daily)
    return _plain(index.rows(daily.select("day", "name", "world", "vocation"), " YER 1"))


@query("SELECT CAST(ts AS DATE) AS snapshot_date, count(*) AS rows FROM events GROUP BY ALL")
def snapshot_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("snapshot_date", F.to_date("ts"))
    return views.counts_by(events, "snapshot_date")


@query("SELECT event_type AS category, count(*) AS rows FROM events GROUP BY ALL")
def category_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "category")
    return views.counts_by(events, "category")


@query("""SELECT row_number() OVER (ORDER BY day DESC) AS position, day AS snapshot_date
FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)""")
def filter_options_in_order(spark, sf_dir):
    """The days to choose from, newest first."""
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("snapshot_date"))
    return _positioned(views.filter_options(days, "snapshot_date", newest_first=True))


@query(f"""WITH {o.SNAPSHOTS} SELECT row_number() OVER (ORDER BY rank) AS position, rank, name
FROM snapshots WHERE snapshot_date = (SELECT max(snapshot_date) FROM snapshots) AND rank <= 200
  AND vocation = 'click'""")
def ranking_view_in_order(spark, sf_dir):
    """The newest ranking of a vocation, best first."""
    view = views.ranking_view(_snapshot_table(spark, sf_dir), top=200, vocations=["click"])
    return _positioned(view).select("position", "rank", "name")


@query(f"""WITH {o.SUMMARY} SELECT world, players_count,
  row_number() OVER (ORDER BY players_count DESC, world) AS position
FROM (SELECT world, CAST(sum(players_count) AS BIGINT) AS players_count FROM summary GROUP BY world)""")
def distribution_in_order(spark, sf_dir):
    """Worlds by their players, most first."""
    return _positioned(views.distribution(gold.world_summary(s.population(spark, sf_dir), moment(AS_OF)), "world"))


@query(f"""WITH {o.VOCATION_STATE} SELECT start_date, level, experience,
  row_number() OVER (ORDER BY start_date, world) AS position
FROM vocation_state WHERE name = 'player 7'""")
def versions_in_order(spark, sf_dir):
    """Versions of one player as time goes on."""
    state = s.vocation_state(spark, sf_dir).withColumn("to_date", F.col("start_date"))
    history = _positioned(views.player_history(state, "player 7"))
    return history.select("position", "start_date", "level", "experience")


@query("SELECT DISTINCT CAST(ts AS DATE) AS snapshot_date FROM events")
def filter_options(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("snapshot_date", F.to_date("ts"))
    return views.filter_options(events, "snapshot_date", newest_first=True)


# --- pages --------------------------------------------------------------------


@query("""SELECT page_id, CAST(i AS INTEGER) AS row_no, items[i] AS item
FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '<nav>.*?</nav>'),
    '<li><a[^>]*>([^<]*)</a></li>', 1) AS items FROM pages) t,
  unnest(range(1, len(items) + 1)) AS r(i)""")
def page_rows(spark, sf_dir):
    rows = pages.extract_rows(table(spark, sf_dir, "pages"), pages.NAVIGATION_LIST)
    return rows.select("page_id", "row_no", F.get("cells", F.lit(0)).alias("item"))


_TAGS = "CASE r_regionkey " + " ".join(
    f"WHEN {number} THEN '{label}'" for label, number in WORLD_TYPES.items()
) + " END"


def _page_table(spark, sf_dir):
    found = pages.extract_rows(s.ranking_pages(spark, sf_dir), pages.RANKING_TABLE, ["url"])
    named = pages.cells_as_columns(found, EXPERIENCE_HEADER[:-1])
    return pages.tag_group(named, "url", "worldtypes[]", WORLD_TYPES, "WorldType")


@query(f"""SELECT CAST(c_custkey + 1 AS VARCHAR) AS "Rank", c_name AS "Name",
  c_mktsegment AS "Vocation", n_name AS "World",
  CASE WHEN c_acctbal < 500 THEN 'n/a' ELSE CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR)
  END AS "Level", format('{{:,}}', CAST(floor(c_acctbal * 100) AS BIGINT)) AS "Points",
  {_TAGS} AS "WorldType"
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def ranking_page_rows(spark, sf_dir):
    return _page_table(spark, sf_dir).drop("url", "row_no")


@query(f"WITH {o.RAW} {o.POPULATION_RANK}".replace(
    "r_name AS world_type", f"{_TAGS} AS world_type"))
def rank_from_pages(spark, sf_dir):
    """From saved pages to the ranking mart."""
    loaded = bronze.bronze_vocation(_page_table(spark, sf_dir), "pages", moment(AS_OF))
    state = scd2.scd2_open(_stored(loaded, "bronze"), VOCATION.tracked, moment(AS_OF))
    return gold.experience_global_rank(state, moment(AS_OF))


@query("""SELECT page_id, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS origin,
  CASE WHEN regexp_matches(url, '[?&]page=2(&|#|$)') THEN 'second' END AS part FROM pages""")
def page_groups(spark, sf_dir):
    found = table(spark, sf_dir, "pages")
    tagged = pages.tag_group(found, "url", "page", {"first": 1, "second": 2}, "part")
    origin = pages.url_parameter("url", "utm_source")
    return tagged.select("page_id", origin.alias("origin"), "part")


@query("""SELECT event_id, event_type FROM events
WHERE event_type NOT IN ('view', 'click', 'purchase')""")
def unknown_categories(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return unknown_values(events, "event_type", ["view", "click", "purchase"])


def _values(rows) -> str:
    return ", ".join(f"({', '.join(map(repr, row))})" for row in rows)


_DIMENSIONS = f"""category(category_key, category_id, label, vocation_id, domain) AS (
  SELECT key, id, replace(label, '`', chr(39)), vocation, domain FROM (VALUES {_values(
      (key, number, label.replace("'", "`"), vocation, category_domain(key))
      for key, (number, label, vocation) in CATEGORIES.items()
  )}) AS t(key, id, label, vocation, domain)),
vocation(vocation_key, vocation_id) AS (VALUES {_values(VOCATIONS.items())})"""


@query(f"""WITH {_DIMENSIONS} SELECT event_id, category_id, category_key, label, domain,
  vocation_id, vocation_key
FROM (SELECT event_id, CAST(user_id % 17 AS INTEGER) AS category_id FROM events)
LEFT JOIN category USING (category_id) LEFT JOIN vocation USING (vocation_id)""")
def dimension_labels(spark, sf_dir):
    """Category numbers to their category and its vocation; unknown numbers stay, unlabelled."""
    events = table(spark, sf_dir, "events").select(
        "event_id", (F.col("user_id") % 17).cast("int").alias("category_id")
    )
    labelled = with_dimension(events, dim_category(spark), "category_id")
    return with_dimension(labelled, dim_vocation(spark), "vocation_id")


@query(f"""WITH world_type(world_type, world_type_id) AS (VALUES {_values(WORLD_TYPES.items())})
SELECT c_custkey, world_type_id, world_type
FROM (SELECT c_custkey, CAST(c_nationkey % 7 AS INTEGER) AS world_type_id FROM customer)
LEFT JOIN world_type USING (world_type_id)""")
def world_type_labels(spark, sf_dir):
    """World type numbers to their names; unknown numbers stay, unlabelled."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_nationkey") % 7).cast("int").alias("world_type_id")
    )
    return with_dimension(customers, dim_world_type(spark), "world_type_id")


@query(f"""WITH {_DIMENSIONS} SELECT event_id, category_key FROM (
  SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'fishing' ELSE event_type END AS category_key
  FROM events) WHERE category_key NOT IN (SELECT category_key FROM category)""")
def categories_to_add(spark, sf_dir):
    """Rows whose category the dimension does not know."""
    key = F.when(F.col("user_id") % 3 == 0, "fishing").otherwise(F.col("event_type"))
    events = table(spark, sf_dir, "events").select("event_id", key.alias("category_key"))
    return unknown_values(events, "category_key", list(CATEGORIES))


# --- storage ------------------------------------------------------------------

MIDNIGHT = datetime(2024, 2, 1)


def _daily_text(spark, sf_dir):
    """Daily observations as the text of experience files, with their day."""
    return s.daily_vocation(spark, sf_dir).select(
        F.lit("1").alias("Rank"),
        F.col("name").alias("Name"),
        F.col("vocation").alias("Vocation"),
        F.col("world").alias("World"),
        F.col("level").cast("string").alias("Level"),
        F.format_number("experience", 0).alias("Points"),
        F.col("world_type").alias("WorldType"),
        "day",
    )


def _land(df, root, at=MIDNIGHT):
    return landing.write_landing(
        df, root, "experience", F.col("Vocation"), F.col("day"), at, EXPERIENCE_HEADER
    )


_DAILY_TEXT = f"""WITH {o.DAILY_VOCATION} SELECT '1' AS "Rank", name AS "Name",
  vocation AS "Vocation", world AS "World", CAST(level AS VARCHAR) AS "Level",
  format('{{:,}}', experience) AS "Points", world_type AS "WorldType",
  CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
  CAST(day(day) AS INTEGER) AS day, '000000' AS landing_run
FROM daily_vocation"""


@query(_DAILY_TEXT)
def landing_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "landing")
    _land(_daily_text(spark, sf_dir), root)
    return landing.read_landing(spark, root, "experience").drop("source_file")


@query(f"{_DAILY_TEXT} WHERE day = TIMESTAMP '2024-01-20'")
def landing_day(spark, sf_dir):
    root = scratch_path(spark, "landing")
    _land(_daily_text(spark, sf_dir), root)
    return landing.read_landing(spark, root, "experience", date(2024, 1, 20)).drop("source_file")


@query(f"""WITH {o.DAILY_VOCATION}
SELECT strftime(day, 'year=%Y/month=%m/day=%d/dataset=') || vocation || '/run=000000' AS folder,
  count(*) AS rows FROM daily_vocation GROUP BY ALL""")
def landed_folders(spark, sf_dir):
    """Rows by the folder of their file, from the file that each row names."""
    root = scratch_path(spark, "landing")
    _land(_daily_text(spark, sf_dir), root)
    rows = landing.read_landing(spark, root, "experience")
    folder = F.regexp_extract("source_file", "/experience/(.*)/[^/]+$", 1).alias("folder")
    return rows.groupBy(folder).agg(F.count(F.lit(1)).alias("rows"))


_EXTRA_TEXT = ["Name", "Vocation", "World", "Category"]
_EXTRA_VERSION = [*EXTRA.keys, *EXTRA.tracked, *scd2.VERSION_COLUMNS]


def _land_extra(observed, root, part=None):
    """Extra rankings as files with two headers; ``observed`` is a stored table."""
    daily = observed.select(
        *[F.col(c.lower()).alias(c) for c in _EXTRA_TEXT],
        F.col("title").alias("Title"),
        F.format_number("points", 0).alias("Points"),
        F.format_number("points", 0).alias("Score"),
        "day",
    )
    if part is not None:
        daily = daily.filter(part)
    titled = F.col("Title").isNotNull()
    for rows, dataset, columns in (
        (daily.filter(titled), "titled", ["Title", "Points", *_EXTRA_TEXT]),
        (daily.filter(~titled), "plain", [*_EXTRA_TEXT, "Score"]),
    ):
        landing.write_landing(rows, root, "extra", dataset, F.col("day"), MIDNIGHT, columns)


@query(f"WITH {o.EXTRA_STATE} SELECT * FROM extra_state")
def extra_from_files(spark, sf_dir):
    """From files with two headers to bronze rows and the versions of their keys."""
    root = scratch_path(spark, "landing")
    _land_extra(_stored(s.daily_extra(spark, sf_dir), "daily"), root)
    raw = landing.read_heterogeneous_csv(
        spark,
        f"{root}/extra/year=*/month=*/day=*/*/*",
        {**bronze.EXTRA_COLUMNS, "year": "int", "month": "int", "day": "int"},
        bronze.SYNONYMS,
        base=f"{root}/extra",
    )
    batches = bronze.bronze_extra(raw.withColumn("landed", landed_at()), "all", "landed")
    batches = _stored(batches, "bronze")
    versions = scd2.scd2_from_batches(batches, EXTRA.keys, EXTRA.tracked, "ingestion_time")
    return _plain(versions.select(*_EXTRA_VERSION))


@query("""SELECT 'landing' AS layer, event_type AS subcategory, 'SUCCESS' AS status,
  count(*) AS rows, 3 AS columns, 'skills' AS entity
FROM events GROUP BY event_type""")
def load_log(spark, sf_dir):
    """One write and one record per event type."""
    root, log = scratch_path(spark, "landing"), scratch_path(spark, "log")
    events = table(spark, sf_dir, "events")
    kinds = [r[0] for r in events.select("event_type").distinct().orderBy("event_type").collect()]
    for kind in kinds:
        rows = events.filter(F.col("event_type") == kind)
        rows = rows.select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
        written = landing.write_landing(
            rows, root, "skills", kind, F.col("day"), MIDNIGHT, ["event_id", "user_id", "value"]
        )
        landing.log_load(spark, log, written, "highscores", "skills", kind, MIDNIGHT)
    return landing.load_history(spark, log).select(
        "layer", "entity", "subcategory", "status", "rows", F.size("columns").alias("columns")
    )


@query("""SELECT c_name AS name, c_mktsegment AS category, CAST(NULL AS VARCHAR) AS title,
  CAST(c_custkey AS VARCHAR) AS points FROM customer
UNION ALL
SELECT s_name, 'supplier', 'nation ' || s_nationkey, CAST(s_suppkey AS VARCHAR) FROM supplier""")
def heterogeneous_csv(spark, sf_dir):
    """Two headers in one folder: score and title in different places."""
    root = scratch_path(spark, "extra")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Rank"),
        F.col("c_name").alias("Name"),
        F.col("c_custkey").alias("Score"),
        F.col("c_mktsegment").alias("Category"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("Title"),
        F.col("s_suppkey").alias("Points"),
        F.lit("supplier").alias("Category"),
        F.col("s_name").alias("Name"),
    )
    day = date(2024, 1, 31)
    landing.write_landing(customer, root, "extra", "boss", F.lit(day), MIDNIGHT)
    landing.write_landing(supplier, root, "extra", "charm", F.lit(day), MIDNIGHT)
    columns = ["name", "category", "title", "points"]
    return landing.read_heterogeneous_csv(
        spark,
        f"{root}/extra/year=2024/month=01/day=31/*/*",
        {c: "string" for c in columns},
        bronze.SYNONYMS,
    ).select(*columns)


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM events")
def export_csv(spark, sf_dir):
    path = scratch_path(spark, "export")
    landing.export_csv(table(spark, sf_dir, "events").select("event_id", "event_type"), path)
    return spark.read.option("header", True).csv(path)


def _new_table(spark, columns: str, by: str) -> str:
    name = f"rankmart_{uuid4().hex}"
    place = scratch_path(spark, "table")
    part = f"PARTITIONED BY ({by})" if by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {part} LOCATION '{place}'")
    return name


_RANK_TABLE = """rank bigint, name string, world string, vocation string, level int,
    experience bigint, world_type string, updated_at timestamp_ntz, snapshot_date date"""


@query(f"WITH {o.SNAPSHOTS} SELECT * FROM snapshots")
def append_batches(spark, sf_dir):
    """The first and the second half of the month as two loads of one table."""
    name = _new_table(spark, _RANK_TABLE, "snapshot_date")
    mart = s.snapshots(spark, sf_dir)
    tables.append_batch(mart.filter(F.col("updated_at") < moment(MIDDLE)), name)
    tables.append_batch(mart.filter(F.col("updated_at") >= moment(MIDDLE)), name)
    return spark.table(name)


@query(f"""WITH {o.SNAPSHOTS} SELECT * FROM snapshots
WHERE snapshot_date = DATE '2024-01-20' AND rank <= 25""")
def first_ranks(spark, sf_dir):
    """The first ranks of a day, from a mart that lies by rank."""
    name = _new_table(spark, _RANK_TABLE, "snapshot_date")
    tables.overwrite_partitions(s.snapshots(spark, sf_dir), name, within=["rank", "name"])
    return views.ranking_view(spark.table(name), top=25, snapshot="2024-01-20")


@query(f"""WITH {o.SNAPSHOTS} SELECT * REPLACE (
  CASE WHEN snapshot_date = (SELECT max(snapshot_date) FROM snapshots) THEN upper(vocation)
    ELSE vocation END AS vocation)
FROM snapshots""")
def overwrite_partitions(spark, sf_dir):
    """All days, then the last day again: other days stay."""
    name = _new_table(spark, _RANK_TABLE, "snapshot_date")
    mart = s.snapshots(spark, sf_dir)
    tables.overwrite_partitions(mart, name)
    last = views.latest_snapshot(mart)
    tables.overwrite_partitions(last.withColumn("vocation", F.upper("vocation")), name)
    return spark.table(name)


@query(f"""WITH {o.SUMMARY} SELECT * REPLACE (CAST(2 * players_count AS BIGINT) AS players_count)
FROM summary""")
def replace_table(spark, sf_dir):
    """A table replaced from a query on itself."""
    name, path = f"rankmart_{uuid4().hex}", scratch_path(spark, "mart")
    summary = gold.world_summary(s.population(spark, sf_dir), moment(AS_OF))
    tables.replace_table(summary, name, path)
    doubled = views.read_world_summary(spark, name)
    doubled = doubled.withColumn("players_count", 2 * F.col("players_count"))
    tables.replace_table(doubled, name, path)
    return spark.table(name)


@query("""SELECT o_orderkey, o_orderdate AS updated_at, CAST(o_orderdate AS DATE) AS snapshot_date,
  CAST(NULL AS VARCHAR) AS note FROM orders""")
def backfill_and_evolve(spark, sf_dir):
    """Add columns to a table, fill one from another, drop a third."""
    name, path = f"rankmart_{uuid4().hex}", scratch_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("updated_at"), "o_orderstatus"
    )
    tables.replace_table(orders, name, path)
    tables.evolve_table(spark, name, path, add={"snapshot_date": "date", "note": "string"})
    tables.backfill_table(spark, name, "snapshot_date", F.to_date("updated_at"), path)
    tables.evolve_table(spark, name, path, drop=["o_orderstatus"])
    return spark.table(name)


@query(f"""{_SKILLS_PROGRESSION.replace("SELECT * FROM", "SELECT * EXCLUDE (updated_at) FROM")}""")
def mart_tables(spark, sf_dir):
    """All five marts written from two states, twice the same day, and one read back."""
    prefix, place = f"rankmart_{uuid4().hex}_", scratch_path(spark, "marts")
    tables.create_all(spark, prefix, place)
    vocation = _vocation_table(spark, sf_dir)
    skills = _skills_table(spark, sf_dir)
    for _ in range(2):
        names = refresh_marts(vocation, skills, moment(AS_OF), place, f"{prefix}gold")
    return views.read_skills_progression(spark, names["skills_progression"])


@query(_PLAYER_PROGRESSION.replace("SELECT * FROM prog", "SELECT * EXCLUDE (updated_at) FROM prog"))
def player_progression_table(spark, sf_dir):
    """The progression mart replaced twice, then read."""
    name, path = f"rankmart_{uuid4().hex}", scratch_path(spark, "mart")
    vocation = _vocation_table(spark, sf_dir)
    for _ in range(2):
        tables.replace_table(gold.player_progression(vocation, moment(AS_OF)), name, path)
    return views.read_player_progression(spark, name)


def _silver_rows(daily: DataFrame) -> DataFrame:
    return daily.withColumn("ingestion_time", F.col("day").cast("timestamp"))


@query(_VOCATION_STATE)
def history_apply(spark, sf_dir):
    """Stored history: most days at once, the last day as a batch, and that once more."""
    history = VOCATION.history(spark, scratch_path(spark, "history"))
    daily = _silver_rows(s.daily_vocation(spark, sf_dir))
    before, last, end = _before_and_last(daily)
    history.catch_up(before, "ingestion_time")
    history.apply(last, end)
    history.apply(last, end)
    return _plain(history.state().drop("ingestion_time"))


@query(f"""WITH {o.VOCATION_STATE}
SELECT CAST(2 AS BIGINT) AS version, count(*) FILTER (is_current) AS current_rows,
  count(*) FILTER (NOT is_current AND end_date = (SELECT max(day) FROM daily_vocation))
    AS closed_rows
FROM vocation_state""")
def history_commits(spark, sf_dir):
    """What the second of two loads left: told by the versions themselves."""
    history = VOCATION.history(spark, scratch_path(spark, "history"))
    before, last, end = _before_and_last(_silver_rows(s.daily_vocation(spark, sf_dir)))
    history.catch_up(before, "ingestion_time")
    history.apply(last, end)
    latest = history.loads().filter(F.col("at") == F.lit(end))
    return latest.select(F.lit(2).cast("long").alias("version"), "current_rows", "closed_rows")


@query(f"""WITH {o.VOCATION_STATE}
SELECT start_date AS at, count(*) AS opened_rows,
  (SELECT count(*) FROM vocation_state c WHERE c.end_date = v.start_date) AS closed_rows,
  (SELECT count(*) FROM vocation_state c WHERE c.start_date <= v.start_date
    AND (c.end_date IS NULL OR c.end_date > v.start_date)) AS current_rows
FROM vocation_state v GROUP BY start_date""")
def history_loads(spark, sf_dir):
    """Opened, closed and current versions of every batch of a stored history."""
    history = VOCATION.history(spark, scratch_path(spark, "history"))
    history.catch_up(_silver_rows(s.daily_vocation(spark, sf_dir)), "ingestion_time")
    return _plain(history.loads())


def _late_keys(daily: DataFrame, keys: tuple[str, ...], late: Column) -> DataFrame:
    """All rows of the keys that have late ones."""
    r, t = daily.alias("r"), daily.filter(late).select(*keys).distinct().alias("t")
    return r.join(t, scd2.same_key("r", "t", keys), "left_semi")


@query(_PLAYER_PROGRESSION)
def progression_kept(spark, sf_dir):
    """The progression after three loads of a stored history, the last one taken in twice."""
    history = VOCATION.history(spark, scratch_path(spark, "history"))
    kept = PlayerProgressions(spark, scratch_path(spark, "progressions"))
    daily = _silver_rows(_stored(s.daily_vocation(spark, sf_dir), "daily"))
    before, last, end = _before_and_last(daily)
    early = F.col("day") < moment(MIDDLE)
    for part in (before.filter(early), before.filter(~early), last, last):
        since = part.agg(F.min("ingestion_time")).first()[0]
        if since is None:
            continue
        if part is not last:
            history.catch_up(part, "ingestion_time")
        else:
            history.apply(part, end)
        kept.refresh(history, since)
    return _plain(kept.mart(moment(AS_OF)))


@query(_SKILLS_PROGRESSION)
def skills_progression_kept(spark, sf_dir):
    """The skill progression after the days in the middle came last."""
    history = SKILLS.history(spark, scratch_path(spark, "history"))
    kept = SkillProgressions(spark, scratch_path(spark, "progressions"))
    daily = _silver_rows(_stored(s.daily_skills(spark, sf_dir), "daily"))
    middle = F.dayofmonth("day").between(11, 20)
    for part in (daily.filter(~middle), daily.filter(middle)):
        since = part.agg(F.min("ingestion_time")).first()[0]
        if since is None:
            continue
        if kept.pairs().isEmpty():
            history.catch_up(part, "ingestion_time")
        else:
            history.rewrite(_late_keys(daily, SKILLS.keys, middle), "ingestion_time")
        kept.refresh(history, since)
    return _plain(kept.mart(moment(AS_OF)))


@query(f"""WITH {o.VOCATION_STATE}
SELECT * FROM vocation_state WHERE start_date <= TIMESTAMP '2024-01-15 12:00:00'
  AND (end_date IS NULL OR end_date > TIMESTAMP '2024-01-15 12:00:00')""")
def history_as_of(spark, sf_dir):
    """The stored versions of one moment, from the partitions that can hold them."""
    history = VOCATION.history(spark, scratch_path(spark, "history"))
    history.catch_up(_silver_rows(s.daily_vocation(spark, sf_dir)), "ingestion_time")
    moment_ = datetime(2024, 1, 15, 12)
    return _plain(history.as_of(moment_).drop("ingestion_time"))


@query(_VOCATION_STATE)
def incremental_ingest(spark, sf_dir):
    """Files of half a month arrive, then the rest; each run takes what is new."""
    root, place = scratch_path(spark, "landing"), scratch_path(spark, "ingest")
    text = _daily_text(spark, sf_dir)
    history = None
    for part in (F.col("day") < moment(MIDDLE), F.col("day") >= moment(MIDDLE)):
        _land(text.filter(part), root)
        history = ingest_available(
            spark, root, "vocation", f"{place}/bronze", f"{place}/silver", f"{place}/checkpoint"
        )
    return _plain(history.state().drop("ingestion_time"))


@query(_VOCATION_STATE)
def late_ingest(spark, sf_dir):
    """The days in the middle arrive last, a few files at a time, and the checkpoint is
    lost before: the history is that of all files in order."""
    root, place = scratch_path(spark, "landing"), scratch_path(spark, "ingest")
    text = _daily_text(spark, sf_dir)
    middle = F.dayofmonth("day").between(11, 20)
    history = None
    for run, part, max_files in ((0, ~middle, None), (1, middle, 16)):
        _land(text.filter(part), root)
        history = ingest_available(
            spark,
            root,
            "vocation",
            f"{place}/bronze",
            f"{place}/silver",
            f"{place}/checkpoint-{run}",
            max_files,
        )
    return _plain(history.state().drop("ingestion_time"))


@query(f"WITH {o.EXTRA_STATE} SELECT * FROM extra_state")
def extra_ingest(spark, sf_dir):
    """Files with two headers as a stream; some days are delivered twice, some arrive last."""
    root, place = scratch_path(spark, "landing"), scratch_path(spark, "ingest")
    daily = _stored(s.daily_extra(spark, sf_dir), "daily")
    number = F.dayofmonth("day")
    history = None
    for part in (number <= 8, number.between(6, 8) | (number >= 19), number.between(9, 18)):
        _land_extra(daily, root, part)
        history = ingest_available(
            spark, root, "extra", f"{place}/bronze", f"{place}/silver", f"{place}/checkpoint"
        )
    return _plain(history.state().select(*_EXTRA_VERSION))


def _seen_events(spark, sf_dir):
    moved = F.when(F.dayofmonth("ts") >= 16, 1).otherwise(0)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("player "), F.col("user_id").cast("string")).alias("name"),
        F.concat(F.lit("world "), ((F.col("user_id") + moved) % 10).cast("string")).alias("world"),
        "event_type",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
    )


@query(f"""WITH {o.VOCATION_STATE}, seen AS (
  SELECT event_id, 'player ' || user_id AS name, event_type, ts,
    'world ' || ((user_id + CASE WHEN day(ts) >= 16 THEN 1 ELSE 0 END) % 10) AS world FROM events)
SELECT seen.event_id, seen.name, seen.world, seen.event_type, seen.ts, v.level, v.experience,
  v.start_date, v.end_date
FROM seen LEFT JOIN vocation_state v ON v.name = seen.name AND v.world = seen.world
  AND v.start_date <= seen.ts AND (v.end_date IS NULL OR v.end_date > seen.ts)""")
def as_of_events(spark, sf_dir):
    """Every event with the player's version at its own time."""
    versions = s.vocation_state(spark, sf_dir)
    columns = ["name", "world", "level", "experience", "start_date", "end_date"]
    return as_of_join(
        _seen_events(spark, sf_dir), versions.select(*columns), ["name", "world"], "ts"
    )


@query("""WITH daily AS (
  SELECT event_type, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, count(*) % 7 AS n FROM events
  GROUP BY ALL),
changes AS (SELECT * FROM (SELECT *, lag(n) OVER w AS before FROM daily
    WINDOW w AS (PARTITION BY event_type ORDER BY day)) WHERE before IS DISTINCT FROM n),
versions AS (SELECT event_type, n, day AS start_date,
    lead(day) OVER (PARTITION BY event_type ORDER BY day) AS end_date FROM changes)
SELECT e.event_id, e.event_type, e.ts, v.n, v.start_date, v.end_date
FROM events e JOIN versions v ON v.event_type = e.event_type AND v.start_date <= e.ts
  AND (v.end_date IS NULL OR v.end_date > e.ts)""")
def as_of_events_sliced(spark, sf_dir):
    """Every event with the version of its type: few keys, cut into slices of time."""
    events = _seen_events(spark, sf_dir).drop("name", "world")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    daily = events.groupBy("event_type", day).agg((F.count(F.lit(1)) % 7).alias("n"))
    versions = scd2.scd2_from_batches(daily, ["event_type"], ["n"], "day")
    return as_of_join(
        events,
        versions.select("event_type", "n", "start_date", "end_date"),
        ["event_type"],
        "ts",
        how="inner",
        rows_per_slice=FEW_ROWS,
    )
