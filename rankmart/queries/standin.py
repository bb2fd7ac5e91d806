"""The driver tables read as ranking data.

Customers are a population with world (nation), world type (region) and vocation
(market segment). Events are daily observations of players: the last event of a day
gives level, experience and vocation, the last of a day and type gives the skill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmart.operators.dedup import dedup
from rankmart.operators.rank import group_rank
from rankmart.operators.scd2 import scd2_from_batches, scd2_open
from rankmart.plans.bronze import bronze_vocation
from rankmart.plans.silver import EXTRA, SKILLS, VOCATION
from rankmart.sources.domain import EXPERIENCE_CATEGORY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


AS_OF = "2024-02-01 06:30:00"


def raw_experience(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the text of an experience ranking file."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    placed = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    level = F.floor(F.col("c_acctbal") / 100).cast("string")
    return placed.select(
        (F.col("c_custkey") + 1).cast("string").alias("Rank"),
        F.col("c_name").alias("Name"),
        F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("Vocation"),
        F.concat("n_name", F.lit(" ")).alias("World"),
        F.when(F.col("c_acctbal") < 500, "n/a").otherwise(level).alias("Level"),
        F.format_number(F.floor(F.col("c_acctbal") * 100), 0).alias("Points"),
        F.col("r_name").alias("WorldType"),
        F.col("r_regionkey").alias("region_number"),
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as current silver versions."""
    bronze = bronze_vocation(raw_experience(spark, sf_dir), "customers", moment(AS_OF))
    return scd2_open(bronze, VOCATION.tracked, moment(AS_OF))


def _player(column: str = "user_id") -> Column:
    return F.concat(F.lit("player "), F.col(column).cast("string"))


def _day() -> Column:
    return F.to_date("ts").cast("timestamp_ntz")


def daily_vocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event per player, world and day; players change world in mid-month."""
    moved = F.when(F.day("ts") >= 16, 1).otherwise(0)
    seen = table(spark, sf_dir, "events").select(
        _player().alias("name"),
        F.concat(F.lit("world "), ((F.col("user_id") + moved) % 10).cast("string")).alias("world"),
        F.col("event_type").alias("vocation"),
        F.floor(F.col("value") / 25).cast("int").alias("level"),
        F.floor(F.col("value") * 100).cast("bigint").alias("experience"),
        F.concat(F.lit("type "), (F.col("user_id") % 5).cast("string")).alias("world_type"),
        _day().alias("day"),
        "ts",
        "event_id",
    )
    return dedup(seen, ["name", "world", "day"], ["ts", "event_id"]).drop("ts", "event_id")


def daily_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event per player, type and day."""
    seen = table(spark, sf_dir, "events").select(
        _player().alias("name"),
        F.concat(F.lit("world "), (F.col("user_id") % 10).cast("string")).alias("world"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("vocation "), (F.col("user_id") % 6).cast("string")).alias("vocation"),
        F.floor(F.col("value") / 25).cast("int").alias("skill_level"),
        _day().alias("day"),
        "ts",
        "event_id",
    )
    return dedup(seen, ["name", "world", "category", "day"], ["ts", "event_id"]).drop(
        "ts", "event_id"
    )


def daily_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event per player, type, title and day; low values have no title."""
    title = F.when(
        F.col("value") >= 20,
        F.concat(F.lit("title "), F.floor(F.col("value") / 50).cast("string")),
    )
    seen = table(spark, sf_dir, "events").select(
        _player().alias("name"),
        F.lit("world").alias("world"),
        F.col("event_type").alias("category"),
        title.alias("title"),
        F.concat(F.lit("vocation "), (F.col("user_id") % 6).cast("string")).alias("vocation"),
        F.floor("value").cast("int").alias("points"),
        _day().alias("day"),
        "ts",
        "event_id",
    )
    keys = ["name", "world", "category", "title", "day"]
    return dedup(seen, keys, ["ts", "event_id"]).drop("ts", "event_id")


def vocation_state(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    daily = daily_vocation(spark, sf_dir)
    state = scd2_from_batches(daily, VOCATION.keys, VOCATION.tracked, "day", **options)
    return state.drop("day")


def skills_state(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    daily = daily_skills(spark, sf_dir)
    return scd2_from_batches(daily, SKILLS.keys, SKILLS.tracked, "day", **options).drop("day")


def extra_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_extra(spark, sf_dir)
    return scd2_from_batches(daily, EXTRA.keys, EXTRA.tracked, "day").drop("day")


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as versions of their customer; the order number breaks ties of a day."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("name"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("world"),
        F.col("o_orderpriority").alias("vocation"),
        F.col("o_orderstatus").alias("world_type"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("level"),
        F.floor(F.col("o_totalprice") * 100).cast("bigint").alias("experience"),
        F.col("o_orderdate").alias("start_date"),
        (F.col("o_orderstatus") == "O").alias("is_current"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily experience ranking mart over all days."""
    daily = daily_vocation(spark, sf_dir).withColumn("snapshot_date", F.to_date("day"))
    order = ["-level", "-experience", "name", "world"]
    return group_rank(daily, ["snapshot_date"], order).select(
        "rank",
        "name",
        "world",
        "vocation",
        "level",
        "experience",
        "world_type",
        F.col("day").alias("updated_at"),
        "snapshot_date",
    )


def skill_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily skill ranking mart over all days."""
    daily = daily_skills(spark, sf_dir).withColumn("snapshot_date", F.to_date("day"))
    ranked = group_rank(
        daily, ["snapshot_date", "category"], ["-skill_level", "name", "world"]
    )
    return ranked.select(
        "rank",
        "name",
        "world",
        F.col("category").alias("skill_name"),
        "vocation",
        "skill_level",
        F.col("day").alias("updated_at"),
        "snapshot_date",
    )


ROWS_PER_PAGE = 50


def ranking_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as saved ranking pages: 50 rows each, one ranking per region."""
    raw = raw_experience(spark, sf_dir).withColumn("number", F.col("Rank").cast("bigint"))
    ranked = group_rank(raw, ["region_number"], ["number"], "place")
    page = F.floor((F.col("place") - 1) / ROWS_PER_PAGE).cast("int")

    def cells(*texts: Column) -> Column:
        tds = [x for t in texts for x in (F.lit("<td>"), t, F.lit("</td>"))]
        return F.concat(F.lit("<tr>"), *tds, F.lit("</tr>"))

    names = ["Rank", "Name", "Vocation", "World", "Level", "Points"]
    lines = ranked.select(
        "region_number", page.alias("page"), "place", cells(*[F.col(n) for n in names]).alias("tr")
    )
    # At most ROWS_PER_PAGE rows per group.
    pages = lines.groupBy("region_number", "page").agg(
        F.array_sort(F.collect_list(F.struct("place", "tr"))).alias("rows")
    )
    html = F.concat(
        F.lit('<!DOCTYPE html><html><body><div><table class="Table3 wide">'),
        F.lit("<tr><td>Ranking</td></tr><tr><td>Filter</td></tr><tr><td>"),
        F.lit('<table class="TableContent">'),
        cells(*[F.lit(n) for n in names]),
        F.array_join(F.col("rows")["tr"], ""),
        F.lit("</table></td></tr></table></div></body></html>"),
    )
    url = F.concat(
        F.lit("https://ranks.example.org/community/?subtopic=ranking&world="),
        F.lit("&worldtypes[]="),
        F.col("region_number").cast("string"),
        F.lit(f"&category={EXPERIENCE_CATEGORY}&currentpage="),
        (F.col("page") + 1).cast("string"),
    )
    return pages.select(url.alias("url"), html.alias("html"))
