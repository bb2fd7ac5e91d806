"""Time the headline queries; prints one line of JSON.

``--plain`` times the direct Spark SQL forms instead, for comparison.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from rankmart.queries import standin
from rankmart.queries.catalog import QUERIES
from rankmart.session import local_session

HEADLINES = [
    "bronze_normalize",
    "bronze_skills",
    "bronze_extra",
    "bronze_dedup",
    "scd2_from_batches",
    "scd2_apply",
    "scd2_catch_up",
    "scd2_as_of",
    "experience_global_rank",
    "experience_global_rank_sliced",
    "global_rank_lineitem",
    "skills_global_rank",
    "world_summary",
    "player_progression",
    "order_progression",
    "order_progression_sliced",
    "skills_progression",
    "rank_snapshots",
    "ranking_view",
    "progression_kpis",
    "page_rows",
    "rank_from_pages",
    "landing_roundtrip",
    "overwrite_partitions",
    "history_apply",
]

# The direct statement of an operation, without care for hot keys or order.
PLAIN = {
    "bronze_dedup": None,
    "global_rank_lineitem": """SELECT row_number() OVER (ORDER BY l_quantity DESC, l_shipdate,
        l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rank,
        l_orderkey, l_linenumber, l_quantity FROM lineitem""",
    "experience_global_rank": """SELECT row_number() OVER (
        ORDER BY level DESC, experience DESC, name, world) AS rank, name, world, vocation, level,
        experience, world_type FROM population WHERE is_current""",
    "world_summary": """SELECT world, world_type, vocation, count(DISTINCT name) AS players_count
        FROM population WHERE is_current GROUP BY world, world_type, vocation""",
    "order_progression": """SELECT *, round((experience - before) / greatest(1,
        datediff(to_date(start_date), to_date(previous))), 2) AS rate FROM (SELECT *,
        lag(experience) OVER (PARTITION BY name ORDER BY start_date, world) AS before,
        lag(start_date) OVER (PARTITION BY name ORDER BY start_date, world) AS previous
        FROM orders) WHERE before IS NOT NULL""",
}
PLAIN["order_progression_sliced"] = PLAIN["order_progression"].replace(
    "PARTITION BY name", "PARTITION BY world_type"
)


def plain_form(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "bronze_dedup":
        events = standin.table(spark, sf_dir, "events")
        return events.dropDuplicates(["user_id", "event_type"])
    standin.table(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem")
    standin.population(spark, sf_dir).createOrReplaceTempView("population")
    standin.order_versions(spark, sf_dir).createOrReplaceTempView("orders")
    return spark.sql(PLAIN[name])


def main() -> None:
    plain = "--plain" in sys.argv
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = local_session(cpus, "rankmart bench")
    spark.sparkContext.setLogLevel("ERROR")
    # The first query pays for starting up; its time is not the operators'.
    QUERIES["bronze_dedup"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run = partial(plain_form, spark, sf_dir) if plain else lambda n: QUERIES[n](spark, sf_dir)
    chosen = [a for a in sys.argv[1:] if a != "--plain"] or list(PLAIN if plain else HEADLINES)
    seconds = {}
    for name in chosen:
        times = []
        for _ in range(repeats):
            start = time.perf_counter()
            run(name).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    result = {
        "metric": "plain forms, total time" if plain else "headline queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
