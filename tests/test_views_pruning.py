"""The newest snapshot is read by partition."""

from __future__ import annotations

from rankmart.plans.views import latest_snapshot


def test_the_newest_snapshot_prunes_partitions(spark, tmp_path, rows):
    df = spark.sql("""SELECT id AS rank, date_add(DATE '2024-01-01', int(id % 3)) AS snapshot_date
        FROM range(9)""")
    df.write.partitionBy("snapshot_date").parquet(str(tmp_path / "mart"))
    newest = latest_snapshot(spark.read.parquet(str(tmp_path / "mart")))
    assert [r[0] for r in rows(newest, "rank")] == [2, 5, 8]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert "subquery" in plan.split("PartitionFilters:")[1].split("]")[0].lower()
