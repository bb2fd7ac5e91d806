from __future__ import annotations

from datetime import date, datetime, timedelta
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from rankmart.plans.silver import SKILLS, VOCATION
from rankmart.sources import tables
from rankmart.sources.history import History
from rankmart.sources.domain import EXPERIENCE_HEADER, TABLES
from rankmart.sources.landing import write_landing
from rankmart.operators.dedup import dedup
from rankmart.streaming import ingest
from rankmart.streaming.ingest import ingest_available

AT = [datetime(2024, 1, d, 6) for d in range(1, 8)]


@pytest.fixture
def name():
    return f"t_{uuid4().hex}"


def test_all_tables_are_created_once(spark, tmp_path):
    prefix = f"p{uuid4().hex}_"
    for _ in range(2):
        names = tables.create_all(spark, prefix, str(tmp_path))
    assert len(names) == len(TABLES)
    assert spark.table(f"{prefix}silver.skills").isEmpty()
    assert f"{prefix}gold" in [d.name for d in spark.catalog.listDatabases()]


def test_only_written_partitions_are_replaced(spark, tmp_path, rows, name):
    spark.sql(
        f"CREATE TABLE {name} (v int, d date) USING parquet PARTITIONED BY (d) LOCATION '{tmp_path}'"
    )
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")

    def put(*pairs):
        frame = spark.createDataFrame(list(pairs), "d date, v bigint")
        return tables.overwrite_partitions(frame, name)

    one, two = date(2024, 1, 1), date(2024, 1, 2)
    assert put((one, 1), (one, 2)) == 2
    put((two, 3))
    put((two, 4))
    assert rows(spark.table(name)) == [(1, one), (2, one), (4, two)]
    assert tables.append_batch(spark.createDataFrame([(one, 9)], "d date, v int"), name) == 1
    assert spark.table(name).count() == 4
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_a_filter_on_the_order_of_a_table_passes_over_row_groups(spark, tmp_path, rows, name):
    columns = "rank bigint, name string, day int"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (day) "
              f"LOCATION '{tmp_path}'")
    # Day 1 holds nearly all rows, in no order.
    ranks = spark.range(200_000).select(
        (F.col("id") * 7919 % 200_000 + 1).alias("rank"),
        F.md5(F.col("id").cast("string")).alias("name"),
        F.when(F.col("id") < 50, 2).otherwise(1).alias("day"),
    )
    written = tables.overwrite_partitions(ranks, name, ["rank"], row_group_bytes=256 << 10)
    assert written == 200_000
    assert rows(spark.table(name).groupBy("day").count()) == rows(ranks.groupBy("day").count())
    first = spark.table(name).filter("day = 1 AND rank <= 100")
    expected = ranks.filter("day = 1 AND rank <= 100")
    assert rows(first, "rank", "name") == rows(expected, "rank", "name")
    first.collect()
    scan = first._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() < 200_000 / 8


def test_replace_backfill_and_evolve(spark, tmp_path, rows, name):
    path = str(tmp_path)
    tables.replace_table(spark.createDataFrame([(1, AT[0])], "a int, at timestamp"), name, path)
    tables.evolve_table(spark, name, path, add={"d": "date"})
    assert rows(spark.table(name), "a", "d") == [(1, None)]
    tables.backfill_table(spark, name, "d", F.to_date("at"), path)
    assert rows(spark.table(name), "a", "d") == [(1, date(2024, 1, 1))]
    tables.evolve_table(spark, name, path, drop=["at"])
    assert spark.table(name).columns == ["a", "d"]


def test_replace_with_the_same_columns_moves_the_name(spark, tmp_path, rows, name):
    for value in (1, 2):
        tables.replace_table(spark.createDataFrame([(value,)], "a int"), name, str(tmp_path))
        assert rows(spark.table(name)) == [(value,)]
    doubled = spark.table(name).selectExpr("2 * a AS a")
    tables.replace_table(doubled, name, str(tmp_path))
    assert rows(spark.table(name)) == [(4,)]


def test_partitioned_replace(spark, tmp_path, rows, name):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, p string")
    tables.replace_table(df, name, str(tmp_path), by=["p"])
    assert rows(spark.table(name).filter("p = 'y'"), "a") == [(2,)]


def test_a_reader_finds_every_partition_while_they_are_replaced(
    spark, tmp_path, rows, name, monkeypatch
):
    values = ["01", "x y", "a/b", "it's", "50%", "c=d", "null", None]
    schema = "a int, p string, q int"

    def version(number, kept):
        return spark.createDataFrame([(number, p, 1) for p in kept], schema)

    tables.replace_table(version(1, values), name, str(tmp_path), by=["p", "q"])
    assert rows(spark.table(name), "a", "p") == rows(version(1, values), "a", "p")

    def died(*_):
        raise RuntimeError("died")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(tables, "_point", died)
        tables.replace_table(version(9, values), name, str(tmp_path), by=["p", "q"])
    assert rows(spark.table(name), "a", "p") == rows(version(1, values), "a", "p")

    seen, point = [], tables._point

    def watched(*call):
        point(*call)
        seen.append([tuple(r) for r in spark.table(name).select("p", "a").collect()])

    later = [*values[1:6], "new"]
    monkeypatch.setattr(tables, "_point", watched)
    tables.replace_table(version(2, later), name, str(tmp_path), by=["p", "q"])
    assert len(seen) == len(later) + 3
    for read in seen:
        found = dict(read)
        assert len(found) == len(read) and set(values[1:6]) <= set(found)
        assert set(found.values()) <= {1, 2}
    assert rows(spark.table(name), "a", "p") == rows(version(2, later), "a", "p")
    # Filled in and without a column, it keeps its partitions.
    tables.backfill_table(spark, name, "p", F.lit("none"), str(tmp_path))
    tables.evolve_table(spark, name, str(tmp_path), drop=["q"])
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["p"]
    assert rows(spark.table(name), "a", "p") == rows(version(2, later), "a", "p")
    tables.evolve_table(spark, name, str(tmp_path), add={"q": "int"})
    # From the table itself, to no rows at all.
    tables.replace_table(spark.table(name).filter("a > 5"), name, str(tmp_path), by=["p"])
    assert spark.table(name).isEmpty()


def batch(spark, *players):
    return spark.createDataFrame(
        [(n, "w", "knight", level, 1, "open", AT[0]) for n, level in players],
        """name string, world string, vocation string, level int, experience bigint,
        world_type string, ingestion_time timestamp""",
    )


def spans(state):
    found = state.select("name", "level", "start_date", "end_date", "is_current").collect()
    return sorted((tuple(r) for r in found), key=lambda r: (r[0], r[2]))


def files(root):
    """Every data file below a folder with its time of change."""
    return {str(f): f.stat().st_mtime_ns for f in root.rglob("part-*.parquet")}


def test_stored_history(spark, tmp_path):
    history = VOCATION.history(spark, str(tmp_path))
    assert history.state().isEmpty() and history.loads().isEmpty()
    history.apply(batch(spark, ("a", 1), ("b", 1)), AT[1])
    history.apply(batch(spark, ("a", 2)), AT[2])
    expected = [
        ("a", 1, AT[1], AT[2], False),
        ("a", 2, AT[2], None, True),
        ("b", 1, AT[1], None, True),
    ]
    assert spans(history.state()) == expected
    assert spans(history.current()) == expected[1:]
    assert spans(history.as_of(AT[1])) == [expected[0], expected[2]]
    # A replayed batch changes nothing, a stale one is refused and writes nothing.
    history.apply(batch(spark, ("a", 2)), AT[2])
    before = files(tmp_path)
    with pytest.raises(Exception, match="not later"):
        history.apply(batch(spark, ("a", 9)), AT[1])
    assert files(tmp_path) == before
    assert spans(history.state()) == expected
    assert history.state().schema == VOCATION.schema
    # Another reader finds the same table.
    assert spans(VOCATION.history(spark, str(tmp_path)).state()) == expected
    loads = history.loads().orderBy("at").collect()
    assert [tuple(r) for r in loads] == [(AT[1], 2, 0, 2), (AT[2], 1, 1, 2)]


def test_keys_that_are_missing_can_end(spark, tmp_path, rows):
    history = VOCATION.history(spark, str(tmp_path))
    history.apply(batch(spark, ("a", 1), ("b", 1)), AT[1])
    history.apply(batch(spark, ("b", 1)), AT[2], close_missing=True)
    assert spans(history.state()) == [
        ("a", 1, AT[1], AT[2], False),
        ("b", 1, AT[1], None, True),
    ]
    history.apply(batch(spark).limit(0), AT[3], close_missing=True)
    assert history.current().isEmpty()
    history.apply(batch(spark, ("a", 1)), AT[4])
    assert [(s[0], s[4]) for s in spans(history.state())] == [("a", False), ("a", True), ("b", False)]


def test_catching_up_equals_single_batches(spark, tmp_path):
    single = VOCATION.history(spark, str(tmp_path / "single"))
    at_once = VOCATION.history(spark, str(tmp_path / "at_once"))
    levels = [1, 1, 2, 1, 3]
    for n, level in enumerate(levels):
        players = [("a", level)] + ([("b", 7)] if n == 2 else [])
        single.apply(batch(spark, *players), AT[n])
    at_once.apply(batch(spark, ("a", 1)), AT[0])
    rows = [("a", level, AT[n]) for n, level in enumerate(levels) if n] + [("b", 7, AT[2])]
    timed = None
    for player, level, at in rows:
        one = batch(spark, (player, level)).withColumn("t", F.lit(at))
        timed = one if timed is None else timed.unionByName(one)
    at_once.catch_up(timed, "t")
    assert spans(at_once.state()) == spans(single.state())


def bucket_of(history, player):
    row = history._keyed(batch(history.spark, (player, 0))).first()
    return f"bucket={row['bucket']}/"


def test_only_files_of_touched_buckets_are_replaced(spark, tmp_path):
    history = VOCATION.history(spark, str(tmp_path))
    players = [f"p{k}" for k in range(40)]
    day = timedelta(days=20)
    for n in range(3):
        history.apply(batch(spark, *[(p, n) for p in players]), AT[0] + n * day)
    touched = bucket_of(history, "p7")

    def changed(before, after):
        return {f for f in before.items() ^ after.items()}

    before = files(tmp_path)
    history.apply(batch(spark, ("p7", 9)), AT[0] + 3 * day)
    in_time = files(tmp_path)
    names = {f for f, _ in changed(before, in_time)}
    assert names and all(touched in f for f in names)
    # The month before the batch stays even there.
    assert not any("closed=2024-01" in f for f in names)

    late = batch(spark, ("p7", 0)).withColumn("t", F.lit(AT[0]))
    for n, level in ((1, 1), (1.5, 7), (2, 2), (3, 9)):
        row = batch(spark, ("p7", level)).withColumn("t", F.lit(AT[0] + n * day))
        late = late.unionByName(row)
    history.rewrite(late, "t")
    names = {f for f, _ in changed(in_time, files(tmp_path))}
    assert names and all(touched in f for f in names)
    levels = [s[1] for s in spans(history.state()) if s[0] == "p7"]
    assert levels == [0, 1, 7, 2, 9]
    assert history.state().count() == 39 * 3 + 5


def scans_below_exchanges(df, table):
    """For each scan of the table, whether a shuffle of it lies above it in the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    found = []
    for number, line in enumerate(plan):
        if table not in line or "Scan" not in line:
            continue
        depth, above = len(line) - len(line.lstrip(" :+-")), []
        for upper in reversed(plan[:number]):
            here = len(upper) - len(upper.lstrip(" :+-"))
            if here < depth:
                above.append(upper)
                depth = here
        # The distinct partitions that are replaced are an aggregate of folder names.
        names_only = any("HashAggregate(keys=[bucket" in up for up in above)
        found.append((names_only, any("Exchange" in up for up in above)))
    return found


def test_the_stored_side_is_not_shuffled(spark, tmp_path):
    history = VOCATION.history(spark, str(tmp_path))
    history.apply(batch(spark, *[(f"p{k}", 1) for k in range(20)]), AT[0])
    updates = history._keyed(batch(spark, ("p1", 2)).withColumn("t", F.lit(AT[1])))
    from rankmart.operators.scd2 import FIRST, scd2_open

    opened = scd2_open(updates.drop("t"), VOCATION.tracked, AT[1]).withColumn(FIRST, F.lit(True))
    in_time = history.merged(opened, [0, 1, 2], F.lit(AT[1]))
    late = history.rewritten(updates, "t", [0, 1, 2])
    with_hints = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for plan in (in_time, late):
            scans = scans_below_exchanges(plan, history.table)
            assert any(not names_only for names_only, _ in scans)
            assert not any(moved for names_only, moved in scans if not names_only)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_hints)


def land(spark, root, at, *players):
    df = spark.createDataFrame(
        [("1", n, "Knight", "W", str(level), "1,000", "Open") for n, level in players],
        ", ".join(f"`{c}` string" for c in EXPERIENCE_HEADER),
    )
    write_landing(df, root, "experience", "knight", at.date(), at)


def test_ingest_takes_each_file_once(spark, tmp_path):
    root = str(tmp_path / "landing")

    def ingest():
        return ingest_available(
            spark, root, "vocation", str(tmp_path / "bronze"), str(tmp_path / "silver"),
            str(tmp_path / "checkpoint"),
        )

    land(spark, root, AT[0], ("a", 1), ("b", 1))
    land(spark, root, AT[1], ("a", 2))
    history = ingest()
    first = [
        ("a", 1, AT[0], AT[1], False),
        ("a", 2, AT[1], None, True),
        ("b", 1, AT[0], None, True),
    ]
    assert spans(history.state()) == first
    ingest()
    assert spans(history.state()) == first

    # A later run of the same day, and one that arrives late.
    land(spark, root, AT[1] + timedelta(hours=3), ("a", 3))
    ingest()
    land(spark, root, AT[0] + timedelta(hours=1), ("b", 5))
    state = spans(ingest().state())
    assert [(s[0], s[1], s[4]) for s in state] == [
        ("a", 1, False), ("a", 2, False), ("a", 3, True), ("b", 1, False), ("b", 5, True),
    ]
    late = state[-1]
    assert late[2] == AT[0] + timedelta(hours=1)
    assert history.loads().count() == 4
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    assert bronze.count() == 5 and bronze.filter("late = 'true'").count() == 1


def test_late_files_take_their_place_and_a_new_checkpoint_repeats_nothing(spark, tmp_path):
    root, day = str(tmp_path / "landing"), timedelta(days=1)

    def ingest(checkpoint, max_files=None):
        return ingest_available(
            spark, root, "vocation", str(tmp_path / "bronze"), str(tmp_path / "silver"),
            str(tmp_path / checkpoint), max_files,
        )

    land(spark, root, AT[0], ("a", 10))
    land(spark, root, AT[0] + 20 * day, ("a", 50), ("b", 1))
    ingest("one")
    land(spark, root, AT[0] + 9 * day, ("a", 40))
    land(spark, root, AT[0] + 10 * day, ("a", 41))
    ingest("one", max_files=1)
    land(spark, root, AT[0] + 25 * day, ("a", 60))
    history = ingest("two", max_files=1)
    assert [(s[0], s[1], s[2], s[4]) for s in spans(history.state())] == [
        ("a", 10, AT[0], False),
        ("a", 40, AT[0] + 9 * day, False),
        ("a", 41, AT[0] + 10 * day, False),
        ("a", 50, AT[0] + 20 * day, False),
        ("a", 60, AT[0] + 25 * day, True),
        ("b", 1, AT[0] + 20 * day, True),
    ]
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 6


def test_a_load_that_died_is_repeated(spark, tmp_path, monkeypatch):
    """Between bronze and the history: the next run takes the files once more."""
    root = str(tmp_path / "landing")
    land(spark, root, AT[0], ("a", 1))

    def ingest():
        return ingest_available(
            spark, root, "vocation", str(tmp_path / "bronze"), str(tmp_path / "silver"),
            str(tmp_path / "checkpoint"),
        )

    ingest()
    land(spark, root, AT[1], ("a", 2), ("b", 1))
    with monkeypatch.context() as patched:
        patched.setattr(History, "catch_up", lambda *_: 1 / 0)
        with pytest.raises(Exception):
            ingest()
    assert spans(ingest().state()) == [
        ("a", 1, AT[0], AT[1], False), ("a", 2, AT[1], None, True), ("b", 1, AT[1], None, True),
    ]


def test_a_file_delivered_twice_counts_once(spark, tmp_path):
    root = tmp_path / "landing"
    land(spark, str(root), AT[0], ("a", 1), ("b", 1))
    (first,) = root.rglob("part-*.csv")

    def ingest():
        return ingest_available(
            spark, str(root), "vocation", str(tmp_path / "bronze"), str(tmp_path / "silver"),
            str(tmp_path / "checkpoint"),
        )

    ingest()
    land(spark, str(root), AT[1], ("a", 2))
    again = first.parent / "part-again.csv"
    again.write_bytes(first.read_bytes())
    state = spans(ingest().state())
    assert [(s[0], s[1], s[4]) for s in state] == [("a", 1, False), ("a", 2, True), ("b", 1, True)]
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    # Nothing came late: the second delivery never reached bronze.
    assert bronze.count() == 3 and bronze.filter("late = 'true'").isEmpty()


def test_extra_files_with_headers_of_their_own(spark, tmp_path):
    root = tmp_path / "landing"

    def put(day, run, *lines):
        folder = root / f"extra/year=2024/month=01/day={day:02}/dataset=x/run={run}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"part-{len(list(folder.iterdir()))}.csv").write_text("\n".join(lines) + "\n")

    def ingest():
        return ingest_available(
            spark, str(root), "extra", str(tmp_path / "bronze"), str(tmp_path / "silver"),
            str(tmp_path / "checkpoint"),
        )

    put(1, "060000", "Rank,Name,World,Category,Score", "1,a,W,boss,10", "2,b,W,boss,5")
    put(1, "060000", "Name,Title,Points,Category,World,Vocation", "c,Sir,7,drome,W,Knight")
    ingest()
    put(3, "060000", "Name,World,Category,Score", "a,W,boss,12")
    put(1, "060000", "Rank,Name,World,Category,Score", "1,a,W,boss,10", "2,b,W,boss,5")
    ingest()
    put(2, "060000", "World,Name,Category,Points", "W,a,boss,11")
    state = ingest().state().select("name", "points", "title", "start_date", "is_current")
    day = timedelta(days=1)
    found = sorted(map(tuple, state.collect()), key=lambda r: (r[0], r[3]))
    assert found == [
        ("a", 10, None, AT[0], False),
        ("a", 11, None, AT[0] + day, False),
        ("a", 12, None, AT[0] + 2 * day, True),
        ("b", 5, None, AT[0], True),
        ("c", 7, "Sir", AT[0], True),
    ]
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    assert bronze.count() == 5
    assert [r["points"] for r in bronze.filter("late = 'true'").collect()] == [11]


def test_ingest_of_skills(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "a", "Knight", "W", "9", "Axe Fighting"), ("1", "a", "Knight", "W", "8", "Fishing")],
        "Rank string, Name string, Vocation string, World string, `Skill Level` string, Category string",
    )
    root = str(tmp_path / "landing")
    write_landing(df, root, "skills", "axe", AT[0].date(), AT[0])
    history = ingest_available(
        spark, root, "skills", str(tmp_path / "b"), str(tmp_path / "s"), str(tmp_path / "c")
    )
    assert history.state().count() == 2
    assert history.state().schema == SKILLS.schema


def test_many_micro_batches_are_loaded_once(spark, tmp_path, monkeypatch):
    """Late files, one a micro-batch: the history is written anew one time, not once for each."""
    root, day = str(tmp_path / "landing"), timedelta(days=1)
    calls = []
    rewrite = History.rewrite
    monkeypatch.setattr(History, "rewrite", lambda *a: (calls.append(1), rewrite(*a)))

    def ingest(max_files):
        return ingest_available(
            spark, root, "vocation", str(tmp_path / "bronze"), str(tmp_path / "silver"),
            str(tmp_path / "checkpoint"), max_files,
        )

    land(spark, root, AT[0], ("a", 1))
    land(spark, root, AT[0] + 20 * day, ("a", 50))
    ingest(None)
    for n in range(1, 5):
        land(spark, root, AT[0] + n * day, ("a", 1 + n))
    state = spans(ingest(1).state())
    assert [s[1] for s in state] == [1, 2, 3, 4, 5, 50]
    assert len(calls) == 1


def test_new_days_are_added_to_bronze_without_another_pass(spark, tmp_path, monkeypatch):
    """Only days that bronze has already are gone through for rows of one key and time."""
    root, seen = str(tmp_path / "landing"), []
    monkeypatch.setattr(ingest, "dedup", lambda df, *a: (seen.append(1), dedup(df, *a))[1])

    def run():
        return ingest_available(
            spark, root, "vocation", str(tmp_path / "bronze"), str(tmp_path / "silver"),
            str(tmp_path / "checkpoint"),
        )

    land(spark, root, AT[0], ("a", 1))
    run()
    land(spark, root, AT[1], ("a", 2))
    run()
    assert not seen
    # One file of a day that is there, one of a new day.
    land(spark, root, AT[1] + timedelta(hours=3), ("a", 3))
    land(spark, root, AT[1] + timedelta(days=1), ("a", 4))
    state = spans(run().state())
    assert len(seen) == 1 and [s[1] for s in state] == [1, 2, 3, 4]
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 4


def test_the_rows_that_passed_lie_beside_the_heap(spark, tmp_path):
    """State in RocksDB, one micro-batch for one set of files, and the session as before."""
    root, checkpoint = str(tmp_path / "landing"), tmp_path / "checkpoint"
    names = list(ingest._STATE)
    before = [spark.conf.get(n, None) for n in names]
    land(spark, root, AT[0], ("a", 1))
    ingest_available(
        spark, root, "vocation", str(tmp_path / "bronze"), str(tmp_path / "silver"), str(checkpoint)
    )
    (log,) = [p for p in (checkpoint / "files" / "offsets").iterdir() if p.name.isdigit()]
    assert "RocksDBStateStoreProvider" in log.read_text()
    assert [spark.conf.get(n, None) for n in names] == before
