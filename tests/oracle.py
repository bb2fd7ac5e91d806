"""Compare queries with their SQL: ``python -m tests.oracle [sf dir] [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def _rows(arrow) -> Counter:
    names = sorted(arrow.column_names)
    columns = [arrow.column(n).to_pylist() for n in names]
    return Counter(tuple(_value(v) for v in row) for row in zip(*columns))


def compare(df, db, sql: str) -> str:
    """Empty if rows, names and types agree, else what differs."""
    ours, theirs = df.toArrow(), db.sql(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} != {sorted(theirs.column_names)}"
    types = []
    for name in ours.column_names:
        a, b = (str(t.schema.field(name).type).replace("large_", "") for t in (ours, theirs))
        if a != b:
            types.append(f"{name}: {a} != {b}")
    left, right = _rows(ours), _rows(theirs)
    if left != right:
        extra, missing = left - right, right - left
        return (
            f"rows {sum(left.values())} vs {sum(right.values())}; only ours "
            f"{extra.total()}: {list(extra)[:2]}; only SQL {missing.total()}: {list(missing)[:2]}"
        )
    if types:
        return "types " + "; ".join(types)
    return "" if left else "no rows"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from rankmart.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    sql, failed = oracle_sql(), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            result = compare(query(spark, sf_dir), db, sql[name]) if name in sql else "no SQL"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(result)
        print(f"{name:32s} {time.time() - start:6.2f}s {result or 'ok'}", flush=True)
    print(f"{failed} differ")


if __name__ == "__main__":
    main()
