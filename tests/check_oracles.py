"""Run queries next to their SQL: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import math
import pathlib
import sys
import time

import duckdb

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(
            f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')"
        )
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, sf_dir, queries, oracles):
    """None if equal, else what differs."""
    df = queries[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracles:
        return None if got[1] else "no rows"
    result = con.execute(oracles[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} instead of {want[0]}"
    if got[1] != want[1]:
        extra = sorted(set(got[1]) - set(want[1]))[:2]
        missing = sorted(set(want[1]) - set(got[1]))[:2]
        return (
            f"{len(got[1])} rows instead of {len(want[1])}; extra {str(extra)[:300]}, "
            f"missing {str(missing)[:300]}"
        )
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracles = contract.queries(), contract.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir, queries, oracles)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        note = "" if name in oracles else " (rows only)"
        print(f"{mark} {name}{note} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
