"""Runs registered queries on Spark and their SQL on DuckDB, and compares the rows.

``python -m tests.oracle [--sf 0.01] [name ...]``
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return float(v) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir: str, fn, sql: str | None):
    """None if equal, else what differs."""
    df = fn(spark, sf_dir)
    cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want_cols, want = rows_of(names, rel.fetchall())
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if not want:
        return "oracle gives no rows"
    if got == want:
        return None
    only_got = [r for r in got if r not in set(want)][:3]
    only_want = [r for r in want if r not in set(got)][:3]
    return f"{len(got)} vs {len(want)} rows\n   spark {only_got}\n   sql   {only_want}"


def session(threads: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{threads}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import __spark_entry__ as entry

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    sf_dir = f"/root/testdata/sf{a.sf}"
    spark, con = session(), duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in a.names or queries:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, queries[name], oracles.get(name))
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:900]}"
            if a.names:
                traceback.print_exc()
        bad += problem is not None
        kind = "" if name in oracles else " (rows only)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name}{kind} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(main())
