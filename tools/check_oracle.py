"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

Usage: check_oracle.py [--dir DIR] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import duckdb

from jobstrata.catalog import load
from jobstrata.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    """A value in a form that compares equal across both engines."""
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, decimal.Decimal | int | float):
        return round(float(value), 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, list | tuple):
        return tuple(plain(v) for v in value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, q, sf_dir: str) -> tuple[str, int]:
    df = q.run(spark, sf_dir)
    got_rows = [tuple(r) for r in df.collect()]
    if q.sql is None:
        return "rows only", len(got_rows)
    cur = con.execute(q.sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} vs {sorted(columns)}", len(got_rows)
    got = rows_of(df.columns, got_rows)
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        return f"rows differ: {len(got)} vs {len(want)}\n   {sorted(columns)}\n   spark {only_got}\n   sql   {only_want}"[:3000], len(got)
    return "ok", len(got)


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--dir", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark = local_session("8", **{"spark.driver.memory": "8g"})
    con = connect(opts.dir)
    bad = 0
    for name, q in load().items():
        if opts.names and not any(name.startswith(n) for n in opts.names):
            continue
        start = time.time()
        try:
            outcome, n = compare(spark, con, q, opts.dir)
        except Exception as error:  # noqa: BLE001
            outcome, n = f"error {type(error).__name__}: {str(error)[:1500]}", -1
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += outcome not in ("ok", "rows only")
        print(f"{name:34s} {n:7d} rows {time.time() - start:6.2f}s  {outcome}", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
