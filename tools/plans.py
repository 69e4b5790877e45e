"""Print the shape of each query's plan: scans, exchanges, joins and what should not be there.

Usage: plans.py [--dir DIR] [--show] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from jobstrata.catalog import load
from jobstrata.session import local_session

COUNTED = {
    "scan": r"(?:FileScan|Scan parquet|BatchScan)",
    "exch": r"\bExchange (?:hash|range|Round)",
    "single": r"Exchange SinglePartition",
    "bcast": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "bnlj": r"BroadcastNestedLoopJoin|CartesianProduct",
    "window": r"\bWindow \[",
    "glimit": r"WindowGroupLimit .*Partial",
    "python": r"ArrowEval|BatchEvalPython|MapInPandas|FlatMapGroups",
    "null_aware": r"isNullAware=true|LeftAnti, .*true\b.*BuildRight, true",
}


def shape(df) -> dict[str, int]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {k: len(re.findall(p, plan)) for k, p in COUNTED.items()}


def main() -> None:
    args = argparse.ArgumentParser()
    args.add_argument("--dir", default="/root/testdata/sf0.01")
    args.add_argument("--show", action="store_true")
    args.add_argument("--nobroadcast", action="store_true", help="plan as if no table were small")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark = local_session("8")
    if opts.nobroadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name, q in load().items():
        if opts.names and not any(name.startswith(n) for n in opts.names):
            continue
        df = q.run(spark, opts.dir)
        print(f"{name:34s}", " ".join(f"{k}={v}" for k, v in shape(df).items() if v), flush=True)
        if opts.show:
            df.explain("formatted" if len(opts.names) == 1 else "simple")


if __name__ == "__main__":
    main()
