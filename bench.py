"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query, the median counts (default 3)
BENCH_ALL=1    time every registered query instead
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from jobstrata.catalog import load
from jobstrata.session import local_session

HEADLINE = [
    "f05_top_daily_companies", "b01_text_normalised", "b04_layer_contract_gold", "b20_seniority", "b25_tech_stack",
    "b27_work_modality", "b41_notification_text", "b42_run_health", "a05_rescued_data", "a10_message_decode",
    "a16_api_payload", "c01_current_postings", "c02_ranking_outer_join", "c03_not_notified", "c04_new_against_history",
    "c05_layer_reconciliation", "c06_reply_lookup", "d01_daily_metrics", "d02_tech_ranking", "d03_location_insights",
    "d05_column_profile", "d06_top_values", "d16_layer_summary", "d19_chart_frames", "d20_salary_histogram",
    "d26_ingestion_metrics", "d29_duplicate_audit", "d31_monthly_trend", "e02_latest_per_key_day", "e03_first_seen",
    "e04_latest_per_id", "f03_newest_by_ingestion", "f07_cap_per_source", "g04_layer_difference", "k01_gold_all_view",
    "d02_tech_counts", "j02_tech_explode", "i02_medallion_stream", "i06_notification_cycles", "i09_alert_stream", "k03_job_views",
]


def run_once(q, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    q.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "bench", **{"spark.sql.shuffle.partitions": cpus})
    registered = load()
    names = list(registered) if os.environ.get("BENCH_ALL") else HEADLINE
    times = {}
    for name in names:
        q = registered[name]
        run_once(q, spark, sf_dir)
        times[name] = round(statistics.median(run_once(q, spark, sf_dir) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "warm median seconds, summed over queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
