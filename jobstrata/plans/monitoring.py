"""Health of scheduled runs and error events, over plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata import vocab
from jobstrata.functions.classify import error_recommendation
from jobstrata.functions.dates import AsOf, as_timestamp
from jobstrata.operators.select import last_n


def recent_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    """The newest ``n`` runs of each job."""
    return last_n(runs, ["job_name"], "start_time", ["run_id"], n)


def run_health(expected: DataFrame, known: DataFrame, runs: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Status, severity and success rate per expected job.

    ``known`` lists the jobs that exist. Runs are cut to the last five per job first; what
    is joined then is one row per job.
    """
    newest = F.col("position") == 1
    per_job = (
        recent_runs(runs, 5)
        .groupBy("job_name")
        .agg(
            F.max(F.when(newest, F.col("start_time"))).alias("start_time"),
            F.max(F.when(newest, F.col("life_cycle_state"))).alias("life_cycle_state"),
            F.max(F.when(newest, F.col("result_state"))).alias("result_state"),
            (F.count_if(F.col("result_state") == "SUCCESS") * 100.0 / F.count("*")).alias("success_rate"),
        )
    )
    joined = expected.join(known.withColumn("_known", F.lit(True)), "job_name", "left").join(
        per_job, "job_name", "left"
    )
    hours = (F.unix_millis(as_timestamp(as_of)) - F.col("start_time")) / 3_600_000
    # Status names and their severities.
    status = (
        F.when(F.col("_known").isNull(), "NOT_FOUND")
        .when(F.col("start_time").isNull(), "NO_RUNS")
        .when((F.col("result_state") == "SUCCESS") & (hours > vocab.STALE_HOURS), "STALE")
        .when(F.col("result_state") == "SUCCESS", "HEALTHY")
        .when(F.col("result_state") == "FAILED", "FAILED")
        .when(F.col("life_cycle_state") == "RUNNING", "RUNNING")
        .otherwise("UNKNOWN")
    )
    severity = (
        F.when(F.col("status").isin("NOT_FOUND", "FAILED"), "ERROR")
        .when(F.col("status").isin("NO_RUNS", "STALE", "UNKNOWN"), "WARNING")
        .otherwise("INFO")
    )
    return joined.withColumn("status", status).select(
        "job_name", "status", severity.alias("severity"), "success_rate"
    )


def success_rate(runs: DataFrame, n: int = 5) -> DataFrame:
    """Share of successful runs among the last ``n`` of each job, in percent."""
    return recent_runs(runs, n).groupBy("job_name").agg(
        (F.count_if(F.col("result_state") == "SUCCESS") * 100.0 / F.count("*")).alias("success_rate")
    )


def error_events(events: DataFrame) -> DataFrame:
    """Error events with the recommended action."""
    return events.filter(F.col("level") == "ERROR").withColumn(
        "recommendation", error_recommendation(F.col("message"))
    )
