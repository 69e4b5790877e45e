"""Named views and tables for SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobstrata import schemas
from jobstrata.plans import marts
from jobstrata.plans.feed import FeedStore


def register_gold_all(gold_all: DataFrame, name: str = "vw_jobs_gold_all") -> None:
    gold_all.createOrReplaceTempView(name)


def register_response_views(responses: DataFrame, prefix: str = "vw_chat_agent") -> None:
    """Responses, decisions per day, decision totals."""
    responses.select(*schemas.RESPONSES.fieldNames()).createOrReplaceTempView(f"{prefix}_responses")
    marts.decisions_per_day(responses).createOrReplaceTempView(f"{prefix}_summary")
    marts.decision_totals(responses).createOrReplaceTempView(f"{prefix}_totals")


def register_job_views(current: DataFrame, quality: DataFrame) -> None:
    current.createOrReplaceTempView("vw_jobs_current")
    quality.createOrReplaceTempView("vw_data_quality")


def register_feed_tables(store: FeedStore, prefix: str = "chat_agent") -> None:
    """State, sent and response tables of a feed as views on its committed cycles."""
    views = {"state": store.state(), "sent_jobs": store.sent().drop("cycle"), "responses": store.responses()}
    for name, rows in views.items():
        rows.createOrReplaceTempView(f"{prefix}_{name}")


def ensure_feed_tables(spark: SparkSession, prefix: str = "chat_agent") -> None:
    """Create the state, sent and response tables when they do not exist."""
    tables = {"state": schemas.STATE, "sent_jobs": schemas.SENT, "responses": schemas.RESPONSES}
    for name, schema in tables.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}_{name} ({schema.toDDL()}) USING PARQUET")
