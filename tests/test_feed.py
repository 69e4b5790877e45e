"""Notification cycles and the reply ledger."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobstrata.plans.feed import FEED_COLUMNS, FeedStore, numbered_feed, pending
from tests.helpers import plan_of

NOW = dt.datetime(2025, 10, 6, 12, 0)
AT = "2025-10-06 12:00:00"


def gold(spark, *rows):
    """(job_id, minutes ago, city) as rows of the cross-domain view."""
    data = [("d", j, "Dev", "Acme", "Remoto", "br", "sp", city, f"https://x/{j}", NOW - dt.timedelta(minutes=m)) for j, m, city in rows]
    return spark.createDataFrame(
        data, "domain string, job_id string, title string, company string, work_modality string, country string, "
        "state string, city string, url string, effective_posted_time timestamp",
    )


@pytest.fixture
def store(spark, tmp_path):
    return FeedStore(spark, str(tmp_path / "feed"))


def ids(df):
    return sorted(r.job_id for r in df.collect())


def test_two_postings_then_none(spark, store):
    rows = gold(spark, ("a", 10, "são paulo"), ("b", 5, "recife"), ("far", 5, "lisboa"), ("old", 600, "recife"))
    first = store.poll(rows, 1, AT)
    assert ids(first) == ["a", "b"]
    assert set(FEED_COLUMNS) <= set(first.columns)
    assert "ID: `a`" in first.filter("job_id = 'a'").first().message
    assert store.state().first()[0] == NOW - dt.timedelta(minutes=5)
    assert ids(store.poll(rows, 2, AT)) == []
    assert store.state().first()[0] == NOW - dt.timedelta(minutes=5)
    assert ids(store.sent()) == ["a", "b"]


def test_rerun_of_a_cycle_gives_the_same_outbox(spark, store):
    rows = gold(spark, ("a", 10, "recife"), ("b", 5, "recife"))
    first = ids(store.poll(rows, 1, AT))
    assert ids(store.poll(rows, 1, AT)) == first
    assert ids(store.sent()) == first


def test_late_row_is_found_with_a_look_back(spark, store):
    store.poll(gold(spark, ("a", 10, "recife")), 1, AT)
    late = gold(spark, ("a", 10, "recife"), ("late", 30, "recife"))
    assert ids(store.poll(late, 2, AT)) == []
    assert ids(store.poll(late, 3, AT, slack="1 HOUR")) == ["late"]
    assert store.state().first()[0] == NOW - dt.timedelta(minutes=10)


def test_posting_in_two_domains_is_sent_once(spark, store):
    assert ids(store.poll(gold(spark, ("a", 10, "recife"), ("a", 10, "recife")), 1, AT)) == ["a"]


def test_reset_mark_backwards(spark, store):
    store.poll(gold(spark, ("a", 10, "recife")), 1, AT)
    store.reset_mark("2025-10-01", 2)
    assert store.state().first()[0] == dt.datetime(2025, 10, 1)
    assert ids(store.poll(gold(spark, ("a", 10, "recife"), ("b", 2000, "recife")), 3, AT)) == ["b"]


def test_replies(spark, store):
    store.poll(gold(spark, ("Job_a", 10, "recife"), ("b", 5, "recife")), 1, AT)
    replies = spark.createDataFrame(
        [("me", "sim Job_a"), ("you", "NAO b já vi"), ("you", "sim zzz"), ("x", "talvez b"), ("x", "sim")], "sender string, message string"
    )
    rejected = store.record_replies(replies, 1)
    assert [(r.sender, r.job_id) for r in rejected.collect()] == [("you", "zzz")]
    got = sorted((r.job_id, r.decision, r.responder, r.title) for r in store.responses().collect())
    assert got == [("Job_a", "SIM", "me", "Dev"), ("b", "NAO", "you", "Dev")]


def test_mark_reaches_the_scan(spark, tmp_path):
    rows = gold(spark, ("a", 10, "recife")).withColumns(
        {"posted_time_ts": F.lit(None).cast("timestamp"), "ingestion_timestamp": F.col("effective_posted_time")}
    )
    rows.drop("effective_posted_time").write.parquet(str(tmp_path / "gold"))
    stored = spark.read.parquet(str(tmp_path / "gold"))
    view = stored.withColumn("effective_posted_time", F.coalesce("posted_time_ts", "ingestion_timestamp"))
    sent = spark.createDataFrame([], "job_id string")
    feed = pending(view, sent, F.lit("2025-10-06 11:00:00").cast("timestamp"))
    assert ids(feed) == ["a"]
    assert "Or(GreaterThan(posted_time_ts" in plan_of(feed)


def test_numbered_messages(spark):
    rows = gold(spark, ("a", 10, "recife"), ("b", 5, "recife")).withColumn("posted_time_ts", F.col("effective_posted_time"))
    texts = {r.job_id: r.message for r in numbered_feed(rows, 50).collect()}
    assert texts["a"].startswith("*🆕 Nova Vaga 1/2*") and texts["b"].startswith("*🆕 Nova Vaga 2/2*")
