"""Streams run to completion over the tables, and the views and tables around them."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobstrata import vocab
from jobstrata.catalog.aggregates import DECISIONS_SQL, decisions
from jobstrata.catalog.base import EVENTS_DAY, ORDERS_DAY, over_postings, postings, query, table
from jobstrata.catalog.ingest import events_stream
from jobstrata.catalog.relations import (
    REPLY_FLOW_SQL, SILVER_PARTS, SILVER_SQL, replies, sent_log, silver,
)
from jobstrata.catalog.rules import ALL_PARTS, GOLD_SQL, raw_postings
from jobstrata.plans import feed, jobs, marts, medallion, views
from jobstrata.schemas import RAW_POSTING
from jobstrata.session import fresh_path, materialize
from jobstrata.sources.files import write_layer
from jobstrata.streaming import alerts, dedup, layers
from jobstrata.streaming.runs import append_parquet, each_batch, run_to_end

c = F.col


@query("i01_event_watermark", "SELECT event_id, ts FROM events")
def i01(spark, sf):
    out = fresh_path(spark, "watermarked")
    rows = dedup.with_event_watermark(events_stream(spark, sf).select("event_id", "ts"), "ts")
    run_to_end(append_parquet(rows, out, fresh_path(spark, "ckpt")))
    return spark.read.schema("event_id bigint, ts timestamp").parquet(out)


@query(
    "i02_medallion_stream",
    over_postings(*ALL_PARTS, more=GOLD_SQL, body="SELECT category AS domain, * EXCLUDE (ingestion_timestamp) FROM gold"),
)
def i02(spark, sf):
    landing, target = fresh_path(spark, "landing"), fresh_path(spark, "lake")
    raw = raw_postings(spark, sf)
    for domain in vocab.DOMAINS:
        own = raw.filter(c("category") == domain).select(*RAW_POSTING.fieldNames())
        write_domain_files(own, f"{landing}/{domain}", domain)
    gold = layers.run_all(spark, landing, target, ORDERS_DAY)
    # When a row was ingested is the time of this run.
    return gold.drop("ingestion_timestamp", "effective_posted_time")


def write_domain_files(df, path, domain):
    """Raw JSON lines whose file names start with the domain."""
    df.write.option("mapreduce.output.basename", f"{domain}_part").json(path)


@query("i03_run_to_completion", "SELECT CAST(ts AS date) AS event_date, count(*) AS n FROM events GROUP BY 1")
def i03(spark, sf):
    out = fresh_path(spark, "done")
    rows = events_stream(spark, sf).select("event_id", F.to_date("ts").alias("event_date"))
    run_to_end(append_parquet(rows, out, fresh_path(spark, "ckpt")))
    return spark.read.schema("event_id bigint, event_date date").parquet(out).groupBy("event_date").agg(F.count("*").alias("n"))


@query("i04_timed_micro_batches", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def i04(spark, sf):
    out = fresh_path(spark, "timed")
    running = append_parquet(events_stream(spark, sf).select("event_type"), out, fresh_path(spark, "ckpt"), every="1 second")
    running.processAllAvailable()
    running.stop()
    return spark.read.schema("event_type string").parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query("i05_stream_dedup", "SELECT DISTINCT user_id FROM events")
def i05(spark, sf):
    out = fresh_path(spark, "unique")
    twice = events_stream(spark, sf).select("user_id", "ts")
    # The delay covers the whole table, so every later event of a user is a repeat.
    rows = dedup.drop_repeats(twice, ["user_id"], "ts", delay="60 days", salts=4)
    run_to_end(append_parquet(rows.select("user_id"), out, fresh_path(spark, "ckpt")))
    return spark.read.schema("user_id bigint").parquet(out)


def gold_view(spark, sf):
    """Gold written once, one partition per domain; the view reads each domain's own."""
    path = fresh_path(spark, "gold")
    gold = medallion.refine(raw_postings(spark, sf), as_of=ORDERS_DAY)
    write_layer(gold, path, ["category"])
    return medallion.gold_all(medallion.split_domains(spark.read.schema(gold.schema).parquet(path)))


GOLD_ALL_SQL = GOLD_SQL + ", gold_all AS (SELECT category AS domain, *, coalesce(posted_time_ts, ingestion_timestamp) AS effective_posted_time FROM gold)"
FEED_DAY = "1998-01-01"
# A look-back that reaches from any mark in the tables to before the feed day.
LATE_SLACK = "12000 DAYS"


@query(
    "i06_notification_cycles",
    over_postings(*ALL_PARTS, more=GOLD_ALL_SQL, body=f"""SELECT CASE WHEN category <> 'digital_analytics' AND effective_posted_time > TIMESTAMP '{FEED_DAY}' - INTERVAL 30 DAYS THEN 1 ELSE 2 END AS cycle,
    job_id, effective_posted_time AS posted_time_ts, url FROM gold_all WHERE contains(city, 'nation')"""),
)
def i06(spark, sf):
    store = feed.FeedStore(spark, fresh_path(spark, "feed"))
    everything = gold_view(spark, sf)
    first = everything.filter(c("domain") != "digital_analytics")
    here = F.contains(c("city"), F.lit("nation"))
    # The second cycle meets rows older than the mark: a look-back finds them, the sent log
    # keeps the first cycle's rows out. A third cycle has nothing left to send.
    store.poll(first, 1, FEED_DAY, here, lookback="30 DAYS")
    store.poll(everything, 2, FEED_DAY, here, slack=LATE_SLACK)
    store.poll(everything, 3, FEED_DAY, here, slack=LATE_SLACK)
    outboxes = [store.outbox(n).withColumn("cycle", F.lit(n)) for n in (1, 2, 3)]
    # The look-back of the later cycles reaches further than the first one's window.
    return outboxes[0].unionByName(outboxes[1]).unionByName(outboxes[2]).select("cycle", "job_id", "posted_time_ts", "url")


@query(
    "i07_mark_replace",
    "SELECT 'newest' AS kind, max(ts) AS last_posted_time_ts FROM events UNION ALL SELECT 'reset', date_trunc('day', min(ts)) FROM events",
)
def i07(spark, sf):
    store = feed.FeedStore(spark, fresh_path(spark, "feed"))
    newest = marts.high_water_mark(table(spark, sf, "events"), "ts").withColumnRenamed("high_water_mark", "last_posted_time_ts")
    store.set_mark(newest, 1)
    # Written, as two reads of one folder in one plan would be taken for the same.
    before = materialize(store.state().select(F.lit("newest").alias("kind"), "last_posted_time_ts"), "before")
    first_day = table(spark, sf, "events").agg(F.to_date(F.min("ts")).cast("string").alias("day")).first()["day"]
    store.reset_mark(first_day, 2)
    return before.unionByName(store.state().select(F.lit("reset").alias("kind"), "last_posted_time_ts"))


@query(
    "i08_reply_ledger",
    f"WITH {REPLY_FLOW_SQL} SELECT s.job_id, decision, responder, title, company, url FROM valid_reply v JOIN sent s ON s.job_id = v.job_id",
)
def i08(spark, sf):
    store = feed.FeedStore(spark, fresh_path(spark, "feed"))
    store.log_sent(sent_log(spark, sf), 1)
    store.record_replies(replies(spark, sf), 1)
    return store.responses().select("job_id", "decision", "responder", "title", "company", "url")


@query(
    "i09_alert_stream",
    over_postings("title", body="""SELECT job_id, category, CASE WHEN regexp_matches(lower(title), 'senior|sênior|lead') THEN 'HIGH' ELSE 'MEDIUM' END AS priority FROM pv
    WHERE job_id <> '' AND NOT EXISTS (SELECT 1 FROM labels l WHERE 'job_' || l.doc_id = pv.job_id)"""),
)
def i09(spark, sf):
    root, arriving = fresh_path(spark, "alerts"), fresh_path(spark, "arriving")
    rows = postings(spark, sf, "title").select("doc_id", "job_id", "category", "title", "company")
    rows.write.parquet(arriving)
    known = table(spark, sf, "labels").select(F.concat(F.lit("job_"), c("doc_id").cast("string")).alias("job_id"))
    sink = alerts.AlertSink(spark, root, known, ["doc_id"])
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(arriving)
    run_to_end(each_batch(stream, sink.apply, fresh_path(spark, "ckpt")))
    sent = spark.read.schema("job_id string, key string, value string, batch bigint").json(f"{root}/alerts")
    read = sent.select("job_id", c("key").alias("category"), F.from_json("value", "priority string").alias("v"))
    return read.select("job_id", "category", "v.priority")


@query(
    "i10_default_lookback",
    f"SELECT 'with mark' AS kind, max(ts) AS since FROM events UNION ALL SELECT 'without', TIMESTAMP '{EVENTS_DAY}' - INTERVAL 6 HOURS",
)
def i10(spark, sf):
    state = table(spark, sf, "events").select(c("ts").cast("timestamp").alias("last_posted_time_ts"))
    mark = lambda df, kind: feed.current_mark(df, EVENTS_DAY).select(F.lit(kind).alias("kind"), "since")
    return mark(state, "with mark").unionByName(mark(state.filter(c("last_posted_time_ts") < "2000-01-01"), "without"))


@query("k01_gold_all_view", over_postings(*ALL_PARTS, more=GOLD_ALL_SQL, body="SELECT * FROM gold_all"))
def k01(spark, sf):
    views.register_gold_all(gold_view(spark, sf))
    return spark.sql("SELECT * FROM vw_jobs_gold_all")


@query(
    "k02_response_views",
    f"WITH {DECISIONS_SQL} SELECT CAST(decision_ts AS date) AS decision_date, decision, count(*) AS decisions_count FROM decided GROUP BY ALL UNION ALL SELECT NULL, decision, count(*) FROM decided GROUP BY decision",
)
def k02(spark, sf):
    filled = decisions(spark, sf)
    for name in ("job_id", "responder", "title", "company", "work_modality", "url"):
        filled = filled.withColumn(name, F.lit(None).cast("string"))
    views.register_response_views(filled)
    return spark.sql(
        "SELECT decision_date, decision, decisions_count FROM vw_chat_agent_summary "
        "UNION ALL SELECT NULL, decision, total FROM vw_chat_agent_totals"
    )


@query(
    "k03_job_views",
    over_postings(*SILVER_PARTS, more=SILVER_SQL, body="SELECT 'vw_jobs_current' AS name, count(*) AS n, count(DISTINCT doc_id) AS ids FROM silver UNION ALL SELECT 'vw_data_quality', 1, count(*) FILTER (title IS NULL) FROM silver"),
)
def k03(spark, sf):
    rows = materialize(silver(spark, sf), "silver")
    metrics = jobs.daily_metrics(rows)
    views.register_job_views(jobs.current_postings(rows, metrics), jobs.data_quality({"silver": rows}))
    return spark.sql(
        "SELECT 'vw_jobs_current' AS name, count(*) AS n, count(DISTINCT doc_id) AS ids FROM vw_jobs_current "
        "UNION ALL SELECT 'vw_data_quality', count(*), max(null_titles) FROM vw_data_quality"
    )
