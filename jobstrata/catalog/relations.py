"""Joins, per-key selection, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobstrata.catalog.base import over_postings, postings, query, table
from jobstrata.catalog.rules import (
    COMPANY_SQL, CORPUS_KEYWORDS, GENERAL_PLACE_SQL, JOB_TYPE_SQL, REPLY, REPLY_SQL, RUNS_SQL, SENIORITY_SQL,
    TECH_STACK_SQL, run_table,
)
from jobstrata.catalog.ingest import events_stream
from jobstrata.functions import classify, text
from jobstrata.functions.dates import effective_time
from jobstrata.operators import joins, quality, select, sets
from jobstrata.plans import feed, jobs, marts, monitoring
from jobstrata.plans.medallion import split_domains
from jobstrata.session import fresh_path, materialize
from jobstrata.sources.files import sample_rows, write_layer
from jobstrata.streaming.current import CurrentState
from jobstrata.streaming.runs import each_batch, run_to_end

c = F.col


def with_stack(documents):
    """Technologies in place of the text, so that no text travels through the view's joins."""
    return jobs.with_tech_stack(documents, CORPUS_KEYWORDS).drop("description")


def silver(spark, sf):
    """Batch-refined postings: title, place and ingestion day over the posting view."""
    pv = postings(spark, sf, "title", "place", "ingested", prepare=with_stack)
    return jobs.jobs_silver(pv.withColumn("extract_date", c("ingestion_timestamp")))


SILVER_SQL = (
    f"silver AS (SELECT *, strftime(ingestion_timestamp, '%Y-%m-%d') AS date, {GENERAL_PLACE_SQL}, {SENIORITY_SQL} AS seniority_level, {JOB_TYPE_SQL} AS job_type_normalized, "
    f"{COMPANY_SQL} AS company_normalized, {TECH_STACK_SQL} AS stack FROM pv)"
)
SILVER_PARTS = ("title", "place", "ingested")
DAILY_KEYS_SQL = "date, company_normalized, city, state, country, seniority_level, job_type_normalized"


@query(
    "c01_current_postings",
    over_postings(*SILVER_PARTS, more=SILVER_SQL, body=f"""SELECT doc_id, date, company_normalized, city, count(*) OVER w AS jobs_count, count(job_id) OVER w AS unique_jobs
    FROM silver WINDOW w AS (PARTITION BY {DAILY_KEYS_SQL})"""),
)
def c01(spark, sf):
    rows = materialize(silver(spark, sf), "silver")
    metrics = jobs.daily_metrics(rows)
    return jobs.current_postings(rows, metrics).select(
        "doc_id", "date", "company_normalized", "city", "jobs_count", "unique_jobs"
    )


def shipped(spark, sf):
    """Line items as postings of one technology (the return flag and status)."""
    l = table(spark, sf, "lineitem")
    return l.select(
        c("l_orderkey").alias("job_id"), c("l_shipdate").alias("extract_date"),
        F.array(F.concat("l_returnflag", "l_linestatus"), F.concat(F.lit("m"), c("l_linenumber").cast("string"))).alias("tech_stack"),
    )


SHIPPED_SQL = """mention AS (SELECT l_orderkey AS job_id, date_diff('day', CAST(l_shipdate AS date), DATE '2001-11-04') AS age,
    unnest([l_returnflag || l_linestatus, 'm' || l_linenumber]) AS tech FROM lineitem),
  r30 AS (SELECT tech, count(*) AS mentions_30d, count(DISTINCT job_id) AS unique_jobs_30d, row_number() OVER (ORDER BY count(*) DESC, tech) AS rank_30d, '30_days' AS period_30d FROM mention WHERE age <= 30 GROUP BY tech),
  r90 AS (SELECT tech, count(*) AS mentions_90d, count(DISTINCT job_id) AS unique_jobs_90d, row_number() OVER (ORDER BY count(*) DESC, tech) AS rank_90d, '90_days' AS period_90d FROM mention WHERE age <= 90 GROUP BY tech)"""


@query("c02_ranking_outer_join", f"WITH {SHIPPED_SQL} SELECT * FROM r30 FULL JOIN r90 USING (tech)")
def c02(spark, sf):
    return jobs.tech_ranking_joined(shipped(spark, sf), "2001-11-04")


@query(
    "c03_not_notified",
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= DATE '2001-06-01')",
)
def c03(spark, sf):
    late = table(spark, sf, "orders").filter(c("o_orderdate") >= "2001-06-01").select(c("o_custkey").alias("c_custkey"))
    # A NULL among the seen ids must not empty the result.
    seen = late.unionByName(spark.range(1).select(F.lit(None).cast("bigint").alias("c_custkey")))
    return joins.not_in(table(spark, sf, "customer"), seen, ["c_custkey"]).select("c_custkey", "c_name")


@query(
    "c04_new_against_history",
    "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND event_type <> 'view' AND user_id NOT IN (SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-02')",
)
def c04(spark, sf):
    e = table(spark, sf, "events").withColumn(
        "user_id", F.when((c("ts") < "2024-01-02") | (c("event_type") != "view"), c("user_id"))
    )
    return joins.new_only(e.filter(c("ts") >= "2024-01-02"), e.filter(c("ts") < "2024-01-02"), "user_id").select("event_id", "user_id")


@query(
    "c05_layer_reconciliation",
    """SELECT u.day, count(DISTINCT u.job_id) AS ids_upper, count(DISTINCT l.job_id) AS ids_lower, count(DISTINCT u.job_id) - count(DISTINCT l.job_id) AS difference
    FROM (SELECT o_orderkey AS job_id, CAST(o_orderdate AS date) AS day FROM orders) u LEFT JOIN (SELECT l_orderkey AS job_id, CAST(l_shipdate AS date) - 30 AS day FROM lineitem) l
    ON u.job_id = l.job_id AND u.day = l.day GROUP BY u.day""",
)
def c05(spark, sf):
    upper = table(spark, sf, "orders").select(c("o_orderkey").alias("job_id"), F.to_date("o_orderdate").alias("day"))
    lower = table(spark, sf, "lineitem").select(
        c("l_orderkey").alias("job_id"), F.date_sub(F.to_date("l_shipdate"), 30).alias("day")
    )
    return joins.reconcile(upper, lower, "job_id", "day")


def sent_log(spark, sf):
    """Labelled documents as the sent log; good ones were notified a second time."""
    labels = table(spark, sf, "labels")
    job = F.concat(F.lit("job_"), c("doc_id").cast("string"))
    row = labels.select(
        job.alias("job_id"), F.concat(F.lit("t"), c("quality").cast("string")).alias("title"),
        F.concat(F.lit("c"), c("toxic").cast("string")).alias("company"), F.lit("N/A").alias("work_modality"),
        F.lit("first").alias("url"), F.lit("2024-01-01").cast("timestamp").alias("posted_time_ts"),
        F.lit("2024-01-02").cast("timestamp").alias("notified_ts"), "quality",
    )
    again = row.filter("quality = 1").withColumns(
        {"url": F.lit("second"), "notified_ts": F.lit("2024-01-03").cast("timestamp")}
    )
    return row.unionByName(again).drop("quality")


def replies(spark, sf):
    return table(spark, sf, "documents").select(c("source").alias("sender"), F.expr(REPLY).alias("message"))


SENT_SQL = "sent AS (SELECT 'job_' || doc_id AS job_id, 't' || quality AS title, 'c' || toxic AS company, CASE WHEN quality = 1 THEN 'second' ELSE 'first' END AS url FROM labels)"
REPLY_FLOW_SQL = f"{REPLY_SQL}, {SENT_SQL}, valid_reply AS (SELECT d.source AS responder, upper(w[1]) AS decision, w[2] AS job_id FROM reply JOIN documents d USING (doc_id) WHERE valid)"


@query(
    "c06_reply_lookup",
    f"WITH {REPLY_FLOW_SQL} SELECT s.job_id, decision, responder, title, company, url FROM valid_reply v JOIN sent s ON s.job_id = v.job_id",
)
def c06(spark, sf):
    latest = joins.latest_lookup(sent_log(spark, sf), "job_id", "notified_ts", ["url"])
    accepted, _ = feed.match_replies(replies(spark, sf), latest)
    return accepted.select("job_id", "decision", "responder", "title", "company", "url")


@query(
    "c06_reply_rejects",
    f"WITH {REPLY_FLOW_SQL} SELECT responder AS sender, decision, job_id FROM valid_reply v WHERE NOT EXISTS (SELECT 1 FROM sent s WHERE s.job_id = v.job_id)",
)
def c06_rejects(spark, sf):
    latest = joins.latest_lookup(sent_log(spark, sf), "job_id", "notified_ts", ["url"])
    _, rejected = feed.match_replies(replies(spark, sf), latest)
    return rejected.select("sender", "decision", "job_id")


@query(
    "c07_already_notified",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2001-06-01')",
)
def c07(spark, sf):
    late = table(spark, sf, "orders").filter(c("o_orderdate") >= "2001-06-01").select(c("o_custkey").alias("c_custkey"))
    return joins.in_both(table(spark, sf, "customer"), late, ["c_custkey"]).select("c_custkey", "c_name")


@query(
    "e01_tech_rank",
    f"WITH {SHIPPED_SQL} SELECT * FROM r30",
)
def e01(spark, sf):
    return jobs.tech_rank(shipped(spark, sf), 30, "2001-11-04")


@query(
    "e02_latest_per_key_day",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, CAST(l_shipdate AS date) ORDER BY l_shipdate DESC, l_linenumber DESC, l_extendedprice DESC, l_partkey DESC) = 1""",
)
def e02(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey")
    return select.daily_unique(rows, "l_orderkey", "l_shipdate", ["l_linenumber", "l_extendedprice", "l_partkey"])


@query(
    "e03_first_seen",
    "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text",
)
def e03(spark, sf):
    # The hash goes first, so that texts are compared only where hashes agree.
    rows = table(spark, sf, "documents").select("doc_id", "text", F.xxhash64("text").alias("hash"))
    return select.keep_first(rows, ["hash", "text"], ["doc_id"]).drop("hash")


@query(
    "e03_first_seen_id_or_url",
    over_postings(body="SELECT doc_id, job_id, url FROM pv QUALIFY row_number() OVER (PARTITION BY coalesce(job_id, nullif(url, '')) ORDER BY doc_id) = 1"),
)
def e03_either(spark, sf):
    key = F.coalesce(c("job_id"), F.nullif(c("url"), F.lit("")))
    return select.keep_first_by(postings(spark, sf).select("doc_id", "job_id", "url"), key, ["doc_id"])


@query(
    "e04_latest_per_id",
    "SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def e04(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    return select.keep_latest(rows, ["user_id"], "ts", ["event_id"])


@query(
    "e05_last_runs",
    f"WITH {RUNS_SQL} SELECT job_name, run_id, position FROM ranked WHERE position <= 5",
)
def e05(spark, sf):
    return monitoring.recent_runs(run_table(spark, sf), 5).select("job_name", "run_id", "position")


@query(
    "e06_current_state",
    "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def e06(spark, sf):
    state = CurrentState(spark, fresh_path(spark, "state"), ["user_id"], "ts", ["event_id"])
    # The early part arrives as a batch of its own, the stream repeats it and adds the rest.
    e = table(spark, sf, "events").withColumn("ts", c("ts").cast("timestamp"))
    state.apply(e.filter(c("ts") < "2024-01-10"), 1_000_000)
    run_to_end(each_batch(events_stream(spark, sf), state.apply, fresh_path(spark, "ckpt")))
    return state.compact(fresh_path(spark, "state")).read().select("user_id", "event_id", "event_type")


@query("f01_ordered_feed", "SELECT o_orderkey, o_orderdate AS posted_time_ts FROM orders")
def f01(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", c("o_orderdate").alias("posted_time_ts"), c("o_orderkey").alias("job_id")
    )
    return feed.ordered(rows).drop("job_id")


@query("f02_bounded_feed", "SELECT o_orderkey AS job_id, o_orderdate AS posted_time_ts FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50")
def f02(spark, sf):
    rows = table(spark, sf, "orders").select(c("o_orderkey").alias("job_id"), c("o_orderdate").alias("posted_time_ts"))
    return feed.ordered(rows, 50)


@query("f03_newest_by_ingestion", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def f03(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return select.top(rows, [F.desc("ts"), F.desc("event_id")], 10)


@query("f04_dashboard_series", "SELECT CAST(l_shipdate AS date) AS event_date, count(*) AS silver_count FROM lineitem GROUP BY 1 ORDER BY 1 DESC LIMIT 100")
def f04(spark, sf):
    return marts.series(marts.layer_volume(table(spark, sf, "lineitem"), "l_shipdate"), "event_date", 100)


@query(
    "f05_top_daily_companies",
    over_postings("title", "ingested", more=f"s AS (SELECT strftime(ingestion_timestamp, '%Y-%m-%d') AS date, lower(trim(company)) AS company, {SENIORITY_SQL} AS seniority_level FROM pv WHERE job_id <> '' AND title <> '')",
        body="SELECT date, company, seniority_level, count(*) AS jobs_count FROM s GROUP BY ALL ORDER BY date DESC, jobs_count DESC, company, seniority_level LIMIT 10"),
)
def f05(spark, sf):
    pv = quality.keep_valid(postings(spark, sf, "title", "ingested"), quality.SILVER_MD_DROP)
    daily = pv.groupBy(
        F.date_format("ingestion_timestamp", "yyyy-MM-dd").alias("date"), text.normalize_text(c("company")).alias("company"),
        classify.seniority(c("title")).alias("seniority_level"),
    ).agg(F.count("*").alias("jobs_count"))
    return select.top(daily, [F.desc("date"), F.desc("jobs_count"), F.asc("company"), F.asc("seniority_level")], 10)


@query("f06_sample_rows", "SELECT doc_id, source, lang FROM documents ORDER BY doc_id LIMIT 5")
def f06(spark, sf):
    return sample_rows(table(spark, sf, "documents").select("doc_id", "source", "lang"), ["doc_id"])


@query(
    "f07_cap_per_source",
    "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 10",
)
def f07(spark, sf):
    rows = table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    return select.per_key(rows, ["source"], [F.desc("n_chars"), F.asc("doc_id")], 10).drop("n_chars")


@query(
    "g01_domain_union",
    over_postings("posted", "ingested", body="SELECT category AS domain, doc_id, coalesce(posted_time_ts, ingestion_timestamp) AS effective_posted_time FROM pv"),
)
def g01(spark, sf):
    path = fresh_path(spark, "by_domain")
    rows = postings(spark, sf, "posted", "ingested").select("doc_id", "category", "posted_time_ts", "ingestion_timestamp")
    write_layer(rows, path, ["category"])
    # Each domain reads its own partition only.
    return sets.union_labelled(split_domains(spark.read.schema(rows.schema).parquet(path)), "domain").select(
        "domain", "doc_id", effective_time(c("posted_time_ts"), c("ingestion_timestamp")).alias("effective_posted_time")
    )


@query(
    "g02_layer_metric_union",
    """SELECT 'bronze' AS layer, max(CAST(l_shipdate AS date)) AS last_date, count(*) AS total_rows FROM lineitem
    UNION ALL SELECT 'silver', max(CAST(o_orderdate AS date)), count(*) FROM orders""",
)
def g02(spark, sf):
    agg = lambda df, ts: df.agg(F.max(F.to_date(ts)).alias("last_date"), F.count("*").alias("total_rows"))
    return sets.union_labelled(
        {"bronze": agg(table(spark, sf, "lineitem"), "l_shipdate"), "silver": agg(table(spark, sf, "orders"), "o_orderdate")},
        "layer",
    )


@query("g03_distinct_ids", over_postings(body="SELECT DISTINCT job_id FROM pv WHERE job_id <> ''"))
def g03(spark, sf):
    return joins.distinct_ids(postings(spark, sf), "job_id")


@query(
    "g04_layer_difference",
    "SELECT o_orderkey AS job_id FROM orders EXCEPT SELECT l_orderkey FROM lineitem",
)
def g04(spark, sf):
    upper = table(spark, sf, "orders").select(c("o_orderkey").alias("job_id"))
    return joins.layer_difference(upper, table(spark, sf, "lineitem").select(c("l_orderkey").alias("job_id")), "job_id")
