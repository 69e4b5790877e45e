"""Stores and sinks of streams: array files, id histories, exact dedup, change feeds, compaction, commits, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobstrata import schemas
from jobstrata.catalog.base import ORDERS_DAY, over_postings, postings, postings_sql, query, table
from jobstrata.catalog.ingest import events_stream
from jobstrata.catalog.relations import DAILY_KEYS_SQL, SILVER_PARTS, SILVER_SQL
from jobstrata.catalog.rules import ALL_PARTS, CORPUS_KEYWORDS, CORPUS_TERMS, raw_postings
from jobstrata.catalog.streams import FEED_DAY, GOLD_ALL_SQL, gold_view, write_domain_files
from jobstrata.operators import quality
from jobstrata.plans import extraction, feed, jobs, views
from jobstrata.schemas import RAW_POSTING
from jobstrata.session import fresh_path
from jobstrata.sources.files import read_bronze
from jobstrata.sources.idstore import IdStore
from jobstrata.sources.snapshots import Folder, SnapshotTable
from jobstrata.streaming.current import ChangeHistory, CurrentState
from jobstrata.streaming.dedup import UniqueSink
from jobstrata.streaming.envelopes import EnvelopeStream
from jobstrata.streaming.layers import Domain
from jobstrata.streaming.metrics import DailyMetrics
from jobstrata.streaming.profiles import ERROR, ColumnProfiles
from jobstrata.streaming.runs import each_batch, run_to_end

c = F.col


def write_array_files(spark, rows, path, domain, pretty):
    """Files of one JSON array each, on one line or printed over many."""
    chunks = rows.withColumn("chunk", F.floor(F.monotonically_increasing_id() / 100)).groupBy("chunk")
    body = F.to_json(F.collect_list(F.struct(*rows.columns)), {"pretty": str(pretty).lower()})
    chunks.agg(body.alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(path)
    folder = Folder(spark, path)
    for i, (name, _) in enumerate(folder.files()):
        folder.move(name, f"{domain}_{i}.json")


@query(
    "a05_array_files",
    over_postings(*ALL_PARTS, body="SELECT job_id, title, company, location, url, description_length, has_salary FROM pv WHERE category = 'data_engineer'"),
)
def a05_arrays(spark, sf):
    landing = fresh_path(spark, "landing")
    raw = raw_postings(spark, sf).filter(c("category") == "data_engineer").select(*RAW_POSTING.fieldNames())
    shape = F.pmod(F.xxhash64("url", "description"), F.lit(3))
    write_domain_files(raw.filter(shape == 0), f"{landing}/lines", "data_engineer")
    write_array_files(spark, raw.filter(shape == 1), f"{landing}/arrays", "data_engineer", False)
    write_array_files(spark, raw.filter(shape == 2), f"{landing}/printed", "data_engineer", True)
    return read_bronze(spark, landing, "data_engineer").select("job_id", "title", "company", "location", "url", "description_length", "has_salary")


@query("a09_envelope_stream", "SELECT event_id AS offset, event_type AS category, 'title ' || event_id AS title FROM events WHERE event_type IN ('view', 'click')")
def a09(spark, sf):
    e = table(spark, sf, "events")
    value = F.to_json(F.struct(
        F.concat(F.lit("title "), c("event_id").cast("string")).alias("title"), F.lit("c").alias("company"), F.lit("t").alias("extract_timestamp"),
        F.when(c("event_type") == "view", "data_engineer").when(c("event_type") == "click", "data_analytics").otherwise("other").alias("category"),
        F.lit(ORDERS_DAY).alias("extract_date"),
    ))
    sent = e.select(
        c("event_type").cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit("jobs").alias("topic"),
        (c("event_id") % 4).cast("int").alias("partition"), c("event_id").alias("offset"), c("ts").cast("timestamp").alias("timestamp"),
    )
    out = EnvelopeStream(spark, fresh_path(spark, "messages"), ORDERS_DAY)
    # Two deliveries that overlap, each with a checkpoint of its own, as after the first one was lost.
    for rule in ("pmod(offset, 5) < 4", "pmod(offset, 5) > 1"):
        delivered = fresh_path(spark, "delivered")
        sent.filter(rule).write.parquet(delivered)
        stream = spark.readStream.schema(schemas.ENVELOPE).option("maxFilesPerTrigger", 4).parquet(delivered)
        read = out.run(stream, fresh_path(spark, "ckpt"))
    return read.select("offset", F.when(c("category") == "data_engineer", "view").otherwise("click").alias("category"), "title")


@query("a14_compacted_layer", "SELECT event_type AS domain, CAST(ts AS date) AS extract_date, count(*) AS n, CAST(sum(event_id) AS bigint) AS id_sum FROM events GROUP BY ALL")
def a14_compacted(spark, sf):
    layer = SnapshotTable(spark, fresh_path(spark, "layer"), "event_id bigint, domain string, extract_date date", ("domain",))
    rows = table(spark, sf, "events").select("event_id", c("event_type").alias("domain"), F.to_date("ts").alias("extract_date"))
    for n in range(4):
        layer.append(rows.filter(c("event_id") % 4 == n), f"batch-{n}", sort=("extract_date",))
    layer.compact(sort=("extract_date",))
    return layer.read().groupBy("domain", "extract_date").agg(F.count("*").alias("n"), F.sum("event_id").alias("id_sum"))


@query(
    "c04_bucketed_history",
    "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND user_id NOT IN (SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-02')",
)
def c04_store(spark, sf):
    e = table(spark, sf, "events")
    store = IdStore(spark, fresh_path(spark, "ids"), bucket_bytes=1 << 10)
    past = e.filter(c("ts") < "2024-01-02")
    for n in range(4):
        store.add(past.filter(c("event_id") % 4 == n), f"batch-{n}", "user_id")
        if n == 2:
            store.compact()
    return store.unseen(e.filter(c("ts") >= "2024-01-02"), "user_id").select("event_id", "user_id")


DELETES = "event_type = 'error'"


@query(
    "e06_deletes",
    f"SELECT user_id, event_id, event_type FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) WHERE NOT ({DELETES})",
)
def e06_deletes(spark, sf):
    state = CurrentState(spark, fresh_path(spark, "state"), ["user_id"], "ts", ["event_id"], DELETES)
    e = events_stream(spark, sf)
    # The late part of the feed comes first, so older changes arrive after the deletes that count.
    late = table(spark, sf, "events").withColumn("ts", c("ts").cast("timestamp")).filter(c("ts") >= "2024-01-20")
    state.apply(late, 1_000_000)
    run_to_end(each_batch(e, state.apply, fresh_path(spark, "ckpt")))
    return state.compact(fresh_path(spark, "state")).read().select("user_id", "event_id", "event_type")


@query(
    "e06_change_history",
    f"""WITH one AS (SELECT *, {DELETES} AS gone FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1),
    marked AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS earlier FROM one),
    spans AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM marked WHERE earlier IS NULL OR earlier <> event_type)
    SELECT user_id, event_type, ts AS valid_from, valid_to FROM spans WHERE NOT gone""",
)
def e06_history(spark, sf):
    feed_schema = "event_id bigint, user_id bigint, event_type string, ts timestamp"
    history = ChangeHistory(spark, fresh_path(spark, "history"), feed_schema, ["user_id"], "ts", ["event_id"], DELETES, ["event_type"])
    changes = table(spark, sf, "events").select("event_id", "user_id", "event_type", c("ts").cast("timestamp").alias("ts"))
    arriving = fresh_path(spark, "arriving")
    # Dealt by id, so every micro-batch has changes of the whole time; one part comes twice.
    changes.repartition(4, "event_id").write.parquet(arriving)
    changes.filter(c("event_id") % 4 == 1).write.mode("append").parquet(arriving)
    stream = spark.readStream.schema(feed_schema).option("maxFilesPerTrigger", 2).parquet(arriving)
    run_to_end(each_batch(stream, history.sink(compact_every=2).apply, fresh_path(spark, "ckpt")))
    return history.read().select("user_id", "event_type", "valid_from", "valid_to")


WEEK = "CAST(floor((dayofmonth({ts}) - 1) / 7) AS int)"


@query(
    "i05_stream_dedup_exact",
    f"""SELECT user_id, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {WEEK.format(ts='ts')} DESC, ts, event_id) = 1""",
)
def i05_exact(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", c("ts").cast("timestamp").alias("ts"))
    out = SnapshotTable(spark, fresh_path(spark, "unique"), rows.schema)
    sink = UniqueSink(out, "unique", ids=IdStore(spark, fresh_path(spark, "ids"), compact_every=2), key="user_id", ts="ts")
    arriving, checkpoint = fresh_path(spark, "arriving"), fresh_path(spark, "ckpt")
    # The last week first: all that follows is later than any watermark would take.
    for week in (4, 3, 2, 1, 0):
        rows.filter(F.expr(WEEK.format(ts="ts")) == week).coalesce(1).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(rows.schema).parquet(arriving)
        run_to_end(each_batch(stream, sink.apply, checkpoint))
    return out.read().select("user_id", "event_id")


@query(
    "b06_stream_expectations",
    over_postings(*ALL_PARTS, body="""SELECT layer, rule, passed, failed FROM (SELECT 'silver_stg' AS layer, unnest(['job_id_not_null', 'title_not_null', 'company_not_null', 'location_not_null']) AS rule,
    unnest([count(job_id), count(title), count(company), count(location)]) AS passed,
    unnest([count(*) - count(job_id), count(*) - count(title), count(*) - count(company), count(*) - count(location)]) AS failed FROM pv WHERE category = 'digital_analytics')"""),
)
def b06_stream(spark, sf):
    landing, target = fresh_path(spark, "landing"), fresh_path(spark, "lake")
    raw = raw_postings(spark, sf).filter(c("category") == "digital_analytics").select(*RAW_POSTING.fieldNames())
    write_domain_files(raw.repartition(6), landing, "digital_analytics")
    domain = Domain(spark, target, "digital_analytics")
    domain.run(landing, ORDERS_DAY, max_files=2)
    # A second run finds nothing new and counts nothing twice.
    domain.run(landing, ORDERS_DAY, max_files=2)
    found = domain.expectations.read().filter(c("layer") == "silver_stg").groupBy("layer", "rule")
    return found.agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


@query(
    "d26_metrics_up_to_date",
    """SELECT CAST(l_shipdate AS date) AS event_date, count(*) AS volume, avg(date_diff('second', o_orderdate, l_shipdate)) AS mean_latency_s,
    count(*) AS total, count(*) FILTER (l_quantity < 30) AS kept, (count(*) - count(*) FILTER (l_quantity < 30)) / count(*) AS rejection_rate
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""",
)
def d26_stream(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), c("o_orderkey") == c("l_orderkey"))
    rows = rows.select(c("l_shipdate").cast("timestamp").alias("shipped"), c("o_orderdate").cast("timestamp").alias("ordered"), "l_quantity")
    arriving = fresh_path(spark, "arriving")
    rows.repartition(6).write.parquet(arriving)
    lag = F.unix_timestamp("shipped") - F.unix_timestamp("ordered")
    metrics = DailyMetrics(spark, fresh_path(spark, "metrics"), F.to_date("shipped"), lag, c("l_quantity") < 30)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(arriving)
    run_to_end(each_batch(stream, metrics.apply, fresh_path(spark, "ckpt")))
    metrics.compact()
    return metrics.read()


@query(
    "k04_feed_tables",
    over_postings(*ALL_PARTS, more=GOLD_ALL_SQL + f""", sent AS (SELECT job_id, effective_posted_time AS posted_time_ts, url FROM gold_all
    WHERE contains(city, 'nation') AND category <> 'digital_analytics' AND effective_posted_time > TIMESTAMP '{FEED_DAY}' - INTERVAL 30 DAYS)""",
    body="SELECT 'sent' AS kind, job_id, posted_time_ts, url FROM sent UNION ALL SELECT 'state', NULL, max(posted_time_ts), NULL FROM sent"),
)
def k04(spark, sf):
    store = feed.FeedStore(spark, fresh_path(spark, "feed"))
    everything = gold_view(spark, sf)
    here = F.contains(c("city"), F.lit("nation"))
    store.poll(everything.filter(c("domain") != "digital_analytics"), 1, FEED_DAY, here, lookback="30 DAYS")
    # A cycle that stops before its commit leaves files and shows nothing.
    half = feed.candidates(everything, F.lit("1990-01-01").cast("timestamp"), here)
    store._write(feed.with_message(half), "outbox", 2)
    store._write(feed.sent_rows(half), "sent", 2)
    store._write_mark(half.agg(F.max("posted_time_ts").alias("last_posted_time_ts")), 2)
    views.register_feed_tables(store)
    return spark.sql(
        "SELECT 'sent' AS kind, job_id, posted_time_ts, url FROM chat_agent_sent_jobs "
        "UNION ALL SELECT 'state', NULL, last_posted_time_ts, NULL FROM chat_agent_state"
    )


@query(
    "d05_profile_of_days",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", '{period}' AS period, count(*) AS total_rows, count(*) - count({name}) AS null_count, true AS within_bound
        FROM (SELECT event_id, user_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS event_type, ts FROM events) WHERE {rule}"""
        for name in ("event_id", "user_id", "event_type") for period, rule in (("all", "true"), ("week", "ts >= DATE '2024-01-08' AND ts < DATE '2024-01-15'"))),
)
def d05_days(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", "user_id", F.when(c("event_id") % 3 > 0, c("event_type")).alias("event_type"), c("ts").cast("timestamp").alias("ts")
    )
    names = ["event_id", "user_id", "event_type"]
    kept = ColumnProfiles(spark, fresh_path(spark, "profiles"), names, F.to_date("ts"))
    for batch in range(3):
        kept.apply(rows.filter(c("event_id") % 3 == batch), batch)
        if batch == 1:
            kept.compact()
    out = []
    for period, first, last in (("all", None, None), ("week", "2024-01-08", "2024-01-14")):
        part = rows if first is None else rows.filter(F.to_date("ts").between(first, last))
        exact = quality.profile(part.select(*names)).select("column", c("distinct_count").alias("exact"))
        found = kept.read(first, last).join(exact, "column")
        near = F.abs(c("distinct_count") - c("exact")) <= 4 * ERROR * c("exact") + 1
        out.append(found.select("column", F.lit(period).alias("period"), "total_rows", "null_count", near.alias("within_bound")))
    return out[0].unionByName(out[1])


@query(
    "d06_top_values_texts",
    """WITH v AS (SELECT lang, source, repeat(source || '-', 30) AS long_source, repeat('same start ', 10) || lang AS one_start, text FROM documents)"""
    + " UNION ALL ".join(f"(SELECT '{x}' AS \"column\", {x} AS value, count(*) AS freq FROM v WHERE {x} IS NOT NULL AND (SELECT count(DISTINCT {x}) < 0.1 * count(*) FROM v) GROUP BY {x} ORDER BY freq DESC, value LIMIT 10)"
                         for x in ("lang", "source", "long_source", "one_start", "text")),
)
def d06_texts(spark, sf):
    rows = table(spark, sf, "documents").select(
        "lang", "source", F.expr("repeat(source || '-', 30)").alias("long_source"), F.expr("repeat('same start ', 10) || lang").alias("one_start"), "text"
    )
    return quality.top_values(rows)


@query(
    "c04_extraction_chain",
    over_postings("title", body="""SELECT job_id, category, title, url FROM pv WHERE job_id <> '' AND title <> '' AND company <> ''
    AND CASE category WHEN 'data_engineer' THEN regexp_matches(lower(title), 'widget|bolt|gear') WHEN 'data_analytics' THEN regexp_matches(lower(title), 'ring|plate') ELSE true END
    AND NOT EXISTS (SELECT 1 FROM labels l WHERE 'job_' || l.doc_id = pv.job_id)"""),
)
def c04_chain(spark, sf):
    rows = postings(spark, sf, "title").select("doc_id", "job_id", "category", "title", "company", "url")
    known, out = IdStore(spark, fresh_path(spark, "ids")), fresh_path(spark, "new")
    known.add(table(spark, sf, "labels").select(F.concat(F.lit("job_"), c("doc_id").cast("string")).alias("job_id")), "history")
    # Each row is scraped twice in the first run; the second run meets what the first has added.
    some = rows.filter(c("doc_id") % 3 > 0)
    first = extraction.extract(some.unionByName(some), known, out, 0, ["doc_id"], CORPUS_TERMS)
    second = extraction.extract(rows, known, out, 1, ["doc_id"], CORPUS_TERMS)
    return first.unionByName(second).select("job_id", "category", "title", "url")


BATCH_SQL = postings_sql(*SILVER_PARTS).replace("pv AS", "raw AS", 1) + """, pv AS (
    SELECT * REPLACE (lower(trim(company)) AS company, trim(title) AS title, trim(location) AS location) FROM raw
    QUALIFY row_number() OVER (PARTITION BY job_id, CAST(ingestion_timestamp AS date) ORDER BY ingestion_timestamp DESC, trim(title) DESC NULLS LAST, trim(location) DESC NULLS LAST) = 1), """ + SILVER_SQL


@query(
    "d01_batch_medallion",
    f"WITH {BATCH_SQL} SELECT {DAILY_KEYS_SQL}, count(*) AS jobs_count, count(DISTINCT job_id) AS unique_jobs, avg(len(stack)) AS avg_tech_stack_size FROM silver GROUP BY {DAILY_KEYS_SQL}",
)
def d01_batch(spark, sf):
    raw = postings(spark, sf, "title", "place", "ingested")
    raw = raw.withColumn("extract_date", c("ingestion_timestamp"))
    bronze = jobs.jobs_bronze(raw.unionByName(raw))
    return jobs.daily_metrics(jobs.jobs_silver(jobs.with_tech_stack(bronze, CORPUS_KEYWORDS)))


@query(
    "b06_batch_expectations",
    f"WITH {BATCH_SQL} SELECT unnest(['valid_job_id', 'valid_title', 'valid_company', 'valid_extract_date']) AS rule, "
    "unnest([count(*) FILTER (job_id <> ''), count(*) FILTER (title <> ''), count(company), count(ingestion_timestamp)]) AS passed FROM pv",
)
def b06_batch(spark, sf):
    raw = postings(spark, sf, "title", "place", "ingested").withColumn("extract_date", c("ingestion_timestamp"))
    return quality.expectation_report(jobs.jobs_bronze(raw.unionByName(raw)), quality.JOBS_BRONZE_WARN).select("rule", "passed")
