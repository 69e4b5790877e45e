"""Sources and sinks: files, messages, payloads, tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobstrata import schemas
from jobstrata.catalog.base import ORDERS_DAY, over_postings, postings, query, stream_table, table
from jobstrata.catalog.rules import SKILLS, SKILLS_SQL
from jobstrata.functions import dates
from jobstrata.plans import star
from jobstrata.session import fresh_path
from jobstrata.sources import files, messages, payload, tables
from jobstrata.streaming.runs import append_parquet, run_to_end

c = F.col

EVENT_FIELDS = schemas.struct("event_id bigint, user_id bigint, event_type string, value double, props string")


def events_stream(spark, sf_dir):
    """The events table as a stream, times as instants."""
    return stream_table(spark, sf_dir, "events").withColumn("ts", c("ts").cast("timestamp"))


@query("a01_json_stream_ingest", "SELECT event_id, user_id, event_type, value, props FROM events")
def a01(spark, sf):
    raw, out = fresh_path(spark, "raw"), fresh_path(spark, "ingested")
    table(spark, sf, "events").select(*EVENT_FIELDS.fieldNames()).write.json(raw)
    stream = files.ingest_json_stream(spark, raw, EVENT_FIELDS)
    run_to_end(append_parquet(stream, out, fresh_path(spark, "ckpt")))
    return spark.read.schema(EVENT_FIELDS).parquet(out)


FILE_NAME = (
    "CASE doc_id % 4 WHEN 0 THEN 'data_engineer_' WHEN 1 THEN 'Data_Engineer_' WHEN 2 THEN 'digital_analytics_' ELSE 'x_data_engineer_' END "
    "|| doc_id || CASE doc_id % 3 WHEN 0 THEN '.json' WHEN 1 THEN '.JSONL' ELSE '.json.gz' END"
)


@query(
    "a02_domain_file_filter",
    f"SELECT doc_id, regexp_matches(lower({FILE_NAME}), '^data_engineer_.*\\.json(l)?$') AS is_domain_file FROM documents",
)
def a02(spark, sf):
    named = table(spark, sf, "documents").select("doc_id", F.expr(FILE_NAME).alias("name"))
    return named.select("doc_id", files.is_domain_file(c("name"), "data_engineer").alias("is_domain_file"))


@query("a03_lineage", "SELECT doc_id, true AS from_documents, true AS stamped FROM documents")
def a03(spark, sf):
    lined = files.with_lineage(table(spark, sf, "documents"))
    return lined.select(
        "doc_id", F.contains("source_file", F.lit("documents.parquet")).alias("from_documents"),
        c("ingestion_timestamp").isNotNull().alias("stamped"),
    )


PATH = (
    "CASE o_orderkey % 5 WHEN 0 THEN '/raw/' || {dash} || '/jobs/jobs.jsonl' WHEN 1 THEN '/raw/jobs/jobs_' || {dash} || '.json' "
    "WHEN 2 THEN '/raw/jobs/jobs_' || {compact} || '.jsonl' WHEN 3 THEN '/raw/' || {dash} || '/jobs_19991231.jsonl' ELSE '/raw/jobs/jobs.json' END"
)
_PATH_SQL = PATH.format(dash="strftime(o_orderdate, '%Y-%m-%d')", compact="strftime(o_orderdate, '%Y%m%d')")


@query(
    "a04_extract_date",
    f"""SELECT o_orderkey, {_PATH_SQL} AS path, CASE o_orderkey % 5 WHEN 4 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS extract_date FROM orders""",
)
def a04(spark, sf):
    path = F.expr(PATH.format(dash="date_format(o_orderdate, 'yyyy-MM-dd')", compact="date_format(o_orderdate, 'yyyyMMdd')"))
    named = table(spark, sf, "orders").select("o_orderkey", path.alias("path"))
    name = F.substring_index("path", "/", -1)
    return named.select("o_orderkey", "path", dates.path_extract_date(c("path"), name).alias("extract_date"))


LINE = (
    "CASE event_id % 5 WHEN 0 THEN '{\"event_id\":' || event_id || ',\"user_id\":' || user_id || '}' "
    "WHEN 1 THEN '{\"event_id\":' || event_id || ',\"user_id\":\"u' || user_id || '\"}' "
    "WHEN 2 THEN '{\"event_id\":' || event_id || ',\"user_id\":' || user_id || ',\"extra\":\"' || event_type || '\"}' "
    "WHEN 3 THEN '{broken ' || event_id ELSE '{\"event_id\":' || event_id || ',\"user_id\":null}' END"
)


@query(
    "a05_rescued_data",
    f"""SELECT {LINE} AS line, CASE WHEN event_id % 5 <> 3 THEN event_id END AS event_id, CASE WHEN event_id % 5 IN (0, 2) THEN user_id END AS user_id,
    CASE event_id % 5 WHEN 1 THEN 'user_id=u' || user_id WHEN 2 THEN 'extra=' || event_type WHEN 3 THEN '_corrupt_record={{broken ' || event_id END AS rescued FROM events""",
)
def a05(spark, sf):
    lines = table(spark, sf, "events").select(F.expr(LINE).alias("value")).withColumn("line", c("value"))
    read = files.with_rescued(lines, schemas.struct("event_id bigint, user_id bigint"))
    pairs = F.transform(F.map_entries("_rescued_data"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return read.select("line", "event_id", "user_id", F.array_join(F.array_sort(pairs), ";").alias("rescued"))


@query("a06_raw_json_inferred", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS bigint) AS id_sum FROM events GROUP BY event_type")
def a06(spark, sf):
    raw = fresh_path(spark, "raw")
    table(spark, sf, "events").select("event_id", "event_type").write.json(raw)
    return files.read_raw_json(spark, raw).groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("id_sum")
    )


@query("a07_raw_table", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def a07(spark, sf):
    raw = fresh_path(spark, "raw")
    table(spark, sf, "events").select("event_id", "event_type").write.json(raw)
    name = "raw_" + raw[-32:]
    return files.register_raw(
        spark, name, raw, comment="raw postings", properties={"quality": "raw"}
    ).groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "a08_file_counts",
    "SELECT source, count(DISTINCT source || '_' || lang || '.json') AS files, count(*) AS records FROM documents GROUP BY source",
)
def a08(spark, sf):
    file = F.concat("source", F.lit("_"), "lang", F.lit(".json"))
    return files.file_counts(table(spark, sf, "documents"), file, ["source"])


@query(
    "a10_message_decode",
    "SELECT event_id, user_id, event_type, value, props, ts AS kafka_timestamp, event_type AS kafka_key FROM events",
)
def a10(spark, sf):
    e = table(spark, sf, "events")
    sent = e.select(
        c("event_type").cast("binary").alias("key"),
        F.to_json(F.struct(*EVENT_FIELDS.fieldNames())).cast("binary").alias("value"), c("ts").alias("timestamp"),
    )
    return messages.decode_messages(sent, EVENT_FIELDS)


@query(
    "a11_json_by_category",
    "SELECT event_type AS category, CAST(ts AS date) AS extract_date, count(*) AS n, CAST(sum(event_id) AS bigint) AS id_sum FROM events GROUP BY ALL",
)
def a11(spark, sf):
    out = fresh_path(spark, "by_category")
    rows = events_stream(spark, sf).select(
        "event_id", c("event_type").alias("category"), F.to_date("ts").alias("extract_date")
    )
    run_to_end(messages.write_json_by_category(rows, out, fresh_path(spark, "ckpt")))
    read = spark.read.schema("event_id bigint, category string, extract_date date").json(out)
    return read.groupBy("category", "extract_date").agg(F.count("*").alias("n"), F.sum("event_id").alias("id_sum"))


@query(
    "a12_message_encode",
    "SELECT event_type AS key, count(*) AS n, CAST(sum(event_id) AS bigint) AS id_sum, count(DISTINCT event_type) AS types FROM events GROUP BY event_type",
)
def a12(spark, sf):
    sent = messages.encode_messages(table(spark, sf, "events").select("event_id", "user_id"), F.lit("x"))
    assert sent.columns == ["key", "value"]
    keyed = messages.encode_messages(table(spark, sf, "events").select("event_id", "event_type"), c("event_type"))
    read = keyed.select("key", F.from_json("value", "event_id bigint, type string").alias("v"))
    return read.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("v.event_id").alias("id_sum"), F.count_distinct("v.type").alias("types")
    )


@query("a13_append_jsonl", "SELECT event_type AS category, 2 * count(*) AS n FROM events GROUP BY event_type")
def a13(spark, sf):
    out = fresh_path(spark, "jsonl")
    rows = table(spark, sf, "events").select("event_id", c("event_type").alias("category"))
    files.append_jsonl(rows, out, ["category"])
    files.append_jsonl(rows, out, ["category"])
    return spark.read.schema("event_id bigint, category string").json(out).groupBy("category").agg(F.count("*").alias("n"))


@query(
    "a14_layer_write",
    "SELECT event_type AS domain, CAST(ts AS date) AS extract_date, count(*) AS n FROM events GROUP BY ALL",
)
def a14(spark, sf):
    out = fresh_path(spark, "layer")
    rows = table(spark, sf, "events").select("event_id", c("event_type").alias("domain"), F.to_date("ts").alias("extract_date"))
    files.write_layer(rows, out, ["domain", "extract_date"], sort=["event_id"])
    read = spark.read.schema("event_id bigint, domain string, extract_date date").parquet(out)
    return read.groupBy("domain", "extract_date").agg(F.count("*").alias("n"))


SALARY_RANGE = "CASE doc_id % 3 WHEN 0 THEN 'R$ ' || (1 + doc_id % 9) || ',000 - R$ ' || (10 + doc_id % 9) || ',500' WHEN 1 THEN 'a combinar' END"
LEGACY_PLACE = "CASE doc_id % 4 WHEN 0 THEN source || ', ' || upper(lang) WHEN 1 THEN source || ', ' || lang ELSE source END"


def legacy_postings(spark, sf):
    """The posting view in the shape of the flat legacy table."""
    pv = postings(spark, sf, "title", "posted")
    return pv.select(
        c("job_id").alias("id"), "title", "company", F.expr(LEGACY_PLACE).alias("location"),
        F.date_format("posted_time_ts", "yyyy-MM-dd").alias("posted_date"), "description",
        F.expr(SALARY_RANGE).alias("salary_range"), F.expr(SKILLS).alias("skills"),
    )


LEGACY_SQL = (
    f"flat AS (SELECT job_id AS id, title, company, {LEGACY_PLACE} AS location, strftime(posted_time_ts, '%Y-%m-%d') AS posted_date, description, "
    f"{SALARY_RANGE} AS salary_range, {SKILLS_SQL} AS skills FROM pv), "
    r"""fact AS (SELECT *, coalesce(skills[1], 'N/A') AS main_technology,
    try_cast(replace(regexp_extract(salary_range, 'R\$ ([0-9,]+)', 1), ',', '') AS double) AS salary_min,
    try_cast(replace(regexp_extract(salary_range, '- R\$ ([0-9,]+)', 1), ',', '') AS double) AS salary_max,
    CASE WHEN regexp_matches(title, 'Sênior|Senior') THEN 'Senior' WHEN contains(title, 'Pleno') THEN 'Pleno' WHEN regexp_matches(title, 'Junior|Jr') THEN 'Junior' ELSE 'Não especificado' END AS level,
    regexp_replace(location, ', [A-Z]{2}$', '') AS city, nullif(regexp_extract(location, ', ([A-Z]{2})$', 1), '') AS state
    FROM flat WHERE title IS NOT NULL AND company IS NOT NULL)"""
)


@query(
    "a15_star_snapshot",
    over_postings("title", "posted", more=LEGACY_SQL, body="SELECT id, title, company, city, state, posted_date, description, salary_range, salary_min, salary_max, level, main_technology FROM fact"),
)
def a15(spark, sf):
    root = fresh_path(spark, "star")
    flat = legacy_postings(spark, sf)
    star.write_star(flat, root, "20240101_000000")
    return tables.latest_snapshot(spark, f"{root}/postings")


@query(
    "a16_api_payload",
    over_postings("title", "place", "posted", body=f"""SELECT coalesce(job_id, '') AS job_id, coalesce(title, '') AS title, CASE WHEN doc_id % 3 = 2 THEN '' ELSE company END AS company,
    CASE doc_id % 3 WHEN 0 THEN source ELSE '' END AS company_id,
    coalesce(location, '') AS location, CASE WHEN len(parts) >= 2 THEN trim(parts[1]) ELSE '' END AS city, CASE WHEN len(parts) >= 2 THEN trim(parts[2]) ELSE '' END AS state,
    CASE WHEN len(parts) > 2 THEN trim(parts[-1]) ELSE 'Brazil' END AS country,
    CASE WHEN doc_id % 12 = 5 THEN '{ORDERS_DAY}T00:00:00' ELSE strftime(posted_time_ts, '%Y-%m-%dT00:00:00') END AS posted_time_ts,
    CASE WHEN doc_id % 12 = 5 THEN true ELSE coalesce(date_diff('day', CAST(posted_time_ts AS date), DATE '{ORDERS_DAY}') < 7, false) END AS is_recent_posting,
    CASE WHEN contains(lower(location), 'remote') THEN 'remote' WHEN contains(lower(location), 'hybrid') THEN 'hybrid' WHEN location <> '' THEN 'onsite' END AS work_modality,
    type AS contract_type, false AS has_salary_info, description[1:500] AS description_snippet, CASE WHEN description <> '' THEN 'high' ELSE 'low' END AS description_quality_score,
    doc_id % 2 = 0 AS is_easy_apply
    FROM (SELECT *, string_split(location, ',') AS parts FROM pv) WHERE title <> '' OR url <> ''"""),
)
def a16(spark, sf):
    pv = postings(spark, sf, "title", "place", "posted")
    company = F.when(
        c("doc_id") % 3 == 0, F.to_json(F.struct(c("company").alias("name"), c("source").alias("id")))
    ).when(c("doc_id") % 3 == 1, c("company")).otherwise("{}")
    posted = F.when(c("doc_id") % 12 == 5, "soon").otherwise(F.date_format("posted_time_ts", "yyyy-MM-dd"))
    item = F.struct(
        F.when(c("doc_id") % 2 == 0, c("job_id")).alias("id"), c("job_id"), "title", company.alias("company"), "location",
        F.when(c("doc_id") % 4 == 0, c("url")).alias("link"), F.when(c("doc_id") % 4 != 0, c("url")).alias("url"),
        posted.alias("listed_at"), c("type").alias("job_type"), "description",
        F.when(c("doc_id") % 2 == 0, True).alias("easy_apply"),
    )
    body = F.to_json(F.struct(F.lit(True).alias("success"), F.array(item).alias("data")))
    flat = payload.normalize_api_payload(pv.select(body.alias("value")), "data", ORDERS_DAY)
    return flat.select(
        "job_id", "title", "company", "company_id", "location", "city", "state", "country", "posted_time_ts",
        "is_recent_posting", "work_modality", "contract_type", "has_salary_info", "description_snippet",
        "description_quality_score", "is_easy_apply",
    )


@query("a17_table_filter", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 30")
def a17(spark, sf):
    table(spark, sf, "lineitem").createOrReplaceTempView("trips")
    return tables.read_filtered(spark, "trips", c("l_quantity") < 30).select("l_orderkey", "l_linenumber", "l_quantity")


AUDITED = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query("a18_table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in AUDITED))
def a18(spark, sf):
    return tables.table_counts({t: table(spark, sf, t) for t in AUDITED})
