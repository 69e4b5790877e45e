"""Marts, profiles, audits and dashboard frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobstrata.catalog.base import EVENTS_DAY, ORDERS_DAY, over_postings, postings, query, table
from jobstrata.catalog.ingest import LEGACY_SQL, legacy_postings
from jobstrata.catalog.relations import DAILY_KEYS_SQL, SHIPPED_SQL, SILVER_PARTS, SILVER_SQL, sent_log, shipped, silver, with_stack
from jobstrata.catalog.rules import (
    CORPUS_CITIES, CORPUS_CITY_PARTS, RUNS_SQL, TECH_STACK_SQL, CORPUS_KEYWORDS, customers_with_city, run_table,
)
from jobstrata.functions import classify, location
from jobstrata.functions.dates import not_before
from jobstrata.operators import joins, quality
from jobstrata.plans import jobs, marts, monitoring, star
from jobstrata.session import materialize

c = F.col


@query(
    "d01_daily_metrics",
    over_postings(*SILVER_PARTS, more=SILVER_SQL, body=f"SELECT {DAILY_KEYS_SQL}, count(*) AS jobs_count, count(DISTINCT job_id) AS unique_jobs, avg(len(stack)) AS avg_tech_stack_size FROM silver GROUP BY {DAILY_KEYS_SQL}"),
)
def d01(spark, sf):
    return jobs.daily_metrics(silver(spark, sf))


@query(
    "d02_tech_counts",
    over_postings("ingested", body=f"""SELECT tech, count(*) FILTER (age <= 2) AS mentions_2d, count(DISTINCT job_id) FILTER (age <= 2) AS unique_jobs_2d, count(*) AS mentions_90d, count(DISTINCT job_id) AS unique_jobs_90d
    FROM (SELECT job_id, date_diff('day', CAST(ingestion_timestamp AS date), DATE '2024-01-05') AS age, unnest({TECH_STACK_SQL}) AS tech FROM pv) WHERE age <= 90 GROUP BY tech"""),
)
def d02(spark, sf):
    rows = postings(spark, sf, "ingested", prepare=with_stack).select(
        "job_id", c("ingestion_timestamp").alias("extract_date"), "tech_stack"
    )
    return jobs.tech_counts(rows, "2024-01-05", (2, 90))


@query("d02_tech_ranking", f"WITH {SHIPPED_SQL} SELECT * FROM r30 FULL JOIN r90 USING (tech)")
def d02_ranking(spark, sf):
    return jobs.tech_ranking(shipped(spark, sf), "2001-11-04")


@query(
    "d03_location_insights",
    over_postings(*SILVER_PARTS, more=SILVER_SQL, body="""SELECT date, city, state, country, count(*) AS total_jobs, count(DISTINCT company_normalized) AS unique_companies, count(DISTINCT job_id) AS unique_jobs,
    array_to_string(list_sort(list_distinct(list(seniority_level))), ',') AS seniority_levels, avg(len(stack)) AS avg_tech_stack_size, count(*) / count(DISTINCT company_normalized) AS jobs_per_company
    FROM silver GROUP BY date, city, state, country"""),
)
def d03(spark, sf):
    out = jobs.location_insights(silver(spark, sf))
    return out.withColumn("seniority_levels", F.array_join("seniority_levels", ","))


@query(
    "d04_data_quality",
    over_postings("title", body=" UNION ALL ".join(
        f"""SELECT '{layer}' AS layer, count(*) AS total_records, count(*) FILTER (job_id IS NULL) AS null_job_ids, count(*) FILTER (title IS NULL) AS null_titles, count(*) FILTER (company IS NULL) AS null_companys,
        round(count(*) FILTER (job_id IS NULL) * 100.0 / nullif(count(*), 0), 2) AS null_job_id_pct, round(count(*) FILTER (title IS NULL) * 100.0 / nullif(count(*), 0), 2) AS null_title_pct,
        round(count(*) FILTER (company IS NULL) * 100.0 / nullif(count(*), 0), 2) AS null_company_pct FROM pv WHERE {rule}"""
        for layer, rule in (("bronze", "true"), ("silver", "job_id <> '' AND title <> ''")))),
)
def d04(spark, sf):
    pv = materialize(postings(spark, sf, "title").select("job_id", "title", "company"), "layer")
    return jobs.data_quality({"bronze": pv, "silver": quality.keep_valid(pv, quality.SILVER_MD_DROP)})


PROFILED = {
    "doc_id": "doc_id", "job_id": "job_id", "company": "company", "category": "category", "type": "type", "url": "url", "title": "title",
    "description": "description", "rare": "CASE WHEN doc_id % 50 = 7 THEN lang END",
}


@query(
    "d05_column_profile",
    over_postings("title", body="SELECT \"column\", total_rows, null_count, null_count / total_rows AS null_ratio, CASE WHEN null_count / total_rows < 0.9 THEN d ELSE 0 END AS distinct_count, CASE WHEN null_count / total_rows < 0.9 THEN d / total_rows ELSE 0 END AS unique_ratio FROM ("
        + " UNION ALL ".join(f"SELECT '{n}' AS \"column\", count(*) AS total_rows, count(*) - count({e}) AS null_count, count(DISTINCT {e}) AS d FROM pv" for n, e in PROFILED.items()) + ")"),
)
def d05(spark, sf):
    pv = postings(spark, sf, "title").select(*[F.expr(e).alias(n) for n, e in PROFILED.items()])
    return quality.profile(pv)


@query("d05_column_profile_estimated")
def d05_approx(spark, sf):
    return quality.profile_approx(table(spark, sf, "orders"))


@query(
    "d06_top_values",
    " UNION ALL ".join(
        f"(SELECT '{col}' AS \"column\", {col} AS value, count(*) AS freq FROM orders WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY freq DESC, value LIMIT 10)"
        for col in ("o_orderstatus", "o_orderpriority")),
)
def d06(spark, sf):
    return quality.top_values(table(spark, sf, "orders").withColumn("unique_text", c("o_orderkey").cast("string")))


@query(
    "d07_freshness",
    f"""SELECT event_type, count(*) AS total, min(ts) AS first_ingestion, max(ts) AS last_ingestion, date_diff('day', CAST(max(ts) AS date), DATE '{EVENTS_DAY}') AS days_since_last,
    count(posted) AS with_posted_time, count(*) - count(posted) AS without_posted_time FROM (SELECT *, CASE WHEN value > 5 THEN ts END AS posted FROM events) GROUP BY event_type""",
)
def d07(spark, sf):
    e = table(spark, sf, "events").withColumn("posted", F.when(c("value") > 5, c("ts")))
    return marts.freshness(e, "event_type", "ts", "posted", EVENTS_DAY)


@query("d08_daily_volume", f"SELECT CAST(ts AS date) AS day, count(*) AS n FROM events WHERE ts >= DATE '{EVENTS_DAY}' - INTERVAL 20 DAYS GROUP BY 1")
def d08(spark, sf):
    return marts.daily_volume(table(spark, sf, "events"), "ts", EVENTS_DAY, 20)


@query("d09_field_presence", over_postings("place", body="SELECT count(*) AS total, count(location) AS with_location, count(*) - count(location) AS without_location FROM pv"))
def d09(spark, sf):
    return marts.field_presence(postings(spark, sf, "place"), "location")


@query("d10_counts_by_city", "SELECT n_name, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name ORDER BY n DESC, n_name LIMIT 10")
def d10(spark, sf):
    return marts.chart_top(customers_with_city(spark, sf), "n_name", 10)


@query(
    "d11_origin_split",
    "SELECT CASE WHEN regexp_matches(lower(n_name), '_1|_20|_3') THEN 'Brasil' ELSE 'Internacional' END AS origin, count(*) AS n FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY 1",
)
def d11(spark, sf):
    return marts.origin_split(customers_with_city(spark, sf), location.city_matches(c("n_name"), CORPUS_CITY_PARTS))


@query(
    "d12_available_to_notify",
    """SELECT count(*) AS n, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    WHERE lower(n_name) IN ('nation_1','nation_7','nation_12') AND o_orderdate >= TIMESTAMP '2001-08-02' - INTERVAL 90 DAYS AND NOT EXISTS (SELECT 1 FROM labels WHERE doc_id = o_orderkey)""",
)
def d12(spark, sf):
    orders = table(spark, sf, "orders")
    posted = orders.filter(not_before(orders, "o_orderdate", ORDERS_DAY, "90 DAYS"))
    placed = posted.join(customers_with_city(spark, sf), c("o_custkey") == c("c_custkey"))
    sent = table(spark, sf, "labels").select(c("doc_id").alias("o_orderkey"))
    here = placed.filter(location.city_in(c("n_name"), CORPUS_CITIES))
    return marts.window_stats(joins.not_in(here, sent, ["o_orderkey"]), "o_orderdate")


@query(
    "d13_sent_log_stats",
    "SELECT CAST(count(*) + sum(quality) AS bigint) AS n, TIMESTAMP '2024-01-02' AS first_ts, TIMESTAMP '2024-01-03' AS last_ts FROM labels",
)
def d13(spark, sf):
    return marts.window_stats(sent_log(spark, sf), "notified_ts")


def decisions(spark, sf):
    """Clicks and errors as decisions."""
    e = table(spark, sf, "events").filter(c("event_type").isin("click", "error"))
    return e.select(F.when(c("event_type") == "click", "SIM").otherwise("NAO").alias("decision"), c("ts").alias("decision_ts"))


DECISIONS_SQL = "decided AS (SELECT CASE WHEN event_type = 'click' THEN 'SIM' ELSE 'NAO' END AS decision, ts AS decision_ts FROM events WHERE event_type IN ('click', 'error'))"


@query("d14_decisions_per_day", f"WITH {DECISIONS_SQL} SELECT CAST(decision_ts AS date) AS decision_date, decision, count(*) AS decisions_count FROM decided GROUP BY ALL")
def d14(spark, sf):
    return marts.decisions_per_day(decisions(spark, sf))


@query("d15_decision_totals", f"WITH {DECISIONS_SQL} SELECT decision, count(*) AS total FROM decided GROUP BY decision")
def d15(spark, sf):
    return marts.decision_totals(decisions(spark, sf))


@query(
    "d16_layer_summary",
    """SELECT 'bronze' AS layer, max(CAST(l_shipdate AS date)) AS last_date, count(*) AS total_rows, count(DISTINCT l_orderkey) AS unique_ids FROM lineitem
    UNION ALL SELECT 'gold', max(CAST(o_orderdate AS date)), count(*), count(DISTINCT o_orderkey) FROM orders""",
)
def d16(spark, sf):
    layers = {
        "bronze": table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "job_id"),
        "gold": table(spark, sf, "orders").withColumnRenamed("o_orderkey", "job_id"),
    }
    return marts.layer_summary(layers, "job_id", {"bronze": F.to_date("l_shipdate"), "gold": F.to_date("o_orderdate")})


@query(
    "d17_expectation_losses",
    over_postings("place", body="SELECT count(*) AS total_rows, count(*) FILTER (location IS NULL) AS null_location, count(*) FILTER (length(location) <= 2) AS short_location, count(*) FILTER (job_id IS NULL) AS null_job_id FROM pv"),
)
def d17(spark, sf):
    return quality.expectation_losses(postings(spark, sf, "place"))


@query(
    "d18_company_summary",
    over_postings("title", "posted", more=LEGACY_SQL, body="""SELECT company, count(id) AS total_postings, CAST(sum(CAST(salary_min AS decimal(18,2))) AS double) / count(salary_min) AS salary_min_mean,
    CAST(sum(CAST(salary_max AS decimal(18,2))) AS double) / count(salary_max) AS salary_max_mean FROM fact GROUP BY company"""),
)
def d18(spark, sf):
    return star.star_tables(legacy_postings(spark, sf))["companies"]


FRAMES = [("city", 10), ("company", 15), ("main_technology", 10)]


@query(
    "d19_chart_frames",
    over_postings("title", "posted", more=LEGACY_SQL, body=" UNION ALL ".join(
        [f"(SELECT '{f}' AS frame, {f} AS label, count(*) AS n FROM fact WHERE {f} IS NOT NULL GROUP BY {f} ORDER BY n DESC, label LIMIT {n})" for f, n in FRAMES]
        + ["(SELECT 'skills' AS frame, skill AS label, count(*) AS n FROM (SELECT unnest(skills) AS skill FROM fact) GROUP BY skill ORDER BY n DESC, label LIMIT 15)"])),
)
def d19(spark, sf):
    return marts.chart_frames(star.prepare(legacy_postings(spark, sf)), dict(FRAMES), {"skills": 15})


@query(
    "d19_level_share",
    over_postings("title", "posted", more=LEGACY_SQL, body="SELECT level, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS pct FROM fact GROUP BY level"),
)
def d19_share(spark, sf):
    return marts.share(star.prepare(legacy_postings(spark, sf)), "level")


@query(
    "d20_salary_histogram",
    """WITH v AS (SELECT 'salary_min' AS "column", c_acctbal AS value FROM customer UNION ALL SELECT 'salary_max', c_acctbal * 2 FROM customer),
    b AS (SELECT "column", min(value) AS lo, max(value) AS hi FROM v GROUP BY 1)
    SELECT "column", CAST(least(floor((value - lo) / ((hi - lo) / 20)), 19) AS int) + 1 AS bin, count(*) AS n FROM v JOIN b USING ("column") GROUP BY ALL""",
)
def d20(spark, sf):
    pay = table(spark, sf, "customer").select(c("c_acctbal").alias("salary_min"), (c("c_acctbal") * 2).alias("salary_max"))
    return marts.histogram(pay, ["salary_min", "salary_max"], 20)


@query(
    "d21_summary_report",
    over_postings("title", "posted", more=LEGACY_SQL, body="SELECT count(*) AS total, count(DISTINCT company) AS distinct_company, count(DISTINCT city) AS distinct_city, (SELECT count(DISTINCT skill) FROM (SELECT unnest(skills) AS skill FROM fact)) AS distinct_skill FROM fact"),
)
def d21(spark, sf):
    return marts.summary(star.prepare(legacy_postings(spark, sf)), ["company", "city"], {"skill": "skills"})


@query(
    "d22_extraction_summary",
    "SELECT event_type, count(*) AS n, count(DISTINCT event_type) AS categories, grouping(event_type) AS is_total FROM events GROUP BY ROLLUP (event_type)",
)
def d22(spark, sf):
    return marts.extraction_summary(table(spark, sf, "events"), "event_type")


@query(
    "d23_method_share",
    """SELECT count(*) AS total, count(*) FILTER (event_type = 'click') AS api_count, count(*) FILTER (event_type = 'click') * 100.0 / count(*) AS api_pct,
    count(*) FILTER (event_type = 'view') AS browser_count, count(*) FILTER (event_type = 'view') * 100.0 / count(*) AS browser_pct FROM events""",
)
def d23(spark, sf):
    return marts.method_share(
        table(spark, sf, "events"), {"api": c("event_type") == "click", "browser": c("event_type") == "view"}
    )


@query("d24_seniority_distribution", over_postings(*SILVER_PARTS, more=SILVER_SQL, body="SELECT seniority_level, count(*) AS n FROM silver GROUP BY seniority_level"))
def d24(spark, sf):
    from jobstrata.operators.select import count_top

    return count_top(silver(spark, sf), ["seniority_level"]).orderBy(F.desc("n"), "seniority_level")


@query(
    "d25_success_rate",
    f"WITH {RUNS_SQL} SELECT job_name, count(*) FILTER (result_state = 'SUCCESS') * 100.0 / count(*) AS success_rate FROM ranked WHERE position <= 5 GROUP BY job_name",
)
def d25(spark, sf):
    return monitoring.success_rate(run_table(spark, sf), 5)


@query(
    "d26_ingestion_metrics",
    "SELECT CAST(l_shipdate AS date) AS event_date, count(*) AS volume, avg(date_diff('second', o_orderdate, l_shipdate)) AS mean_latency_s FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1",
)
def d26(spark, sf):
    shipped_orders = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), c("o_orderkey") == c("l_orderkey"))
    return marts.ingestion_metrics(shipped_orders, c("l_shipdate"), c("o_orderdate"))


@query("d27_silver_volume", "SELECT CAST(ts AS date) AS event_date, count(*) AS silver_count FROM events GROUP BY 1")
def d27(spark, sf):
    return marts.layer_volume(table(spark, sf, "events"), "ts")


@query(
    "d28_rejection_rate",
    over_postings("title", "ingested", body="""SELECT CAST(ingestion_timestamp AS date) AS event_date, count(*) AS total, count(*) FILTER (job_id <> '' AND title <> '') AS kept,
    (count(*) - count(*) FILTER (job_id <> '' AND title <> '')) / count(*) AS rejection_rate FROM pv GROUP BY 1"""),
)
def d28(spark, sf):
    rule = F.expr(quality.SILVER_MD_DROP["no_empty_fields"])
    return quality.rejection_rate(postings(spark, sf, "title", "ingested"), rule, F.to_date("ingestion_timestamp"))


@query("d29_duplicate_audit", "SELECT l_orderkey, l_linenumber, count(*) AS occurrences, true AS is_duplicated FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def d29(spark, sf):
    return quality.duplicate_audit(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "d30_threshold_check",
    over_postings("title", "place", more="""b AS (SELECT greatest(count(*) - count(job_id), count(*) - count(title), count(*) - count(location)) / count(*) AS nulls,
      (count(*) - count(DISTINCT coalesce(job_id, '#'))) / count(*) AS dups, count(*) FILTER (job_id IS NOT NULL AND title IS NOT NULL AND location IS NOT NULL) / count(*) AS complete FROM pv WHERE true),
      s AS (SELECT greatest(count(*) - count(job_id), count(*) - count(title), count(*) - count(location)) / count(*) AS nulls,
      (count(*) - count(DISTINCT coalesce(job_id, '#'))) / count(*) AS dups, count(*) FILTER (job_id IS NOT NULL AND title IS NOT NULL AND location IS NOT NULL) / count(*) AS complete FROM pv WHERE job_id <> '' AND title <> '')""",
      body="""SELECT 'bronze' AS layer, 'null_ratio' AS metric, nulls AS value, 0.05::double AS threshold, nulls <= 0.05 AS ok FROM b UNION ALL SELECT 'bronze', 'duplicate_ratio', dups, 0.1::double, dups <= 0.1 FROM b
      UNION ALL SELECT 'silver', 'null_ratio', nulls, 0.02::double, nulls <= 0.02 FROM s UNION ALL SELECT 'silver', 'completeness', complete, 0.95::double, complete >= 0.95 FROM s"""),
)
def d30(spark, sf):
    bronze = postings(spark, sf, "title", "place")
    layers = {"bronze": bronze, "silver": quality.keep_valid(bronze, quality.SILVER_MD_DROP)}
    return quality.threshold_check({name: quality.layer_ratios(df, ["job_id"], ["job_id", "title", "location"]) for name, df in layers.items()})


@query(
    "d31_monthly_trend",
    """SELECT *, n - lag(n) OVER (PARTITION BY o_orderpriority ORDER BY period) AS change FROM (SELECT CAST(date_trunc('month', o_orderdate) AS date) AS period, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)""",
)
def d31(spark, sf):
    return marts.trend(table(spark, sf, "orders"), "o_orderdate", "month", ["o_orderpriority"])


@query(
    "d31_weekly_trend",
    """SELECT *, n - lag(n) OVER (PARTITION BY o_orderstatus ORDER BY period) AS change FROM (SELECT CAST(date_trunc('week', o_orderdate) AS date) AS period, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)""",
)
def d31_week(spark, sf):
    return marts.trend(table(spark, sf, "orders"), "o_orderdate", "week", ["o_orderstatus"])


@query("d32_high_water_mark", "SELECT max(ts) AS high_water_mark FROM events")
def d32(spark, sf):
    return marts.high_water_mark(table(spark, sf, "events"), "ts")


@query("j01_skills_bridge", over_postings("title", "posted", more=LEGACY_SQL, body="SELECT id AS job_id, unnest(skills) AS skill FROM fact"))
def j01(spark, sf):
    return star.star_tables(legacy_postings(spark, sf))["skills"]


@query("j02_tech_explode", over_postings(body=f"SELECT doc_id, unnest({TECH_STACK_SQL}) AS tech FROM pv"))
def j02(spark, sf):
    rows = postings(spark, sf).withColumn("tech_stack", classify.tech_stack(c("description"), CORPUS_KEYWORDS))
    return jobs.tech_mentions(rows).select("doc_id", "tech")
