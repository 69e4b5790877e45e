"""Batch refinement and the medallion's options on hand-written postings."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata import schemas
from jobstrata.operators import quality
from jobstrata.plans import jobs, medallion
from jobstrata.plans.marts import exact_mean

RAW = [
    ("1", " Senior Dev ", " ACME Ltda ", " Recife - PE ", "Python and SQL", "2025-09-02T08:00:00", "full-time", None),
    ("1", " Senior Dev ", " ACME Ltda ", " Recife - PE ", "Python and SQL", "2025-09-02T09:00:00", "full-time", None),
    ("1", "Senior Dev", "ACME Ltda", "Recife - PE", "Python and SQL", "2025-09-03T09:00:00", "full-time", None),
    ("2", "Dev", "acme inc", "Recife, PE", "javascript", "2025-09-02T09:00:00", None, None),
    ("3", "Head of Data", "casa", "Lisboa, LX, Portugal", None, "2025-06-20T09:00:00", "remoto", None),
]


@pytest.fixture(scope="module")
def silver(spark):
    raw = spark.createDataFrame(
        RAW, "job_id string, title string, company string, location string, description string, extract_date string, type string, salary_range string"
    )
    return jobs.jobs_silver(jobs.jobs_bronze(raw))


def test_bronze_keeps_one_row_per_id_and_day(silver):
    kept = sorted((r.job_id, str(r.extract_date)) for r in silver.collect())
    assert kept == [("1", "2025-09-02 09:00:00"), ("1", "2025-09-03 09:00:00"), ("2", "2025-09-02 09:00:00"), ("3", "2025-06-20 09:00:00")]


def test_silver_columns(silver):
    one = silver.filter("job_id = '1'").first()
    assert (one.title, one.company, one.company_normalized) == ("Senior Dev", "acme ltda", "acme")
    assert (one.city, one.state, one.country) == ("Recife", "PE", "Brasil")
    assert (one.tech_stack, one.seniority_level, one.job_type_normalized) == (["python", "sql"], "Senior", "CLT")
    three = silver.filter("job_id = '3'").first()
    assert (three.country, three.tech_stack, three.seniority_level, three.company_normalized) == ("Portugal", [], "Principal", "casa")
    assert quality.keep_valid(silver, quality.JOBS_SILVER_WARN).count() == 4


def test_metrics_do_not_multiply_postings(silver):
    metrics = jobs.daily_metrics(silver)
    assert metrics.agg(F.sum("jobs_count")).first()[0] == 4
    current = jobs.current_postings(silver, metrics)
    assert current.count() == 4 and current.filter("jobs_count IS NULL").count() == 0


def test_ranking_windows(silver):
    got = {r.tech: (r.mentions_30d, r.unique_jobs_30d, r.rank_30d, r.mentions_90d) for r in jobs.tech_ranking(silver, "2025-09-10").collect()}
    assert got == {"python": (2, 1, 1, 2), "sql": (2, 1, 2, 2)}
    later = {r.tech: (r.mentions_30d, r.rank_30d, r.mentions_90d, r.rank_90d) for r in jobs.tech_ranking(silver, "2025-11-20").collect()}
    assert later == {"python": (None, None, 2, 1), "sql": (None, None, 2, 2)}


def test_location_insights(silver):
    row = jobs.location_insights(silver).filter("date = '2025-09-02' AND city = 'Recife'").first()
    assert (row.total_jobs, row.unique_companies, row.seniority_levels, row.avg_tech_stack_size, row.jobs_per_company) == (
        2, 1, ["Pleno", "Senior"], 1.0, 2.0,
    )


def test_quality_view(silver):
    rows = {r.layer: (r.total_records, r.null_titles, r.null_title_pct) for r in jobs.data_quality({"silver": silver, "none": silver.limit(0)}).collect()}
    assert rows == {"silver": (4, 0, 0.0), "none": (0, 0, None)}


def bronze(spark, **fields):
    row = {f: None for f in schemas.BRONZE}
    row |= {"job_id": "a", "title": "Dev", "company": "Acme", "location": "Recife, PE", "has_salary": False, "salary_min": "R$ 9000"} | fields
    typed = T.StructType(
        schemas.RAW_POSTING.fields
        + [T.StructField("_rescued_data", T.MapType(T.StringType(), T.StringType()))]
        + schemas.struct("ingestion_timestamp timestamp, source_file string, extract_date string").fields
    )
    return spark.createDataFrame([tuple(row[f.name] for f in typed.fields)], typed)


def test_layer_contracts(spark):
    stg = medallion.silver_stg(bronze(spark))
    md = medallion.silver_md(stg)
    assert (stg.columns, md.columns, medallion.gold(md).columns) == (schemas.SILVER_STG, schemas.SILVER_MD, schemas.GOLD)
    assert medallion.gold_all({"data_engineer": medallion.gold(md)}).columns == schemas.GOLD_ALL


def test_location_and_salary_modes(spark):
    stg = medallion.silver_stg(bronze(spark))
    by_shape, by_dash = medallion.silver_md(stg).first(), medallion.silver_md(stg, dash_only=True).first()
    assert (by_shape.city, by_shape.state) == ("recife", "pe")
    assert (by_dash.city, by_dash.state) == ("recife, pe", None)
    assert by_shape.has_salary_info is False
    assert medallion.silver_md(stg, widen_salary=True).first().has_salary_info is True


@pytest.mark.parametrize("field", ["job_id", "title", "company", "location"])
@pytest.mark.parametrize("value", [None, ""])
def test_missing_fields_drop_the_row(spark, field, value):
    assert medallion.silver_md(medallion.silver_stg(bronze(spark, **{field: value}))).count() == 0


def test_refinement_is_one_stage(spark):
    plan = medallion.refine(bronze(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_exact_mean_of_small_and_huge_amounts(spark):
    rows = [("cents", 0.005), ("cents", 0.015), ("huge", 1e30), ("huge", 3e30), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(exact_mean(F.col("v")).alias("m"))
    assert {r.k: r.m for r in df.collect()} == {"cents": 0.01, "huge": 2e30, "none": None}
