"""Bronze to gold as row-wise functions that work on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata import schemas, vocab
from jobstrata.functions import dates, location, salary, text
from jobstrata.operators import quality
from jobstrata.operators.sets import union_labelled


def silver_stg(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Normalised text, typed times and salaries."""
    c = F.col
    new = {
        "title": text.normalize_text(c("title")),
        "company": text.normalize_text(c("company")),
        "location": text.normalize_text(c("location")),
        "location_country": text.lower_trim(c("location_country")),
        "posted_time_ts": dates.parse_timestamp(c("posted_time")),
        "extract_ts": dates.parse_timestamp(c("extract_timestamp")),
        "salary_min": text.safe_double(c("salary_min")),
        "salary_max": text.safe_double(c("salary_max")),
        "processed_timestamp": F.current_timestamp() if processed_at is None else processed_at,
    }
    return bronze.withColumns(new).select(*schemas.SILVER_STG)


def critical_fields() -> Column:
    """Id, title, company and location are all there."""
    rule = text.present(F.col("job_id"))
    for name in ("title", "company", "location"):
        rule = rule & text.present(F.col(name))
    return rule


def silver_md(stg: DataFrame, dash_only: bool = False, widen_salary: bool = False) -> DataFrame:
    """Parsed location, salary and quality flags; rows with missing fields are dropped.

    ``dash_only`` reads every location as ``city - state, country``.
    """
    c = F.col
    parse = location.parse_dash if dash_only else location.parse_auto
    kept = quality.keep_valid(stg.filter(critical_fields()), quality.SILVER_MD_DROP)
    return (
        kept.withColumns(
            {
                "_place": parse(c("location"), c("location_country")),
                "has_salary_info": salary.has_salary_info(
                    c("has_salary"), c("salary_min"), c("salary_max"), widen_salary
                ),
                "salary_range": salary.salary_spread(c("salary_min"), c("salary_max")),
                "description_quality_score": text.description_quality(c("description_length")),
            }
        )
        .withColumns({p: c(f"_place.{p}") for p in ("city", "state", "country")})
        .select(*schemas.SILVER_MD)
    )


def gold(md: DataFrame, as_of: dates.AsOf = None) -> DataFrame:
    """Recency, premium and tier flags on the columns meant for readers."""
    c = F.col
    return (
        quality.keep_valid(md, quality.GOLD_DROP)
        .withColumns(
            {
                "is_recent_posting": dates.is_recent(c("posted_time_ts"), as_of),
                "is_premium_salary": salary.is_premium(c("salary_min")),
                "location_tier": location.location_tier(c("city")),
            }
        )
        .select(*schemas.GOLD)
    )


def refine(bronze: DataFrame, as_of: dates.AsOf = None, dash_only: bool = False) -> DataFrame:
    """Bronze to gold in one fused plan without a shuffle."""
    return gold(silver_md(silver_stg(bronze), dash_only), as_of)


def gold_all(by_domain: dict[str, DataFrame]) -> DataFrame:
    """All domains with their name and the time that orders the feed."""
    return (
        union_labelled(by_domain, "domain")
        .withColumn(
            "effective_posted_time", dates.effective_time(F.col("posted_time_ts"), F.col("ingestion_timestamp"))
        )
        .select(*schemas.GOLD_ALL)
    )


def split_domains(gold_rows: DataFrame, column: str = "category") -> dict[str, DataFrame]:
    return {d: gold_rows.filter(F.col(column) == d) for d in vocab.DOMAINS}
