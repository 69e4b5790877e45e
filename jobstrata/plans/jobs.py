"""Batch refinement of raw postings and the gold marts built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata import vocab
from jobstrata.functions import classify, location
from jobstrata.functions.dates import AsOf, as_date, not_older
from jobstrata.operators import joins, quality
from jobstrata.operators.select import daily_unique, rank_all
from jobstrata.operators.sets import union_labelled

DAILY_KEYS = [
    "date", "company_normalized", "city", "state", "country", "seniority_level", "job_type_normalized"
]


def audit_columns(df: DataFrame, prefix: str, domain: str | None = None, at: Column | None = None) -> DataFrame:
    """Processing time, a full quality score and, if given, the domain."""
    stamp = F.current_timestamp() if at is None else at
    name = "processed_at" if prefix == "bronze" else f"{prefix}_processed_at"
    out = df.withColumns({name: stamp, f"{prefix}_quality_score": F.lit(1.0)})
    return out.withColumn("domain", F.lit(domain)) if domain else out


def jobs_bronze(raw: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """Trimmed postings, one per id and extraction day."""
    trimmed = raw.withColumns(
        {
            "title": F.trim("title"),
            "company": F.lower(F.trim("company")),
            "location": F.trim("location"),
            "description": F.trim("description"),
            "extract_date": F.col("extract_date").cast("timestamp"),
        }
    )
    return audit_columns(daily_unique(trimmed, "job_id", "extract_date", tiebreak or ["title", "location"]), "bronze")


def with_tech_stack(df: DataFrame, keywords: list[str] = vocab.TECH_KEYWORDS) -> DataFrame:
    return df.withColumn("tech_stack", classify.tech_stack(F.col("description"), keywords))


def jobs_silver(bronze: DataFrame) -> DataFrame:
    """Place, technologies, level, job type and company name.

    Technologies are taken over when ``with_tech_stack`` has found them already.
    """
    c = F.col
    stacked = bronze if "tech_stack" in bronze.columns else with_tech_stack(bronze)
    return audit_columns(
        stacked.withColumns(
            {
                "_place": location.parse_general(c("location")),
                "seniority_level": classify.seniority(c("title")),
                "job_type_normalized": classify.job_type(c("type")),
                "company_normalized": classify.company_name(c("company")),
            }
        )
        .withColumns({p: c(f"_place.{p}") for p in ("city", "state", "country")})
        .drop("_place"),
        "silver",
    )


def posting_day() -> Column:
    return F.date_format("extract_date", "yyyy-MM-dd")


def daily_metrics(silver: DataFrame) -> DataFrame:
    """Postings, distinct ids and mean stack size per day and the six descriptive keys."""
    return silver.withColumn("date", posting_day()).groupBy(*DAILY_KEYS).agg(
        F.count("*").alias("jobs_count"),
        F.count_distinct("job_id").alias("unique_jobs"),
        F.avg(F.size("tech_stack")).alias("avg_tech_stack_size"),
    )


def tech_mentions(silver: DataFrame) -> DataFrame:
    """One row per posting and technology."""
    return silver.withColumn("tech", F.explode("tech_stack"))


def skills_bridge(df: DataFrame, key: str = "job_id", skills: str = "skills") -> DataFrame:
    return df.select(F.col(key).alias("job_id"), F.explode(skills).alias("skill"))


def tech_counts(silver: DataFrame, as_of: AsOf = None, windows: tuple[int, ...] = (30, 90)) -> DataFrame:
    """Mentions and distinct postings per technology in each look-back window, in one pass.

    Postings are first counted per (technology, id), so distinct ids cost no extra expansion.
    """
    age = F.datediff(as_date(as_of), F.to_date("extract_date"))
    per_job = (
        tech_mentions(silver.filter(not_older(silver, "extract_date", as_of, max(windows))))
        .groupBy("tech", "job_id")
        .agg(*[F.count_if(age <= n).alias(f"_m{n}") for n in windows])
    )
    aggs = []
    for n in windows:
        aggs.append(F.sum(f"_m{n}").alias(f"mentions_{n}d"))
        aggs.append(F.count_if((F.col(f"_m{n}") > 0) & F.col("job_id").isNotNull()).alias(f"unique_jobs_{n}d"))
    return per_job.groupBy("tech").agg(*aggs)


def tech_rank(silver: DataFrame, days: int, as_of: AsOf = None) -> DataFrame:
    """Technologies of one window, ranked by mentions; ties go by name."""
    counts = tech_counts(silver, as_of, (days,))
    ranked = rank_all(counts, [F.desc(f"mentions_{days}d"), F.asc("tech")], f"rank_{days}d")
    return ranked.withColumn(f"period_{days}d", F.lit(f"{days}_days"))


def tech_ranking(silver: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Both windows side by side from a single pass; a technology absent from one is NULL there.

    The ranked frame has one row per keyword, so ranking it in one task is cheap.
    """
    counts = tech_counts(silver, as_of, (30, 90))
    out = counts
    for n in (30, 90):
        seen = F.col(f"mentions_{n}d") > 0
        out = rank_all(out, [F.desc(f"mentions_{n}d"), F.asc("tech")], f"_r{n}")
        out = out.withColumns(
            {
                f"rank_{n}d": F.when(seen, F.col(f"_r{n}")),
                f"period_{n}d": F.when(seen, F.lit(f"{n}_days")),
                f"unique_jobs_{n}d": F.when(seen, F.col(f"unique_jobs_{n}d")),
                f"mentions_{n}d": F.when(seen, F.col(f"mentions_{n}d")),
            }
        ).drop(f"_r{n}")
    return out.filter(F.coalesce("mentions_30d", "mentions_90d").isNotNull())


def tech_ranking_joined(silver: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The same ranking as a full outer join of the two windows."""
    return joins.outer_on(tech_rank(silver, 30, as_of), tech_rank(silver, 90, as_of), ["tech"])


def location_insights(silver: DataFrame) -> DataFrame:
    """Volume, companies, levels and density per day and place."""
    return (
        silver.withColumn("date", posting_day())
        .groupBy("date", "city", "state", "country")
        .agg(
            F.count("*").alias("total_jobs"),
            F.count_distinct("company_normalized").alias("unique_companies"),
            F.count_distinct("job_id").alias("unique_jobs"),
            F.sort_array(F.collect_set("seniority_level")).alias("seniority_levels"),
            F.avg(F.size("tech_stack")).alias("avg_tech_stack_size"),
        )
        .withColumn("jobs_per_company", F.try_divide("total_jobs", "unique_companies"))
    )


def current_postings(silver: DataFrame, metrics: DataFrame) -> DataFrame:
    """Silver rows with the counts of their daily group, one row per posting.

    ``metrics`` is the daily table, joined on all of its keys.
    """
    return joins.attach_lookup(
        silver.withColumn("date", posting_day()), metrics, DAILY_KEYS, ["jobs_count", "unique_jobs"]
    )


def data_quality(layers: dict[str, DataFrame]) -> DataFrame:
    """NULL counts and percentages of the key columns, one row per layer."""
    # Profiled columns and the stem of their output names.
    columns = {"job_id": "job_id", "title": "title", "company": "company"}
    return union_labelled({n: quality.null_profile(df, columns) for n, df in layers.items()}, "layer")
