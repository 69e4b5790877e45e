"""Flat postings to a small star: fact, skills bridge, company summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.functions import classify, location, salary
from jobstrata.plans.jobs import skills_bridge
from jobstrata.plans.marts import company_summary
from jobstrata.session import materialize
from jobstrata.sources.tables import snapshot_path


def prepare(df: DataFrame) -> DataFrame:
    """Derived columns of the fact table; rows without title or company are dropped."""
    c = F.col
    return (
        df.dropna(subset=["title", "company"])
        .withColumns(
            {
                "main_technology": classify.main_technology(c("skills")),
                "_salary": salary.bounds_from_text(c("salary_range")),
                "level": classify.seniority_legacy(c("title")),
                "_place": location.parse_state_suffix(c("location")),
            }
        )
        .withColumns(
            {
                "salary_min": c("_salary.low"),
                "salary_max": c("_salary.high"),
                "city": c("_place.city"),
                "state": c("_place.state"),
            }
        )
        .drop("_salary", "_place")
    )


def star_tables(df: DataFrame) -> dict[str, DataFrame]:
    return _tables(prepare(df))


def _tables(ready: DataFrame) -> dict[str, DataFrame]:
    fact = ready.select(
        "id", "title", "company", "city", "state", "posted_date", "description", "salary_range",
        "salary_min", "salary_max", "level", "main_technology",
    )
    return {
        "postings": fact,
        "skills": skills_bridge(ready, "id"),
        "companies": company_summary(ready, "company", "id", "salary_min", "salary_max"),
    }


def write_star(df: DataFrame, root: str, version: str) -> None:
    """Write the three tables under a snapshot folder each; the source is read and prepared once."""
    for name, table in _tables(materialize(prepare(df), "star")).items():
        table.write.parquet(snapshot_path(f"{root}/{name}", version))
