"""From scraped rows to the day's new postings: repeats, incomplete and irrelevant rows and known ids go, the rest is appended."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.functions.text import present, title_relevant
from jobstrata.operators.select import keep_first_by
from jobstrata.sources.idstore import IdStore


def new_postings(rows: DataFrame, known: IdStore, arrival: list[str], terms: dict[str, list[str]] | None = None) -> DataFrame:
    """The first row of each id (or url, without one) that is complete, fits its category's terms and was never seen.

    Filters come before the repeats are dropped, where they read the row alone, so a repeat that is complete still counts
    when the first one is not.
    """
    fit = rows.filter(present(F.col("title")) & present(F.col("company")) & title_relevant(F.col("title"), F.col("category"), terms))
    key = F.coalesce(F.nullif("job_id", F.lit("")), F.nullif("url", F.lit("")))
    return known.unseen(keep_first_by(fit, key, arrival), "job_id")


def extract(rows: DataFrame, known: IdStore, path: str, run: int, arrival: list[str], terms: dict[str, list[str]] | None = None) -> DataFrame:
    """Append the new postings as JSON lines per category and remember their ids; returns what this run has added.

    A run that stopped is repeated under its number: it replaces its own files, and its ids are written last.
    """
    spark = rows.sparkSession
    here = f"{path.rstrip('/')}/run={run}"
    key = f"run-{run}"
    if not known.table.committed(key):
        found = new_postings(rows, known, arrival, terms)
        found.hint("rebalance", F.col("category")).write.mode("overwrite").partitionBy("category").json(here)
        known.add(spark.read.schema(rows.schema).json(here), key)
    return spark.read.schema(rows.schema).json(here)
