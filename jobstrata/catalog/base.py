"""Registry of runnable queries and the posting view over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Run = Callable[[SparkSession, str], DataFrame]

# Reference days inside the time range of the tables.
EVENTS_DAY = "2024-01-31"
POSTINGS_DAY = "2024-01-05"
ORDERS_DAY = "2001-08-02"


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query with the SQL that must give the same rows."""

    def add(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, run, sql)
        return run

    return add


_stored: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the files once, which saves a job per read."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _stored:
        _stored[path] = spark.read.parquet(path).schema
    return spark.read.schema(_stored[path]).parquet(path)


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, whether it is stored as one file or as a folder of files."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(location).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


# Posting fields as SQL that both engines read alike, grouped by the table they need.
_DOCUMENT = {
    "doc_id": "d.doc_id",
    "job_id": "CASE WHEN d.doc_id % 97 = 96 THEN NULL ELSE 'job_' || d.doc_id END",
    "company": "d.source || CASE d.doc_id % 4 WHEN 0 THEN ' ltda' WHEN 1 THEN ' inc' WHEN 2 THEN ' casa' ELSE '' END",
    "category": "CASE d.doc_id % 3 WHEN 0 THEN 'data_engineer' WHEN 1 THEN 'data_analytics' ELSE 'digital_analytics' END",
    "type": (
        "CASE d.doc_id % 8 WHEN 0 THEN 'full-time' WHEN 1 THEN 'part time' WHEN 2 THEN 'contract' "
        "WHEN 3 THEN 'remoto' WHEN 4 THEN 'hybrid' WHEN 5 THEN 'clt' WHEN 6 THEN 'other' END"
    ),
    "url": "CASE WHEN d.doc_id % 9 = 0 THEN '' ELSE 'https://jobs.example.com/' || d.doc_id END",
    "source": "d.source",
    "lang": "d.lang",
    "description": "d.text",
    "description_length": "d.n_chars",
    "has_salary": "CASE d.doc_id % 4 WHEN 0 THEN false WHEN 1 THEN true END",
}
_TITLE = {
    "title": (
        "CASE d.doc_id % 60 WHEN 59 THEN NULL WHEN 58 THEN '' ELSE "
        "CASE CAST(floor(d.doc_id / 7) AS bigint) % 8 WHEN 0 THEN 'Senior ' WHEN 1 THEN 'Pleno ' WHEN 2 THEN 'Junior ' "
        "WHEN 3 THEN 'Head of ' WHEN 4 THEN 'Leadership ' WHEN 5 THEN 'Estágio ' WHEN 6 THEN 'Freelancer ' "
        "ELSE '' END || p.p_name END"
    )
}
_PLACE = {
    "location": (
        "CASE WHEN d.doc_id % 40 = 39 THEN NULL WHEN d.doc_id % 40 = 38 THEN 'BR' ELSE "
        "CASE d.doc_id % 7 WHEN 0 THEN n.n_name || ' - ' || r.r_name || ', ' || d.lang "
        "WHEN 1 THEN n.n_name || ', ' || r.r_name || ', ' || d.lang "
        "WHEN 2 THEN n.n_name WHEN 3 THEN n.n_name || ', ' || r.r_name || ' (remote)' "
        "WHEN 4 THEN n.n_name || ' (hybrid)' WHEN 5 THEN n.n_name || ', ' || upper(d.lang) "
        "ELSE n.n_name || ' - presencial' END END"
    ),
    "location_country": "r.r_name",
}
_POSTED = {"posted_time_ts": "CASE WHEN d.doc_id % 10 = 0 THEN NULL ELSE o.o_orderdate END"}
_INGESTED = {"ingestion_timestamp": "e.ts"}
_SALARY = {
    "salary_low": "CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE CAST(c.c_acctbal AS decimal(12,2)) END",
    "salary_high": "CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE CAST(c.c_acctbal AS decimal(12,2)) + CAST(1500 AS decimal(12,2)) END",
}
_PARTS = {
    "title": (_TITLE, [("part", "p", "p.p_partkey = d.doc_id")]),
    "place": (
        _PLACE,
        [("nation", "n", "n.n_nationkey = d.doc_id % 25"), ("region", "r", "r.r_regionkey = n.n_regionkey")],
    ),
    "posted": (_POSTED, [("orders", "o", "o.o_orderkey = d.doc_id")]),
    "ingested": (_INGESTED, [("events", "e", "e.event_id = d.doc_id")]),
    "salary": (_SALARY, [("customer", "c", "c.c_custkey = d.doc_id")]),
}


def _select(parts: tuple[str, ...]) -> tuple[dict[str, str], list[tuple[str, str, str]]]:
    columns, joins = dict(_DOCUMENT), []
    for part in parts:
        more, tables = _PARTS[part]
        columns |= more
        joins += tables
    return columns, joins


def postings(
    spark: SparkSession, sf_dir: str, *parts: str, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Postings built from ``documents``, joined only with the tables the parts need.

    ``prepare`` works on the document columns before anything is joined.
    """
    columns, joins = _select(parts)
    documents = table(spark, sf_dir, "documents").alias("d").select(
        *[F.expr(e).alias(c) for c, e in _DOCUMENT.items()]
    )
    if prepare:
        documents = prepare(documents)
    out = documents.alias("d")
    for name, alias, rule in joins:
        out = out.join(table(spark, sf_dir, name).alias(alias), F.expr(rule), "left")
    added = [F.expr(e).alias(c) for c, e in columns.items() if c not in _DOCUMENT]
    return out.select(*[F.col(f"d.{c}") for c in documents.columns], *added)


def postings_sql(*parts: str) -> str:
    """The same view as a common table expression named ``pv``."""
    columns, joins = _select(parts)
    fields = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    joined = " ".join(f"LEFT JOIN {t} {a} ON {rule}" for t, a, rule in joins)
    return f"pv AS (SELECT {fields} FROM documents d {joined})"


def over_postings(*parts: str, body: str, more: str = "") -> str:
    """SQL over the posting view; ``more`` adds further table expressions."""
    extra = f", {more}" if more else ""
    return f"WITH {postings_sql(*parts)}{extra} {body}"
