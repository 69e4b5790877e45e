"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

All stages but the last return the columns of ``documents``. A stage works on everything its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.llm import language_id, line_dedup, packing, quality, simhash_dedup
from jobstrata.llm.common import materialize
from jobstrata.llm.queries import vocabulary
from jobstrata.session import fresh_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; the others go."""
    return language_id.accept(docs, language_id.learn(docs))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by ``labels``, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    described = quality.features(docs, [F.col("doc_id").cast("long").alias("doc_id")])
    return quality.accept(docs, quality.learn(quality.with_labels(materialize(described, "statistics"), labels)))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines whose template an earlier document has; none is dropped."""
    return line_dedup.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links."""
    return simhash_dedup.deduplicate(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, in their sequences."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("language", language),
    ("quality", quality_filter),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("packing", pack),
]
# The classifiers are not SQL; tests hold the stages against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the whole table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
