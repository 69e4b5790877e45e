"""Table reads, snapshots and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_filtered(spark: SparkSession, table: str, rule: Column) -> DataFrame:
    return spark.read.table(table).filter(rule)


def snapshot_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/snapshot={version}"


def latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Newest ``snapshot=`` folder below ``root``; versions sort as text.

    The newest name is looked up from the listing alone, and the read is pruned to it.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    base = hadoop.Path(root)
    listing = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(base)
    names = [s.getPath().getName() for s in listing]
    versions = sorted(n for n in names if n.startswith("snapshot="))
    if not versions:
        raise FileNotFoundError(f"no snapshot under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{versions[-1]}")


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per named table; the counts run side by side in one job."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def audit_counts(spark: SparkSession, word: str = "gold", database: str | None = None) -> DataFrame:
    """Rows of every catalogue table whose name contains ``word``."""
    listed = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    names = [t.name for t in listed if word in t.name]
    prefix = f"{database}." if database else ""
    if not names:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    return table_counts({n: spark.table(prefix + n) for n in names})
