"""The row after each row in the order of a key, without gathering the order in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobstrata.llm.common import materialize
from jobstrata.operators.joins import attach_lookup


def with_next(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (distinct in ``keys``, narrow) with a struct ``next`` of the keys of the row after; the last gets the first.

    Rows are dealt into ranges and written, so that the ranges are fixed. Inside a range a window finds the next row; over
    ranges only the first row of each is looked at, one row per range.
    """
    ranged = rows.repartitionByRange(*keys).withColumn("range", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    key = F.struct(*keys)
    inside = ranged.withColumn("next", F.lead(key).over(Window.partitionBy("range").orderBy(*keys)))
    heads = ranged.groupBy("range").agg(F.min(key).alias("head"))
    every = Window.orderBy("range")
    after = F.coalesce(F.lead("head").over(every), F.first("head").over(every))
    heads = heads.withColumn("after", after).select("range", "after")
    out = attach_lookup(inside, heads, ["range"], ["after"])
    return out.select(*rows.columns, F.coalesce("next", "after").alias("next"))
