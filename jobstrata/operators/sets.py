"""Unions of domains and layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_labelled(frames: dict[str, DataFrame], label: str) -> DataFrame:
    """UNION ALL of frames with the same columns, each tagged with its name."""
    tagged = [df.withColumn(label, F.lit(name)) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)
