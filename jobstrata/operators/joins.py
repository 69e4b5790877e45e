"""Joins, anti joins and layer differences.

Skew: adaptive execution splits a hot key only where both inputs of a join are fresh
shuffles. An input that was just aggregated already has the join's partitioning and would get
none, so these joins add a hash of the keys as one more key, which makes Spark shuffle the
(small, one row per key) aggregated side once more and leaves the other side splittable.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.operators.select import keep_latest

_HASH = "_key_hash"


def _hashed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumn(_HASH, F.xxhash64(*keys))


def _filtering_join(df: DataFrame, seen: DataFrame, keys: list[str], how: str) -> DataFrame:
    known = _hashed(seen.select(*keys).distinct(), keys)
    return _hashed(df, keys).join(known, [*keys, _HASH], how).select(*df.columns)


def not_in(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key does not occur in ``seen``; NULL keys in ``seen`` change nothing."""
    return _filtering_join(df, seen, keys, "left_anti")


def in_both(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs in ``seen``."""
    return _filtering_join(df, seen, keys, "left_semi")


def usable(key: str) -> Column:
    return F.col(key).isNotNull() & (F.col(key).cast("string") != "")


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    """All known ids of a history, without NULL and empty ones."""
    return df.filter(usable(key)).select(key).distinct()


def new_only(df: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Rows with a usable id that the history has never seen."""
    return not_in(df.filter(usable(key)), history.filter(usable(key)), [key])


def narrow_history(history: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """The part of a large history that the ids of a small frame can meet.

    When the ids pass Spark's broadcast check the history is filtered as it is read and never
    shuffled; otherwise this is an ordinary semi join. Use it where ``df`` is a micro-batch.
    """
    return in_both(history.select(key), df.filter(usable(key)), [key])


def layer_difference(upper: DataFrame, lower: DataFrame, key: str) -> DataFrame:
    """Ids of ``upper`` that ``lower`` lacks."""
    return distinct_ids(upper, key).join(distinct_ids(lower, key), key, "left_anti")


def attach_lookup(
    df: DataFrame, lookup: DataFrame, keys: list[str], columns: list[str], how: str = "left"
) -> DataFrame:
    """Add columns of a table with one row per key; NULL keys match each other."""
    left = _hashed(df, keys)
    right = _hashed(lookup.select(*keys, *columns), keys)
    for k in [*keys, _HASH]:
        right = right.withColumnRenamed(k, f"_r_{k}")
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in [*keys, _HASH]])
    return left.join(right, match, how).select(*df.columns, *columns)


def outer_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "full_outer")


def reconcile(upper: DataFrame, lower: DataFrame, key: str, day: str) -> DataFrame:
    """Distinct ids per day in two layers and how many the lower one lacks.

    Both sides are reduced to distinct (id, day) first: repeated rows never meet in the join.
    """
    first = upper.select(key, day).distinct()
    second = lower.select(key, day).distinct().withColumn("_found", F.lit(1))
    joined = first.join(second, [key, day], "left")
    return (
        joined.groupBy(day)
        .agg(F.count(key).alias("ids_upper"), F.count("_found").alias("ids_lower"))
        .withColumn("difference", F.col("ids_upper") - F.col("ids_lower"))
    )


def latest_lookup(df: DataFrame, key: str, ts: str, tiebreak: list[str]) -> DataFrame:
    """One row per key for use as a lookup."""
    return keep_latest(df, [key], ts, tiebreak)
