"""Pick rows per key: latest, first, last n, top n.

Ranks are compared with a constant, so Spark trims every key to the rows it needs before the
shuffle. A key that holds a third of the table sends only those few rows per input task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) <= n).drop(_RANK)


def keep_latest(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str]) -> DataFrame:
    """One row per key: the newest, ties broken by ``tiebreak`` descending."""
    return per_key(df, keys, [F.desc_nulls_last(ts)] + [F.desc_nulls_last(c) for c in tiebreak], 1)


def keep_first(df: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """One row per key: the one that arrived first."""
    return per_key(df, keys, [F.asc_nulls_last(c) for c in arrival], 1)


def keep_first_by(df: DataFrame, key: Column, arrival: list[str]) -> DataFrame:
    """As ``keep_first`` for a computed key (such as id, else url)."""
    return keep_first(df.withColumn("_key", key), ["_key"], arrival).drop("_key")


def daily_unique(df: DataFrame, key: str, ts: str, tiebreak: list[str]) -> DataFrame:
    """One row per key and day, the newest."""
    return keep_latest(df.withColumn("_day", F.to_date(ts)), [key, "_day"], ts, tiebreak).drop("_day")


def last_n(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str], n: int) -> DataFrame:
    """The newest ``n`` rows of each key with their position."""
    window = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(ts), *[F.desc_nulls_last(c) for c in tiebreak])
    return df.withColumn("position", F.row_number().over(window)).filter(F.col("position") <= n)


def rank_all(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number every row. The frame has to be an aggregate with a bounded number of rows."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows overall; each task keeps ``n``, no full sort."""
    return df.orderBy(*order).limit(n)


def count_top(df: DataFrame, keys: list[str], n: int | None = None, name: str = "n") -> DataFrame:
    """Rows per key, most frequent first, ties by key."""
    out = df.groupBy(*keys).agg(F.count("*").alias(name))
    if n is None:
        return out
    return top(out, [F.desc(name)] + [F.asc_nulls_last(k) for k in keys], n)
