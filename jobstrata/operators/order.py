"""Neighbours in a total order, for keys of any size.

A window over a key gathers all its rows in one task. Here rows are range-sorted over all tasks and numbered in that order, and
each row is joined with the one that has the next number. That join is on a unique number, so a key that holds a third of all
rows, even at one instant, is spread like any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobstrata.session import materialize


def with_neighbour(
    df: DataFrame, keys: list[str], order: list[str], columns: list[str], prefix: str, after: bool = True
) -> DataFrame:
    """Add columns of the next (or previous) row of the same key, NULL where there is none.

    Keys are compared with NULL equal to NULL. Rows that tie in ``order`` stand in an arbitrary order.
    """
    sort = [*keys, *order, "_row"]
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    in_order = numbered.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("_row")
    placed = materialize(in_order.withColumn("_at", F.monotonically_increasing_id()), "in_order")
    # A number is the sorted part and the place in it; the last row of a part is followed by the first of the next one.
    parts = placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    window = Window.orderBy("_part")
    edge, to = ("_last", F.lead("_first").over(window)) if after else ("_first", F.lag("_last").over(window))
    # One row per sorted part.
    jumps = F.broadcast(parts.select(F.col(edge).alias("_edge"), to.alias("_jump")))
    step = F.when(F.col("_edge").isNotNull(), F.col("_jump")).otherwise(F.col("_at") + (1 if after else -1))
    rows = placed.join(jumps, F.col("_at") == F.col("_edge"), "left").withColumn("_to", step)
    other = placed.select(F.col("_at").alias("_to"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.lit(True))
    found = F.col("_found").isNotNull() & same
    joined = rows.join(other.withColumn("_found", F.lit(True)), "_to", "left")
    return joined.select(*df.columns, *[F.when(found, F.col(f"_c{i}")).alias(f"{prefix}{c}") for i, c in enumerate(columns)])
