"""Connected components of an edge table by alternating stars, in Spark jobs only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.common import materialize
from jobstrata.operators.joins import attach_lookup


def _both_ways(edges: DataFrame) -> DataFrame:
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.unionByName(turned)


def _least(edges: DataFrame) -> DataFrame:
    """Each node's least neighbour, or itself. Partial minima, so a node with very many edges moves few rows."""
    return edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Greater neighbours of each node move to its least neighbour."""
    both = _both_ways(edges)
    moved = attach_lookup(both, _least(both), ["a"], ["least"]).filter("b > a")
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Lesser neighbours of each node, and the node, move to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    moved = attach_lookup(down, least, ["a"], ["least"]).select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return moved.unionByName(own).filter("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node reachable) of every node that has an edge to another one.

    ``edges`` has two long columns a and b. Every round is written to the shared folder, so the lineage stays short and a
    lost executor costs one round at most. The number of rounds grows with the logarithm of the longest chain.
    """
    edges = materialize(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before, now = None, _state(edges)
    while now != before:
        edges = materialize(_small_star(_large_star(edges)), "stars")
        before, now = now, _state(edges)
    # Every node but the roots has one edge left, to its root.
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
