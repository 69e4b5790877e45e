"""Selection and joins, with a key that holds a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from jobstrata.operators import joins, select
from tests.helpers import plan_of

N = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(400)}", rng.randrange(50), i) for i in range(N)]
    return rows, spark.createDataFrame(rows, "key string, ts int, id int").repartition(6)


def test_latest_matches_brute_force(skewed):
    rows, df = skewed
    best = {}
    for key, ts, i in rows:
        best[key] = max(best.get(key, (-1, -1)), (ts, i))
    got = {r.key: (r.ts, r.id) for r in select.keep_latest(df, ["key"], "ts", ["id"]).collect()}
    assert got == best


def test_dedup_is_idempotent_and_trims_before_the_shuffle(skewed):
    _, df = skewed
    once = select.keep_first(df, ["key"], ["id"])
    assert sorted(once.collect()) == sorted(select.keep_first(once, ["key"], ["id"]).collect())
    plan = plan_of(once)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_first_n_per_key(skewed):
    rows, df = skewed
    got = select.per_key(df, ["key"], [F.desc("ts"), F.asc("id")], 4)
    want = {}
    for key, ts, i in sorted(rows, key=lambda r: (-r[1], r[2])):
        want.setdefault(key, []).append(i)
    assert sorted((r.key, r.id) for r in got.collect()) == sorted((k, i) for k, v in want.items() for i in v[:4])


def test_daily_unique_keeps_days_apart(spark):
    rows = [("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 12:00:00"), ("a", "2024-01-02 01:00:00")]
    df = spark.createDataFrame(rows, "id string, t string").withColumn("ts", F.col("t").cast("timestamp"))
    kept = select.daily_unique(df, "id", "ts", ["t"]).select("t").collect()
    assert sorted(r.t for r in kept) == ["2024-01-01 12:00:00", "2024-01-02 01:00:00"]


def test_count_top_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [tuple(r) for r in select.count_top(df, ["k"], 2).collect()] == [("c", 2), ("a", 1)]


def test_anti_join_survives_null_ids(spark, no_broadcast):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    seen = spark.createDataFrame([("a",), (None,), ("",)], "id string")
    assert {r.id for r in joins.not_in(df, seen, ["id"]).collect()} == {"b", None}
    assert {r.id for r in joins.new_only(df, seen, "id").collect()} == {"b"}
    assert {r.id for r in joins.in_both(df, seen, ["id"]).collect()} == {"a"}
    assert "isNullAware" not in plan_of(joins.not_in(df, seen, ["id"])) or "isNullAware=false" in plan_of(
        joins.not_in(df, seen, ["id"])
    )


def test_lookup_keeps_rows_and_matches_null_keys(spark, no_broadcast):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, None, None), (4, "b", None)], "i int, k string, m string")
    counts = df.groupBy("k", "m").agg(F.count("*").alias("n"), F.max("i").alias("top"))
    got = joins.attach_lookup(df, counts, ["k", "m"], ["n", "top"])
    assert sorted((r.i, r.n, r.top) for r in got.collect()) == [(1, 1, 1), (2, 1, 2), (3, 1, 3), (4, 1, 4)]
    assert got.columns == ["i", "k", "m", "n", "top"]


def test_hot_key_is_split_by_adaptive_execution(spark, no_broadcast):
    """The row count stays whole and the hot key's partition is read in several pieces."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(60_000).repartition(8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"), "id"
        )
        lookup = rows.groupBy("key").agg(F.count("*").alias("n"))
        for joined, total in (
            (joins.attach_lookup(rows, lookup, ["key"], ["n"]), 60_000),
            (joins.attach_lookup(rows, lookup, ["key"], ["n"], "inner"), 60_000),
            (joins.in_both(rows, rows, ["key"]), 60_000),
            # Copies of a key alone compress well: the hot one stands out where the others are few.
            (joins.narrow_history(rows.filter("key = 'hot' OR id < 100"), rows, "key"), 20_066),
            (joins.not_in(rows, rows.filter("key != 'hot'"), ["key"]), 20_000),
        ):
            assert len(joined.collect()) == total
            assert "skew=true" in plan_of(joined)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_reconcile_matches_counts(spark):
    upper = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("c", 2)], "id string, day int")
    lower = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("c", 1)], "id string, day int")
    got = {r.day: (r.ids_upper, r.ids_lower, r.difference) for r in joins.reconcile(upper, lower, "id", "day").collect()}
    assert got == {1: (2, 1, 1), 2: (1, 0, 1)}


def test_layer_difference(spark):
    upper = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    lower = spark.createDataFrame([("a",), (None,)], "id string")
    assert [r.id for r in joins.layer_difference(upper, lower, "id").collect()] == ["b"]
