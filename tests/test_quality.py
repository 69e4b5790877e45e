"""Expectations, profiles and thresholds."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from jobstrata.operators import quality


@pytest.fixture(scope="module")
def rows(spark):
    data = [("a", "t", 1.0), ("a", "t", 2.0), (None, "t", 3.0), ("b", None, 4.0), ("c", "", None)]
    return spark.createDataFrame(data, "job_id string, title string, v double")


def test_warn_counts_and_keeps(rows):
    report = {r.rule: (r.passed, r.failed) for r in quality.expectation_report(rows, {"id": "job_id IS NOT NULL", "title": "length(title) > 0"}).collect()}
    assert report == {"id": (4, 1), "title": (3, 2)}


def test_watch_counts_while_rows_flow_by(rows):
    seen = Observation("rules")
    assert quality.watch(rows, {"title": "length(title) > 0"}, seen).count() == 5
    assert seen.get == {"total": 5, "title": 3}


def test_drop_treats_null_as_failure(rows):
    assert quality.keep_valid(rows, {"title": "length(title) > 0"}).count() == 3


def test_fail_raises_and_warn_does_not(rows):
    with pytest.raises(quality.ExpectationFailed, match="job_id_not_null: 1 rows"):
        quality.enforce(rows, quality.layer_checks("bronze"))
    only_warn = [quality.Check("v", "v IS NOT NULL", "WARN")]
    assert quality.enforce(rows, only_warn) is rows


def test_uniqueness_counts_surplus_rows(rows):
    report = quality.check_report(rows, [quality.Check("unique", "job_id", "FAIL", unique=True)]).first()
    assert report.violations == 1


def test_profile_skips_distinct_of_empty_columns(spark):
    df = spark.createDataFrame([(i, "x" if i == 0 else None, "k") for i in range(20)], "i int, rare string, same string")
    got = {r.column: r for r in quality.profile(df).collect()}
    assert (got["i"].distinct_count, got["i"].unique_ratio) == (20, 1.0)
    assert (got["rare"].null_count, got["rare"].distinct_count, got["rare"].unique_ratio) == (19, 0, 0.0)
    assert got["same"].distinct_count == 1
    near = {r.column: r.distinct_count for r in quality.profile_approx(df).collect()}
    assert near == {"i": 20, "rare": 0, "same": 1}


def test_top_values_share_one_shuffle(spark):
    df = spark.createDataFrame([(str(i % 3), str(i), None if i % 2 else "n") for i in range(60)], "few string, many string, half string")
    top = quality.top_values(df, n=2)
    assert {(r.column, r.value, r.freq) for r in top.collect()} == {("few", "0", 20), ("few", "1", 20), ("half", "n", 30)}
    starts = quality.top_starts(df, df.columns, 2, 0.1)
    starts.collect()
    assert "ReusedExchange" in starts._jdf.queryExecution().executedPlan().toString()


def test_top_values_of_long_texts(spark):
    """Values that begin alike are told apart and ordered by what follows; no text is in an exchange."""
    same = "x" * 80
    df = spark.createDataFrame([(same + "bca"[i % 3], "short" if i % 2 else None, f"{i}" * 50) for i in range(90)], "long string, half string, own string")
    top = quality.top_values(df, n=2)
    assert sorted((r.column, r.value[-1], r.freq) for r in top.collect()) == [("half", "t", 45), ("long", "a", 30), ("long", "b", 30)]
    starts = quality.top_starts(df, df.columns, 2, 0.1)
    assert starts.agg(F.max(F.length("start"))).first()[0] <= quality.SHORT and "start" in starts.columns and "value" not in starts.columns


def test_thresholds(rows):
    ratios = quality.layer_ratios(rows, ["job_id"], ["job_id", "title"])
    got = {(r.layer, r.metric): (round(r.value, 2), r.ok) for r in quality.threshold_check({"bronze": ratios, "silver": ratios}).collect()}
    assert got == {
        ("bronze", "null_ratio"): (0.2, False), ("bronze", "duplicate_ratio"): (0.2, False),
        ("silver", "null_ratio"): (0.2, False), ("silver", "completeness"): (0.6, False),
    }


def test_layer_ratio_of_nothing(spark):
    empty = spark.createDataFrame([], "job_id string")
    assert quality.layer_ratios(empty, ["job_id"], ["job_id"]).first().null_ratio is None


def test_duplicate_audit(rows):
    assert [tuple(r) for r in quality.duplicate_audit(rows, ["job_id"]).collect()] == [("a", 2, True)]
