"""The chain from scraped rows to new postings."""

import pytest
from pyspark.sql import functions as F

from jobstrata.plans.extraction import extract, new_postings
from jobstrata.sources.idstore import IdStore

ROWS = "n int, job_id string, title string, company string, category string, url string"
TERMS = {"data_engineer": ["spark"]}


def rows(spark, *data):
    return spark.createDataFrame(list(data), ROWS)


def test_the_first_complete_row_of_an_unknown_id(spark, tmp_path):
    known = IdStore(spark, str(tmp_path / "ids"))
    known.add(spark.createDataFrame([("old",)], "job_id string"), "history")
    df = rows(
        spark, (1, "a", "", "c", "data_engineer", "u"), (2, "a", "Spark", "c", "data_engineer", "u"), (3, "a", "Spark II", "c", "data_engineer", "u"),
        (4, "b", "Cook", "c", "data_engineer", "u"), (5, "c", "Cook", "c", "other", "u"), (6, "old", "Spark", "c", "data_engineer", "u"),
        (7, None, "Spark", "c", "data_engineer", "v"), (8, "d", "Spark", None, "data_engineer", "u"),
    )
    assert sorted((r.n, r.job_id) for r in new_postings(df, known, ["n"], TERMS).collect()) == [(2, "a"), (5, "c")]


def test_a_run_that_stopped_adds_its_rows_once(spark, tmp_path):
    known, out = IdStore(spark, str(tmp_path / "ids")), str(tmp_path / "out")
    df = rows(spark, (1, "a", "Spark", "c", "data_engineer", "u"), (2, "b", "x", "c", "other", "u"))
    add, known.add = known.add, lambda *x: (_ for _ in ()).throw(RuntimeError("stopped"))
    with pytest.raises(RuntimeError):
        extract(df, known, out, 0, ["n"], TERMS)
    known.add = add
    assert sorted(r.job_id for r in extract(df, known, out, 0, ["n"], TERMS).collect()) == ["a", "b"]
    assert sorted(r.job_id for r in extract(df, known, out, 0, ["n"], TERMS).collect()) == ["a", "b"]
    more = df.unionByName(rows(spark, (3, "c", "x", "c", "other", "u")))
    assert [r.job_id for r in extract(more, known, out, 1, ["n"], TERMS).collect()] == ["c"]
    everything = spark.read.json(out)
    assert everything.count() == 3 and len(everything.inputFiles()) == 3 and everything.select(F.max("run")).first()[0] == 1
