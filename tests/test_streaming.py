"""Streams: layers, dedup, current state, alerts."""

import json

from pyspark.sql import functions as F

from jobstrata.catalog.base import ORDERS_DAY
from jobstrata.plans import medallion
from jobstrata.sources.files import read_bronze
from jobstrata.streaming import alerts, dedup, layers
from jobstrata.streaming.current import CurrentState
from jobstrata.streaming.runs import append_parquet, each_batch, observed_totals, run_to_end

FIELDS = [f for f in medallion.schemas.GOLD if f != "ingestion_timestamp"]


def posting(i, **more):
    return {
        "job_id": f"j{i}", "title": f" Dev  {i}", "company": "Acme", "location": "Recife, PE", "description_length": 100 * i,
        "posted_time": "2001-07-15T10:00:00", "extract_timestamp": f"2025-09-02T10:{i:02d}:00", "salary_min": "R$ 9000", "category": "data_engineer",
    } | more


def land(root, day, name, rows):
    folder = root / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")


def test_three_runs_equal_one_batch(spark, tmp_path):
    source, target = tmp_path / "landing", str(tmp_path / "lake")
    gold = None
    counted = {}
    for step, day in enumerate(("2025-09-02", "2025-09-03", "2025-09-04")):
        rows = [posting(10 * step + i) for i in range(5)] + [posting(90 + step, title=None), posting(80 + step, job_id="")]
        land(source, day, f"data_engineer_{day}.jsonl", rows)
        land(source, day, f"data_analytics_{day}.jsonl", [posting(70)])
        gold = layers.run_domain(spark, str(source), target, "data_engineer", ORDERS_DAY, report=counted)
    streamed = gold.select(FIELDS)
    batch = medallion.refine(read_bronze(spark, str(source), "data_engineer"), ORDERS_DAY).select(FIELDS)
    assert streamed.count() == 15
    assert counted["silver_stg"] == {"total": 7, "job_id_not_null": 7, "title_not_null": 6, "company_not_null": 7, "location_not_null": 7}
    assert counted["silver_md"] == {"total": 5, "unique_job_id": 5, "valid_location": 5}
    assert counted["gold"] == {"total": 5, "has_job_id": 5, "has_ingestion_ts": 5}
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    row = streamed.filter("job_id = 'j11'").first()
    assert (row.title, row.city, row.state, row.is_premium_salary, row.is_recent_posting) == ("dev 11", "recife", "pe", True, True)


def test_domain_without_files_gives_an_empty_layer(spark, tmp_path):
    land(tmp_path / "landing", "2025-09-02", "data_engineer_x.jsonl", [posting(1)])
    gold = layers.run_all(spark, str(tmp_path / "landing"), str(tmp_path / "lake"), ORDERS_DAY)
    assert [(r.domain, r.job_id) for r in gold.collect()] == [("data_engineer", "j1")]


def test_unique_staging(spark, tmp_path):
    land(tmp_path / "landing", "2025-09-02", "data_engineer_a.jsonl", [posting(1), posting(1), posting(2)])
    run = lambda: layers.run_domain(spark, str(tmp_path / "landing"), str(tmp_path / "lake"), "data_engineer", ORDERS_DAY, unique=True)
    run()
    land(tmp_path / "landing", "2025-09-03", "data_engineer_b.jsonl", [posting(1), posting(3)])
    assert sorted(r.job_id for r in run().collect()) == ["j1", "j2", "j3"]


def test_unique_staging_keeps_rows_without_a_time_or_an_id(spark, tmp_path):
    rows = [posting(1), posting(1), posting(2) | {"extract_timestamp": None}, posting(3) | {"extract_timestamp": "soon"}]
    land(tmp_path / "landing", "2025-09-02", "data_engineer_a.jsonl", rows)
    gold = layers.run_domain(spark, str(tmp_path / "landing"), str(tmp_path / "lake"), "data_engineer", ORDERS_DAY, unique=True)
    assert sorted(r.job_id for r in gold.collect()) == ["j1", "j2", "j3"]


def dedup_run(spark, source, out, ckpt, salts):
    stream = spark.readStream.schema("key string, ts timestamp, id int").json(source)
    run_to_end(append_parquet(dedup.drop_repeats(stream, ["key"], "ts", "1 hour", salts), out, ckpt))
    return sorted((r.key, r.id) for r in spark.read.schema("key string, ts timestamp, id int").parquet(out).collect())


def test_stream_dedup_and_late_rows(spark, tmp_path):
    """A repeat within the delay is dropped, a row behind the watermark is dropped as late."""
    for salts in (1, 4):
        base = tmp_path / str(salts)
        (base / "in").mkdir(parents=True)
        put = lambda name, rows: (base / "in" / name).write_text("\n".join(json.dumps(r) for r in rows))
        args = (spark, str(base / "in"), str(base / "out"), str(base / "ckpt"), salts)
        put("1.json", [{"key": "a", "ts": "2024-01-01 10:00:00", "id": 1}, {"key": "b", "ts": "2024-01-01 10:30:00", "id": 2}])
        assert dedup_run(*args) == [("a", 1), ("b", 2)]
        put("2.json", [{"key": "a", "ts": "2024-01-01 10:20:00", "id": 3}, {"key": "c", "ts": "2024-01-01 14:00:00", "id": 4}])
        assert dedup_run(*args) == [("a", 1), ("b", 2), ("c", 4)]
        put("3.json", [{"key": "d", "ts": "2024-01-01 09:00:00", "id": 5}, {"key": "e", "ts": "2024-01-01 13:30:00", "id": 6}])
        assert dedup_run(*args) == [("a", 1), ("b", 2), ("c", 4), ("e", 6)]


def test_current_state_rerun_changes_nothing(spark, tmp_path):
    state = CurrentState(spark, str(tmp_path / "s"), ["k"], "ts", ["v"])
    rows = lambda *data: spark.createDataFrame(list(data), "k string, ts int, v string")
    state.apply(rows(("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")), 0)
    state.apply(rows(("a", 1, "old"), ("b", 5, "new")), 1)
    want = [("a", "y"), ("b", "new")]
    read = lambda s: sorted((r.k, r.v) for r in s.read().collect())
    assert read(state) == want
    state.apply(rows(("a", 1, "old"), ("b", 5, "new")), 1)
    assert read(state) == want
    compacted = state.compact(str(tmp_path / "s2"))
    assert read(compacted) == want
    compacted.apply(rows(("c", 1, "c")), 2)
    assert read(compacted) == want + [("c", "c")]


def test_alerts_once_per_posting(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = "job_id string, category string, title string, company string"
    history = spark.createDataFrame([("known",), (None,)], "job_id string")
    sink = alerts.AlertSink(spark, str(tmp_path / "out"), history, ["title"])

    def run(name, rows):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(r) for r in rows))
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        run_to_end(each_batch(stream, sink.apply, str(tmp_path / "ckpt")))

    row = lambda i, title="Dev": {"job_id": i, "category": "data_engineer", "title": title, "company": "A"}
    run("1.json", [row("a", "Senior Dev"), row("a", "Senior Dev"), row("known"), row("")])
    run("2.json", [row("a"), row("b")])
    sent = spark.read.schema("job_id string, key string, value string, batch bigint").json(str(tmp_path / "out" / "alerts"))
    got = sorted((r.job_id, r.key, json.loads(r.value)["priority"]) for r in sent.collect())
    assert got == [("a", "data_engineer", "HIGH"), ("b", "data_engineer", "MEDIUM")]
    assert json.loads(sent.filter("job_id = 'a'").first().value)["job_data"]["title"] == "Senior Dev"


def test_timer_trigger_and_checkpoint(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"id": 1}')
    stream = spark.readStream.schema("id bigint").json(str(tmp_path / "in"))
    query = append_parquet(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), every="1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.schema("id bigint").parquet(str(tmp_path / "out")).agg(F.sum("id")).first()[0] == 1
    assert (tmp_path / "ckpt" / "offsets").exists()


def test_totals_count_batches_that_the_query_no_longer_remembers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(5):
        (tmp_path / "in" / f"{n}.json").write_text(f'{{"id": {n}}}')
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    seen = stream.observe("rows", F.count("*").alias("total"))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with observed_totals(spark) as totals:
            query = append_parquet(seen, str(tmp_path / "out"), str(tmp_path / "ckpt"))
            run_to_end(query)
            assert totals.of(query) == {"rows": {"total": 5}}
        assert len(query.recentProgress) < 5
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
