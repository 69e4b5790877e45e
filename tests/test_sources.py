"""Readers, writers and payloads."""

import json

import pytest
from pyspark.sql import functions as F

from jobstrata import schemas
from jobstrata.sources import files, messages, payload, tables


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_bronze_reads_its_domain_and_rescues(spark, tmp_path):
    good = {"job_id": "a", "title": "Dev", "description_length": 5, "has_salary": False}
    lines = [
        json.dumps(good),
        json.dumps(good | {"job_id": "b", "batch_id": "x", "posted_date": "2025-09-02"}),
        json.dumps(good | {"job_id": "c", "description_length": "long"}),
        "{broken",
        "",
    ]
    write(tmp_path / "2025-09-02" / "data_engineer" / "Data_Engineer_20250902.JSONL", lines)
    write(tmp_path / "2025-09-02" / "data_analytics" / "data_analytics_20250902.jsonl", lines)
    write(tmp_path / "2025-09-02" / "data_engineer" / "data_engineer_notes.txt", lines)
    rows = {r.job_id: r for r in files.read_bronze(spark, str(tmp_path), "data_engineer").collect()}
    assert set(rows) == {"a", "b", "c", None}
    assert rows["a"]._rescued_data is None
    assert rows["b"]._rescued_data == {"batch_id": "x", "posted_date": "2025-09-02"}
    assert rows["c"]._rescued_data == {"description_length": "long"} and rows["c"].description_length is None
    assert rows["c"].title == "Dev"
    assert rows[None]._rescued_data == {"_corrupt_record": "{broken"}
    assert all(r.extract_date == "2025-09-02" for r in rows.values())
    assert rows["a"].source_file.endswith("Data_Engineer_20250902.JSONL")


def test_bronze_reads_arrays_of_one_line(spark, tmp_path):
    good = {"job_id": "a", "title": "Dev", "description_length": 5, "has_salary": False}
    more = [good, good | {"job_id": "b", "batch_id": "x"}, good | {"job_id": "c", "title": "[x], {y}"}]
    folder = tmp_path / "2025-09-02" / "data_engineer"
    write(folder / "data_engineer_1.json", ["  " + json.dumps(more)])
    write(folder / "data_engineer_2.json", ["[]", json.dumps(good | {"job_id": "d"}), '[{"job_id": "e"'])
    rows = {r.job_id: r for r in files.read_bronze(spark, str(tmp_path), "data_engineer").collect()}
    assert set(rows) == {"a", "b", "c", "d", None}
    assert rows["a"]._rescued_data is None and rows["a"].description_length == 5
    assert rows["b"]._rescued_data == {"batch_id": "x"} and rows["c"].title == "[x], {y}"
    assert rows[None]._rescued_data == {"_corrupt_record": '[{"job_id": "e"'}


def test_raw_json_arrays_and_table(spark, tmp_path):
    write(tmp_path / "jobs.json", [json.dumps([{"a": 1}, {"a": 2}], indent=1)])
    assert files.read_raw_json(spark, str(tmp_path / "*.json"), multiline=True).count() == 2
    made = files.register_raw(spark, "raw_array_jobs", str(tmp_path), True, "raw jobs", {"quality": "raw", "o'k": "x"})
    assert made.agg(F.sum("a")).first()[0] == 3
    shown = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES raw_array_jobs").collect()}
    assert shown["quality"] == "raw"
    spark.sql("DROP TABLE raw_array_jobs")


def test_layer_table_is_tagged(spark, tmp_path):
    name = "layer_jobs_gold"
    spark.sql(f"CREATE TABLE {name} (id bigint, domain string) USING PARQUET PARTITIONED BY (domain) LOCATION '{tmp_path}'")
    rows = spark.range(4).withColumn("domain", F.when(F.col("id") < 3, "a").otherwise("b"))
    files.save_layer_table(rows, name, "gold", ["domain"])
    assert {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}["quality"] == "gold"
    assert [tuple(r) for r in tables.audit_counts(spark, "gold").filter(f"table_name = '{name}'").collect()] == [(name, 4)]
    spark.sql(f"DROP TABLE {name}")


def test_snapshots_sort_by_version(spark, tmp_path):
    for version, n in (("20240101", 1), ("20240301", 3), ("20240201", 2)):
        spark.range(n).write.parquet(tables.snapshot_path(str(tmp_path), version))
    assert tables.latest_snapshot(spark, str(tmp_path)).count() == 3
    with pytest.raises(FileNotFoundError):
        tables.latest_snapshot(spark, str(tmp_path / "snapshot=20240101"))


def test_kafka_options():
    plain = messages.kafka_source_options({"bootstrap_servers": "b:1", "topic": "jobs"})
    assert plain["subscribe"] == "jobs" and plain["startingOffsets"] == "latest" and plain["failOnDataLoss"] == "false"
    assert not any("sasl" in k or "ssl" in k for k in plain)
    secure = messages.kafka_source_options(
        {"bootstrap_servers": "b:1", "topic": "jobs", "security_protocol": "SASL_SSL", "sasl_mechanism": "PLAIN",
         "username": "u", "password": "p", "truststore": "/ca.pem"}
    )
    assert secure["kafka.security.protocol"] == "SASL_SSL"
    assert 'username="u" password="p"' in secure["kafka.sasl.jaas.config"]
    assert secure["kafka.ssl.endpoint.identification.algorithm"] == "https"


def test_messages_round_trip(spark):
    sent = messages.encode_messages(spark.createDataFrame([("a", "t")], "job_id string, title string"), F.lit("data_engineer"))
    back = messages.decode_messages(
        sent.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.current_timestamp().alias("timestamp")),
        schemas.MESSAGE,
    ).first()
    assert (back.job_id, back.title, back.type, back.kafka_key) == ("a", "t", "data_engineer", "data_engineer")


def test_gate_keeps_today(spark):
    rows = [("data_engineer", "x", "t", "c", "2025-10-06"), ("data_engineer", "x", "t", "c", "2025-10-05"),
            ("other", "x", "t", "c", "2025-10-06"), ("data_engineer", "x", None, "c", "2025-10-06")]
    df = spark.createDataFrame(rows, "category string, extract_timestamp string, title string, company string, extract_date string")
    assert messages.stream_gate(df, "2025-10-06").count() == 1


def items(spark, *data, as_of="2025-10-09"):
    body = json.dumps({"success": True, "data": list(data)})
    return payload.normalize_api_payload(spark.createDataFrame([(body,)], "value string"), "test", as_of).collect()


def test_payload_modalities(spark):
    remote, hybrid = items(
        spark,
        {"id": "1", "title": "Remote Engineer", "company": {"name": "A"}, "location": "São Paulo, Brazil (remote)", "url": "u", "listed_at": "2025-10-06"},
        {"id": "2", "title": "Hybrid Engineer", "company": {"name": "B"}, "location": "Rio de Janeiro (hybrid)", "url": "u", "listed_at": "2025-10-06"},
    )
    assert (remote.work_modality, remote.is_remote) == ("remote", True)
    assert (hybrid.work_modality, hybrid.is_remote) == ("hybrid", False)


def test_payload_dates(spark):
    recent, old, unreadable, none = items(
        spark,
        {"id": "1", "title": "t", "location": "Remote", "listed_at": "2025-10-06"},
        {"id": "2", "title": "t", "location": "Remote", "listed_at": "2025-10-01"},
        {"id": "3", "title": "t", "location": "Remote", "posted_at": "soon"},
        {"id": "4", "title": "t", "location": "Remote", "listed_at": ""},
    )
    assert (recent.posted_time_ts, recent.is_recent_posting) == ("2025-10-06T00:00:00", True)
    assert old.is_recent_posting is False
    assert (unreadable.posted_time_ts, unreadable.is_recent_posting) == ("2025-10-09T00:00:00", True)
    assert (none.posted_time_ts, none.is_recent_posting) == (None, False)


def test_payload_places_and_companies(spark):
    full, text_company, given = items(
        spark,
        {"id": "1", "title": "t", "company": {"name": "C", "id": "7", "url": "cu"}, "location": "São Paulo, SP, Brazil"},
        {"job_id": "2", "title": "t", "company": "Plain", "location": "São Paulo, Brazil", "link": "l"},
        {"id": "3", "title": "t", "location": "", "city": "Recife", "country": "Brazil"},
    )
    assert (full.city, full.state, full.country) == ("São Paulo", "SP", "Brazil")
    assert (full.company, full.company_id, full.company_url) == ("C", "7", "cu")
    assert (text_company.job_id, text_company.company, text_company.company_id, text_company.url) == ("2", "Plain", "", "l")
    assert (text_company.city, text_company.state, text_company.country) == ("São Paulo", "Brazil", "Brazil")
    assert (given.city, given.location) == ("Recife", "Recife, , Brazil")


def test_payload_needs_title_or_url(spark):
    kept = items(
        spark,
        {"id": "111", "title": "", "company": {}, "location": "", "url": "https://test.com", "listed_at": ""},
        {"id": "112", "title": "", "company": {}, "location": "", "url": ""},
    )
    assert [(r.job_id, r.job_title, r.company_name) for r in kept] == [("111", "", "")]
    assert kept[0].description_quality_score == "low" and kept[0].is_easy_apply is False
