"""Snapshot tables, id stores, exact dedup, sinks that commit each batch once."""

import json

import pytest
from pyspark.sql import functions as F

from jobstrata import schemas
from jobstrata.operators.changes import change_history
from jobstrata.operators.order import with_neighbour
from jobstrata.operators import quality
from jobstrata.operators.quality import Check, ExpectationFailed
from jobstrata.plans.feed import FeedStore
from jobstrata.plans.views import register_feed_tables
from jobstrata.sources import messages
from jobstrata.sources.files import append_jsonl, read_bronze
from jobstrata.sources.idstore import IdStore
from jobstrata.sources.snapshots import SnapshotTable
from jobstrata.streaming.current import ChangeHistory, CurrentState
from jobstrata.streaming.dedup import UniqueSink
from jobstrata.streaming.layers import Domain
from jobstrata.streaming.metrics import DailyMetrics
from jobstrata.streaming.profiles import ERROR, ColumnProfiles
from jobstrata.streaming.runs import each_batch, run_to_end
from jobstrata.streaming.sinks import LayerSink
from tests.test_feed import AT, gold
from tests.test_streaming import land, posting

ROWS = "id bigint, day string"


def numbers(spark, start, stop, days=3):
    return spark.range(start, stop).select("id", F.concat(F.lit("d"), F.col("id") % days).alias("day"))


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


# Snapshot tables


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "t"), ROWS, ("day",))


def test_a_key_counts_once(spark, table):
    assert ids(table.read()) == []
    assert table.append(numbers(spark, 0, 5), "batch-0") and not table.append(numbers(spark, 0, 5), "batch-0")
    table.append(numbers(spark, 5, 9), "batch-1")
    assert ids(table.read()) == list(range(9)) and ids(table.read(1)) == list(range(5))
    assert ids(table.read(only=lambda x: x["key"] == "batch-1")) == [5, 6, 7, 8]


def test_staged_rows_are_invisible_and_a_moved_folder_is_adopted(spark, table):
    table.append(numbers(spark, 0, 3), "batch-0")
    table.stage(numbers(spark, 3, 6), "batch-1")
    assert ids(table.read()) == [0, 1, 2]
    table.folder.move("staging/batch-1", "data/tier=batch/entry=batch-1")
    assert ids(table.read()) == [0, 1, 2]
    # The stop was between the move and the version; the next attempt only has to publish.
    assert table.append(numbers(spark, 3, 6), "batch-1") and ids(table.read()) == list(range(6))


def test_compaction_bounds_files_and_leaves_open_readers_alone(spark, table):
    for n in range(12):
        table.append(numbers(spark, 10 * n, 10 * n + 10).repartition(4), f"batch-{n}")
    before = table.read()
    version = table.versions()[-1]
    files = sum(x["files"] for x in table.entries())
    assert table.compact() and sum(x["files"] for x in table.entries()) == 3 < files
    assert ids(table.read()) == ids(before) == list(range(120)) == ids(table.read(version))
    # Packed batches still count as done, and an empty batch leaves no trace behind.
    assert table.committed("batch-4") and not table.committed("batch-12") and not table.append(numbers(spark, 0, 1), "batch-11")
    table.append(numbers(spark, 0, 0), "batch-12")
    table.append(numbers(spark, 120, 130), "batch-13")
    table.compact()
    assert len(table.entries()) == 1 and ids(table.read()) == list(range(130)) and table.committed("batch-12")
    assert table.compact() is None
    assert table.vacuum(1) > 12 and ids(table.read()) == list(range(130)) and len(table.versions()) == 1


def test_compaction_gives_a_large_value_the_files_its_bytes_need(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), "text string, day string", ("day",))
    for n in range(4):
        rows = spark.range(2000).select(F.sha2(F.concat("id", F.lit(f"-{n}")), 256).alias("text"), F.when(F.col("id") < 1900, "hot").otherwise("cold").alias("day"))
        table.append(rows, f"batch-{n}")
    size = sum(x["bytes"] for x in table.entries())
    table.compact(target=size // 4)
    names = [name for name, _ in table.folder.files("data/tier=packed")]
    hot = sum("day=hot" in x for x in names)
    assert 3 <= hot <= 5 and sum("day=cold" in x for x in names) == 1
    assert table.read().select("text").distinct().count() == 8000


def test_a_stream_does_not_meet_packed_rows_again(spark, table, tmp_path):
    out = SnapshotTable(spark, str(tmp_path / "out"), ROWS)
    run = lambda: run_to_end(each_batch(table.stream(), LayerSink(out).apply, str(tmp_path / "ckpt")))
    table.append(numbers(spark, 0, 4), "batch-0")
    run()
    table.append(numbers(spark, 4, 8), "batch-1")
    table.compact()
    table.append(numbers(spark, 8, 9), "batch-2")
    run()
    run()
    assert ids(out.read()) == list(range(9))


def test_writers_that_meet_keep_each_others_entries(spark, table):
    other = SnapshotTable(spark, table.root, ROWS, ("day",))
    table.append(numbers(spark, 0, 3), "a")
    write, met = table.folder.write, []

    def late(name, text):
        if not met:
            met.append(other.append(numbers(spark, 3, 6), "b"))
        write(name, text)

    table.folder.write = late
    table.append(numbers(spark, 6, 9), "c")
    assert ids(table.read()) == list(range(9)) and [x["key"] for x in table.entries()] == ["a", "b", "c"]
    with pytest.raises(ValueError):
        table.stage(numbers(spark, 0, 1), "d")
        table.commit("d", replaces=["gone"])


# Ids


def scanned_bytes(df):
    """Bytes of the files that the scans of a plan select."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "FileSourceScan" in node.getClass().getSimpleName():
            total += node.metrics().apply("filesSize").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def people(spark, start, stop):
    return spark.range(start, stop).select(F.concat(F.lit("job_"), "id").alias("job_id"))


def test_ids_in_buckets(spark, tmp_path):
    store = IdStore(spark, str(tmp_path / "ids"), bucket_bytes=2000)
    assert ids(store.unseen(people(spark, 0, 3)), "job_id") == ["job_0", "job_1", "job_2"]
    for n in range(6):
        store.add(people(spark, 100 * n, 100 * n + 100), f"batch-{n}")
    assert not store.add(people(spark, 0, 5), "batch-5")
    before = ids(store.unseen(people(spark, 590, 605)), "job_id")
    assert before == [f"job_{i}" for i in range(600, 605)]
    store.compact()
    assert max(x["buckets"] for x in store.table.entries()) > 1 and store.table.committed("batch-5")
    assert ids(store.unseen(people(spark, 590, 605)), "job_id") == before
    odd = spark.createDataFrame([(None,), ("",), ("job_1",), ("new",)], "job_id string")
    assert ids(store.unseen(odd), "job_id") == ["new"]


def test_a_batch_reads_as_much_of_an_old_history_as_of_a_young_one(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = {}
        for age in (2_000, 40_000):
            store = IdStore(spark, str(tmp_path / f"ids{age}"), bucket_bytes=4_000)
            for n in range(4):
                store.add(people(spark, n * age // 4, (n + 1) * age // 4), f"batch-{n}")
            while store.compact():
                pass
            read[age] = scanned_bytes(store.history(people(spark, 5, 6)))
            whole = sum(x["bytes"] for x in store.table.entries())
        assert read[40_000] < 3 * read[2_000] and read[40_000] < whole / 8
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_five_days_out_of_order_keep_five_ids(spark, tmp_path):
    schema = "id string, ts timestamp, n int"
    (tmp_path / "in").mkdir()
    table = SnapshotTable(spark, str(tmp_path / "out"), schema)
    repeats = UniqueSink.repeats_table(spark, str(tmp_path / "repeats"))
    store = IdStore(spark, str(tmp_path / "ids"), compact_every=2)

    def run(name, rows):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(r) for r in rows))
        sink = UniqueSink(table, ids=store, key="id", ts="ts", repeats=repeats, delay="1 DAY")
        run_to_end(each_batch(spark.readStream.schema(schema).json(str(tmp_path / "in")), sink.apply, str(tmp_path / "ckpt")))

    for k, day in enumerate((5, 4, 3, 2, 1)):
        row = {"id": f"a{day}", "ts": f"2024-01-0{day} 10:00:00", "n": k}
        run(f"{k}.json", [row, row | {"n": 9, "ts": f"2024-01-0{day} 11:00:00"}, {"id": "a5", "ts": "2024-01-01 00:00:00"}, {"id": None, "n": k}])
    found = table.read().filter("id IS NOT NULL")
    assert ids(found, "id") == ["a1", "a2", "a3", "a4", "a5"] and table.read().filter("id IS NULL").count() == 5
    counts = {r.batch: r for r in repeats.read().collect()}
    assert [counts[b].rows for b in range(5)] == [4] * 5 and [counts[b].kept for b in range(5)] == [2] * 5
    assert [counts[b].repeated for b in range(5)] == [2] * 5 and sum(counts[b].late_kept for b in range(5)) == 4


def test_ids_of_a_batch_that_stopped_after_its_rows_follow(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "out"), "id string, ts int")
    store = IdStore(spark, str(tmp_path / "ids"))
    sink = UniqueSink(table, ids=store, key="id", ts="ts", repeats=None)
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "id string, ts int")
    add, store.add = store.add, lambda *x: (_ for _ in ()).throw(RuntimeError("stopped"))
    with pytest.raises(RuntimeError):
        sink.apply(rows, 0)
    store.add = add
    sink.apply(rows, 0)
    sink.apply(rows, 1)
    assert sorted((r.id, r.ts) for r in table.read().collect()) == [("a", 1), ("b", 1)]


# Sinks


def test_checks_stop_a_batch_before_its_write(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROWS)
    results = SnapshotTable(spark, str(tmp_path / "r"), "layer string, batch bigint, rule string, action string, passed bigint, failed bigint")
    checks = [Check("small", "id < 100", "FAIL"), Check("even", "id % 2 = 0", "WARN"), Check("one_each", "id", "FAIL", unique=True)]
    sink = LayerSink(table, "layer", rules={"known": "day <> 'd1'"}, checks=checks, results=results)
    sink.apply(numbers(spark, 0, 6), 0)
    sink.apply(numbers(spark, 0, 6), 0)
    for bad in (numbers(spark, 98, 103), numbers(spark, 0, 2).union(numbers(spark, 0, 2))):
        with pytest.raises(ExpectationFailed):
            sink.apply(bad, 1)
        assert ids(table.read()) == list(range(6)) and not table.folder.files("staging") and not table.committed("batch-1")
    sink.apply(numbers(spark, 6, 8), 1)
    found = {(r.batch, r.rule): (r.action, r.passed, r.failed) for r in results.read().collect()}
    assert found == {
        (0, "known"): ("WARN", 4, 2), (0, "small"): ("FAIL", 6, 0), (0, "even"): ("WARN", 3, 3), (0, "one_each"): ("FAIL", 6, 0),
        (1, "known"): ("WARN", 1, 1), (1, "small"): ("FAIL", 2, 0), (1, "even"): ("WARN", 1, 1), (1, "one_each"): ("FAIL", 2, 0),
    }
    assert sink.totals == {"total": 8, "known": 5, "small": 8, "even": 4, "one_each": 8}


def test_a_failing_check_ends_the_stream(spark, tmp_path):
    land(tmp_path / "landing", "2025-09-02", "data_engineer_a.jsonl", [posting(1), posting(2, title=None)])
    domain = Domain(spark, str(tmp_path / "lake"), "data_engineer")
    checks = {"silver_stg": [Check("title_given", "title IS NOT NULL", "FAIL")]}
    with pytest.raises(Exception, match="title_given"):
        domain.run(str(tmp_path / "landing"), "2025-10-06", checks=checks)
    assert domain.table("bronze").read().count() == 2 and not domain.expectations.read().filter("layer = 'silver_stg'").count()
    gold_rows, _ = domain.run(str(tmp_path / "landing"), "2025-10-06")
    assert ids(gold_rows, "job_id") == ["j1"]


def test_files_follow_from_the_days_and_not_from_the_tasks(spark, tmp_path):
    rows = spark.range(0, 2400, 1, 8).select("id", F.concat(F.lit("d"), F.col("id") % 30).alias("day"))
    table = SnapshotTable(spark, str(tmp_path / "t"), ROWS, ("day",))
    rows.write.parquet(str(tmp_path / "in"))
    run_to_end(each_batch(spark.readStream.schema(ROWS).parquet(str(tmp_path / "in")), LayerSink(table).apply, str(tmp_path / "ckpt")))
    assert table.entries()[0]["files"] == 30 and table.read().count() == 2400
    out = str(tmp_path / "json")
    stream = spark.readStream.schema(ROWS).parquet(str(tmp_path / "in"))
    run_to_end(messages.write_json_by_category(stream, out, str(tmp_path / "ckpt2"), ("day",)))
    append_jsonl(rows, str(tmp_path / "jsonl"), ["day"])
    for root in (out, str(tmp_path / "jsonl")):
        assert len(spark.read.json(root).inputFiles()) == 30 and spark.read.json(root).count() == 2400


def test_a_hot_day_is_split_by_size(spark, tmp_path):
    text = F.sha2(F.col("id").cast("string"), 512)
    rows = spark.range(0, 40_000, 1, 8).select(text.alias("text"), F.when(F.col("id") % 100 < 97, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 3)).alias("day"))
    rows.write.parquet(str(tmp_path / "in"))
    table = SnapshotTable(spark, str(tmp_path / "t"), "text string, day string", ("day",))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500000")
    try:
        stream = spark.readStream.schema("text string, day string").parquet(str(tmp_path / "in"))
        run_to_end(each_batch(stream, LayerSink(table).apply, str(tmp_path / "ckpt")))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    names = [name for name, _ in table.folder.files("data")]
    assert sum("day=hot" in x for x in names) >= 4 and len([x for x in names if "day=hot" not in x]) <= 6
    assert table.read().count() == 40_000


def test_json_of_a_batch_that_runs_again_is_replaced(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.json").write_text(f'{{"id": {k}, "day": "x"}}')
    run = lambda: run_to_end(messages.write_json_by_category(
        spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ckpt"), ("day",)))
    run()
    # As if the stream had stopped between the write of the last batch and its commit.
    (tmp_path / "ckpt" / "commits" / "1").unlink()
    (tmp_path / "ckpt" / "commits" / ".1.crc").unlink(missing_ok=True)
    run()
    assert ids(spark.read.json(str(tmp_path / "out"))) == [0, 1]


# Array files


def test_arrays_over_several_lines(spark, tmp_path):
    land(tmp_path / "landing", "2025-09-02", "data_engineer_lines.jsonl", [posting(1), posting(2)])
    folder = tmp_path / "landing" / "2025-09-02"
    (folder / "data_engineer_one line.json").write_text(json.dumps([posting(3), posting(4)]))
    (folder / "data_engineer_50%+a.json").write_text("\n\n" + json.dumps([posting(5, batch_id="x"), posting(6, title="a\nb [x]")], indent=2))
    (folder / "data_engineer_rows.json").write_text("[" + ",\n".join(json.dumps(posting(i)) for i in (7, 8)) + "]\n")
    (folder / "data_engineer_broken.json").write_text(json.dumps([posting(9), posting(10)], indent=2)[:-5])
    (folder / "data_engineer_empty.json").write_text("[\n]\n")
    rows = read_bronze(spark, str(tmp_path / "landing"), "data_engineer").collect()
    by = {r.job_id: r for r in rows}
    assert sorted(x for x in by if x) == [f"j{i}" for i in range(1, 9)] and len(rows) == 9
    assert list(by[None]._rescued_data) == ["_corrupt_record"]
    assert by["j5"]._rescued_data == {"batch_id": "x"} and by["j6"].title == "a\nb [x]"
    assert all(r.extract_date == "2025-09-02" for r in rows) and by["j5"].source_file.endswith(".json")


def test_array_files_in_a_stream(spark, tmp_path):
    source, domain = tmp_path / "landing", Domain(spark, str(tmp_path / "lake"), "data_engineer")
    for day in ("2025-09-02", "2025-09-03"):
        k = int(day[-1])
        land(source, day, "data_engineer_a.jsonl", [posting(10 * k)])
        (source / day / "data_engineer_b.json").write_text(json.dumps([posting(10 * k + 1), posting(10 * k + 2)], indent=2))
        (source / day / "data_engineer_c.json").write_text(json.dumps([posting(1)], indent=2)[:-3])
        rows, _ = domain.run(str(source), "2025-10-06", max_files=1, compact_every=2)
    assert ids(rows, "job_id") == ["j20", "j21", "j22", "j30", "j31", "j32"]
    bronze = domain.table("bronze").read()
    assert bronze.count() == 8 and bronze.filter("_rescued_data['_corrupt_record'] IS NOT NULL").count() == 2


# Changes


CHANGES = "k string, seq int, op string, v string, id int"


def plain_history(rows):
    best = {}
    for r in rows:
        if r[1] is not None and ((r[0], r[1]) not in best or r[4] > best[r[0], r[1]][4]):
            best[r[0], r[1]] = r
    out = []
    for key in {r[0] for r in best.values()}:
        states = sorted((r for r in best.values() if r[0] == key), key=lambda r: r[1])
        kept = [r for i, r in enumerate(states) if i == 0 or (r[2] == "D", r[3] if r[2] != "D" else None) != (states[i - 1][2] == "D", states[i - 1][3] if states[i - 1][2] != "D" else None)]
        out += [(r[0], r[3], r[1], kept[i + 1][1] if i + 1 < len(kept) else None) for i, r in enumerate(kept) if r[2] != "D"]
    return sorted(out, key=repr)


def changes(n=300):
    import random

    rng = random.Random(7)
    rows = [(rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([None, *range(40)]), rng.choice("UUUD"), rng.choice("xyz"), i) for i in range(n)]
    return rows + rows[:20]


def test_change_history(spark):
    rows = changes()
    df = spark.createDataFrame(rows, CHANGES).repartition(5)
    found = change_history(df, ["k"], "seq", ["id"], "op = 'D'", ["v"]).select("k", "v", "valid_from", "valid_to")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_history(rows)


def test_history_of_a_stream_equals_that_of_a_batch(spark, tmp_path):
    rows = changes()
    history = ChangeHistory(spark, str(tmp_path / "h"), CHANGES, ["k"], "seq", ["id"], "op = 'D'", ["v"])
    sink = history.sink(compact_every=2)
    state = CurrentState(spark, str(tmp_path / "s"), ["k"], "seq", ["id"], "op = 'D'")
    for batch in range(5):
        part = spark.createDataFrame([r for i, r in enumerate(rows) if i % 5 == 4 - batch], CHANGES)
        for _ in range(2):
            sink.apply(part, batch)
            state.apply(part, batch)
    found = history.read().select("k", "v", "valid_from", "valid_to")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_history(rows)
    now = sorted((r.k, r.v) for r in history.current().filter("k IS NOT NULL").collect())
    open_rows = sorted((k, v) for k, v, _, end in plain_history(rows) if end is None and k is not None)
    assert now == open_rows == sorted((r.k, r.v) for r in state.compact(str(tmp_path / "s2")).read().filter("k IS NOT NULL").collect())


def test_an_old_change_does_not_bring_back_a_deleted_row(spark, tmp_path):
    state = CurrentState(spark, str(tmp_path / "s"), ["k"], "seq", ["id"], "op = 'D'")
    apply = lambda batch, *rows: state.apply(spark.createDataFrame(list(rows), CHANGES), batch)
    apply(0, ("a", 5, "D", None, 1), ("b", 1, "U", "x", 2))
    packed = state.compact(str(tmp_path / "s2"))
    packed.apply(spark.createDataFrame([("a", 4, "U", "old", 3)], CHANGES), 1)
    assert [(r.k, r.v) for r in packed.read().collect()] == [("b", "x")]
    packed.apply(spark.createDataFrame([("a", 6, "U", "new", 4)], CHANGES), 2)
    assert sorted((r.k, r.v) for r in packed.read().collect()) == [("a", "new"), ("b", "x")]


def test_neighbours_of_one_hot_key(spark):
    rows = spark.range(0, 1000, 1, 7).select(F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 3)).alias("k"), ((F.col("id") * 37) % 1000).alias("seq"))
    by = {}
    for r in rows.collect():
        by.setdefault(r.k, []).append(r.seq)
    for after, shift in ((True, 1), (False, -1)):
        found = {(r.k, r.seq): r.n_seq for r in with_neighbour(rows, ["k"], ["seq"], ["seq"], "n_", after).collect()}
        for k, seqs in by.items():
            seqs = sorted(seqs)
            for i, s in enumerate(seqs):
                assert found[k, s] == (seqs[i + shift] if 0 <= i + shift < len(seqs) else None)
    assert with_neighbour(rows.limit(0), ["k"], ["seq"], ["seq"], "n_").count() == 0


# Metrics and the feed


def test_metrics_of_three_batches_equal_those_of_one(spark, tmp_path):
    rows = spark.range(90).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("day"), (F.col("id") * 7).alias("lag"), (F.col("id") % 3 > 0).alias("ok"))
    one = DailyMetrics(spark, str(tmp_path / "one"), F.col("day"), F.col("lag"), F.col("ok"))
    three = DailyMetrics(spark, str(tmp_path / "three"), F.col("day"), F.col("lag"), F.col("ok"))
    one.apply(rows, 0)
    for n in range(3):
        for _ in range(2):
            three.apply(rows.filter(F.col("lag") % 3 == n), n)
        three.compact()
    want = sorted(map(tuple, one.read().collect()))
    assert sorted(map(tuple, three.read().collect())) == want and sum(r[1] for r in want) == 90


class Stopped(Exception):
    pass


@pytest.mark.parametrize("writes", [0, 1, 2, 3])
def test_a_cycle_that_stops_shows_nothing(spark, tmp_path, writes):
    store = FeedStore(spark, str(tmp_path / "feed"))
    store.poll(gold(spark, ("a", 10, "recife")), 1, AT)
    replies = spark.createDataFrame([("me", "SIM a")], "sender string, message string")
    rows = gold(spark, ("a", 10, "recife"), ("b", 5, "recife"))
    write, done = store._write, []

    def stopping(df, table, cycle):
        if len(done) == writes:
            raise Stopped
        done.append(table)
        write(df, table, cycle)

    store._write = stopping
    mark = store.state().first()
    with pytest.raises(Stopped):
        store.poll(rows, 2, AT, replies=replies)
    register_feed_tables(store, "stopped")
    assert ids(spark.table("stopped_sent_jobs"), "job_id") == ["a"] and spark.table("stopped_responses").count() == 0
    assert spark.table("stopped_state").first() == mark and store.committed("outbox") == [1]
    store._write = write
    assert ids(store.poll(rows, 2, AT, replies=replies), "job_id") == ["b"]
    register_feed_tables(store, "stopped")
    assert ids(spark.table("stopped_sent_jobs"), "job_id") == ["a", "b"] and ids(store.responses(), "job_id") == ["a"]
    assert store.state().first() != mark and ids(store.poll(rows, 3, AT), "job_id") == []


def test_ids_of_a_cycle_that_stopped_after_its_commit(spark, tmp_path):
    store = FeedStore(spark, str(tmp_path / "feed"))
    settle, store._settle = store._settle, lambda: None
    store.poll(gold(spark, ("a", 10, "recife")), 1, AT)
    store._settle = settle
    assert ids(store.poll(gold(spark, ("a", 10, "recife"), ("b", 5, "recife")), 2, AT, slack="1 HOUR"), "job_id") == ["b"]


def test_envelope_places_are_read(spark):
    sent = spark.createDataFrame([(b"k", b'{"title": "t", "batch_id": "x"}', "jobs", 3, 17, None)], schemas.ENVELOPE)
    row = messages.envelope_rows(sent, schemas.MESSAGE).first()
    assert (row.title, row.batch_id, row.message_id, row.kafka_key) == ("t", "x", "jobs/3/17", "k")


def test_profiles_of_batches_and_days_add_up(spark, tmp_path):
    rows = spark.range(3000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("day"), (F.col("id") % 500).cast("string").alias("often"),
        F.when(F.col("id") % 4 > 0, F.col("id")).alias("some"),
    )
    one = ColumnProfiles(spark, str(tmp_path / "one"), ["often", "some"], F.col("day"))
    many = ColumnProfiles(spark, str(tmp_path / "many"), ["often", "some"], F.col("day"))
    one.apply(rows, 0)
    for n in range(4):
        for _ in range(2):
            many.apply(rows.filter(F.pmod(F.hash("some", "often"), F.lit(4)) == n), n)
    many.compact()
    for first, last in ((None, None), ("2024-01-02", "2024-01-04")):
        part = rows if first is None else rows.filter(F.col("day").between(first, last))
        exact = {r.column: r for r in quality.profile(part.select("often", "some")).collect()}
        for found in (one.read(first, last).collect(), many.read(first, last).collect()):
            assert {r.column: (r.total_rows, r.null_count) for r in found} == {k: (r.total_rows, r.null_count) for k, r in exact.items()}
            assert all(abs(r.distinct_count - exact[r.column].distinct_count) <= 4 * ERROR * exact[r.column].distinct_count + 1 for r in found)
