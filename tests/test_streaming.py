from __future__ import annotations

import json
import random
import shutil
import time
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import tuples
from tidemark import schemas
from tidemark.functions.sketches import DEVIATION, estimated, sketch_of
from tidemark.operators import transactions as op
from tidemark.operators.transactions import Transactions
from tidemark.sinks import streams as sinks
from tidemark.sinks.files import write_messages
from tidemark.sources import streams as sources
from tidemark.streaming import batch_log, messages, notifications, state
from tidemark.streaming.arrivals import stream_line_counts
from tidemark.streaming.replay import (
    arrow_reaches,
    replay_batches,
    replay_stored,
    run_to_end,
    store_batches,
)
from tidemark.streaming.status import QueryTotals, query_status, store_totals, stored_totals
from tidemark.streaming.windows import (
    closed_before,
    stream_window_metrics,
    stream_window_states,
)

START = datetime(2024, 1, 15, 10, tzinfo=timezone.utc)


def message(number: int, second: float, amount: float = 10.0, batch: int = 1) -> dict:
    value = {
        "customer_id": f"C{number % 5}",
        "final_amount": amount,
        "batch_number": batch,
        "producer_timestamp": START.timestamp() + second,
    }
    return envelope(number, json.dumps(value))


def envelope(number: int, value: str) -> dict:
    return {
        "key": f"C{number % 5}",
        "value": value,
        "topic": "t",
        "partition": number % 2,
        "offset": number,
        "timestamp": START.isoformat(),
    }


def write_file(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(row) for row in rows))


def parsed_stream(spark, folder, **options):
    raw = sources.message_stream(spark, "file", path=str(folder), **options)
    parsed = messages.parse_messages(
        raw, schemas.TRANSACTION_MESSAGE, "partition", "offset", "timestamp"
    )
    return messages.with_message_time(parsed)


def run(query):
    query.awaitTermination()
    return query


def test_source_columns_and_arrival_time(spark, tmp_path):
    write_file(tmp_path / "in", "a.json", [message(1, 0), message(2, 1)])
    stream = messages.with_arrival_time(parsed_stream(spark, tmp_path / "in"))
    run(sinks.to_files(stream, str(tmp_path / "out"), str(tmp_path / "ck"), kind="parquet"))
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert tuples(rows, "partition", "offset") == [(0, 2), (1, 1)]
    row = rows.orderBy("offset").first()
    assert row["event_time"] == START.replace(tzinfo=None)
    assert len(row["processing_timestamp_str"]) == 19


def test_bad_and_double_encoded_messages(spark):
    inner = json.dumps({"customer_id": 'a"b', "final_amount": 1.5})
    rows = [
        envelope(1, inner),
        envelope(2, json.dumps(inner)),
        envelope(3, "{broken"),
        envelope(4, json.dumps("not an object")),
        envelope(5, None),
    ]
    df = spark.createDataFrame([(r["offset"], r["value"]) for r in rows], "offset int, value string")
    parsed = messages.parse_messages(df, schemas.TRANSACTION_MESSAGE, "offset")
    assert tuples(parsed, "offset", "customer_id", "parse_status") == [
        (1, 'a"b', "ok"),
        (2, 'a"b', "double_encoded"),
        (3, None, "bad_json"),
        (4, None, "bad_json"),
        (5, None, "bad_json"),
    ]


def test_message_time_from_epoch_or_text(spark):
    df = spark.createDataFrame(
        [(1705312800.25, None), (None, "2024-01-15 10:00:00"), (None, "yesterday")],
        "producer_timestamp double, transaction_date string",
    )
    got = [r["event_time"] for r in messages.with_message_time(df).collect()]
    assert got == [datetime(2024, 1, 15, 10, 0, 0, 250000), datetime(2024, 1, 15, 10), None]


def test_append_gives_closed_windows_and_drops_late_rows(spark, tmp_path):
    """Files in time order; then one row far behind the watermark."""
    folder = tmp_path / "in"
    write_file(folder, "1.json", [message(i, i) for i in range(60)])
    stream = parsed_stream(spark, folder)
    windows = stream_window_metrics(stream, "event_time", "10 seconds", "10 seconds", "5 seconds")

    def run_now():
        return run(sinks.to_files(windows, str(tmp_path / "o"), str(tmp_path / "ck"), "parquet"))

    first = run_now()
    assert query_status(first)["input_rows"] == 60
    batch = op.window_metrics(
        spark.createDataFrame(
            [(START.replace(tzinfo=None) + timedelta(seconds=i), f"C{i % 5}", 10.0, 1) for i in range(60)],
            "event_time timestamp, customer_id string, final_amount double, batch_number int",
        ),
        "event_time",
        "10 seconds",
        "5 seconds",
    )
    latest = F.lit((START + timedelta(seconds=59)).replace(tzinfo=None))
    closed = batch.filter(closed_before(F.col("window_end"), latest, "10 seconds"))
    stored = lambda: spark.read.parquet(str(tmp_path / "o"))
    assert tuples(stored()) == tuples(closed)
    assert closed.count() < batch.count()

    # The restart goes on from the checkpoint: a late row is dropped and counted.
    write_file(folder, "2.json", [message(100, 3), message(101, 61)])
    second = run_now()
    status = query_status(second)
    assert status["input_rows"] == 2
    assert status["late_rows"] >= 1
    assert stored().agg(F.max("record_count")).first()[0] == 10


def test_exact_distinct_is_refused_on_streams(spark, tmp_path):
    write_file(tmp_path / "in", "a.json", [message(1, 0)])
    stream = parsed_stream(spark, tmp_path / "in").withWatermark("event_time", "1 second")
    exact = op.window_metrics(stream, "event_time", "10 seconds")
    with pytest.raises(Exception, match="[Dd]istinct"):
        run(sinks.to_files(exact, str(tmp_path / "o"), str(tmp_path / "ck"), "parquet"))


def test_batch_log_counts_input_rows_once(spark, tmp_path):
    folder, log_path, checkpoint = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "ck")
    for name, first in (("1.json", 0), ("2.json", 30), ("3.json", 60)):
        write_file(folder, name, [message(i, i, amount=0.1) for i in range(first, first + 30)])
    writer = batch_log.log_writer(log_path, "event_time", "final_amount")

    def run_now():
        stream = parsed_stream(spark, folder, files_per_batch=1)
        return run(sinks.to_batches(stream, writer, checkpoint))

    run_now()
    log = batch_log.batch_log(spark, log_path)
    running = batch_log.running_totals(log).orderBy("batch_id").collect()
    assert [r["total_records"] for r in running] == [30, 60, 90]
    assert running[-1]["total_value"] == 9.0

    write_file(folder, "4.json", [message(90, 90)])
    run_now()
    assert batch_log.log_totals(batch_log.batch_log(spark, log_path)).first()["total_records"] == 91

    # A batch that is run again replaces its row.
    repeat = spark.createDataFrame([(START, 1.0)], "event_time timestamp, final_amount double")
    writer(repeat, 3)
    assert batch_log.log_totals(batch_log.batch_log(spark, log_path)).first()["total_records"] == 91


LOG = "batch_id long, record_count long, total_value decimal(38,8), first_time timestamp, last_time timestamp"


@pytest.mark.parametrize("size", [2, 7, 1000])
def test_running_totals_equal_a_plain_window(spark, size):
    """With gaps, batches without rows or values, and odd decimals."""
    rng = random.Random(size)
    rows = []
    for batch_id in rng.sample(range(400), 250) + [5000]:
        n = rng.choice([0, 1, 30])
        time = START + timedelta(seconds=rng.randrange(10_000)) if n else None
        value = Decimal(rng.randrange(10**14)) / Decimal(10**8) if n > 1 else None
        rows.append((batch_id, n, value, time, time))
    log = spark.createDataFrame(rows, LOG)
    so_far = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    expected = log.select(
        "batch_id",
        "record_count",
        F.sum("record_count").over(so_far),
        F.sum("total_value").over(so_far).cast("double"),
        F.min("first_time").over(so_far),
        F.max("last_time").over(so_far),
    )
    got = batch_log.running_totals(log, size)
    assert tuples(got) == tuples(expected)
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    assert batch_log.running_totals(log.limit(0), size).count() == 0


def test_a_compacted_log_counts_every_batch_once(spark, tmp_path):
    path, closed = str(tmp_path / "log"), str(tmp_path / "closed")
    write = batch_log.log_writer(path, "event_time", "final_amount", segment=3)

    def batch(amount):
        return spark.createDataFrame([(START, amount)], "event_time timestamp, final_amount double")

    def numbers():
        rows = batch_log.whole_log(spark, path, closed).collect()
        total = batch_log.whole_totals(spark, path, closed).first()
        assert total["total_records"] == (len(rows) or None)
        return sorted((r["batch_id"], float(r["total_value"])) for r in rows)

    assert numbers() == [] and batch_log.compact_log(spark, path, closed) == 0
    for k in range(6):
        write(batch(float(k)), k)
    # The last batch on record may come again, so its segment stays open.
    assert batch_log.compact_log(spark, path, closed) == 1
    write(batch(50.0), 5)
    expected = [(k, float(k)) for k in range(5)] + [(5, 50.0)]
    assert numbers() == expected
    write(batch(6.0), 6)
    kept = tmp_path / "kept"
    shutil.copytree(tmp_path / "log", kept)
    assert batch_log.compact_log(spark, path, closed) == 2
    expected.append((6, 6.0))
    assert numbers() == expected
    # A run that stopped before the old folders were removed: nothing counts twice.
    shutil.copytree(kept, tmp_path / "log", dirs_exist_ok=True)
    assert numbers() == expected
    assert batch_log.compact_log(spark, path, closed) == 2
    assert sorted(p.name for p in (tmp_path / "log").glob("segment=*")) == ["segment=2"]
    # One that stopped between rows and totals: the segment is still read from the log.
    write(batch(9.0), 9)
    log = spark.read.parquet(path).where("segment = 2")
    log.write.mode("append").partitionBy("segment").parquet(f"{closed}/rows")
    expected.append((9, 9.0))
    assert numbers() == expected
    assert batch_log.compact_log(spark, path, closed) == 3
    assert numbers() == expected
    files = list((tmp_path / "closed" / "rows").rglob("*.parquet"))
    assert len(files) == 3, "one file per closed segment"


def test_line_counts_of_arriving_files(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", tmp_path / "out", str(tmp_path / "ck")
    folder.mkdir()
    (folder / "a.txt").write_text("one two\nthree")
    (folder / "skip.bin").write_text("x")

    def run_now():
        return run(stream_line_counts(spark, str(folder), str(out), checkpoint, "*.txt"))

    run_now()
    (folder / "b.txt").write_text("1\n2\n3\n")
    run_now()
    run_now()
    got = tuples(spark.read.parquet(str(out)), "file_name", "line_count", "word_count", "file_size_bytes")
    assert got == [("a.txt", 2, 3, 13), ("b.txt", 3, 3, 6)]


def test_upload_filter_and_request(spark):
    events = [
        ("b", "a.txt", "OBJECT_FINALIZE", "t"),
        ("b", "b.txt", "object.Create", "t"),
        ("b", "c.txt", "delete", "t"),
        ("b", "dir/", "finalize", "t"),
        ("b", ".hidden", "finalize", "t"),
        ("b", None, "finalize", "t"),
        ("b", "d.txt", None, "t"),
    ]
    kept = notifications.wanted_uploads(spark.createDataFrame(events, schemas.UPLOAD_EVENT))
    assert [r["name"] for r in kept.collect()] == ["a.txt", "b.txt", None]
    counted = kept.filter("name IS NOT NULL")
    request = notifications.line_count_requests(counted, "store", lines=F.lit(5)).first()
    assert request["key"] == "store://b/a.txt"
    assert json.loads(request["value"]) == {
        "bucket_name": "b",
        "file_name": "a.txt",
        "event_type": "OBJECT_FINALIZE",
        "time_created": "t",
        "file_path": "store://b/a.txt",
        "processing_request": "line_count",
        "function_triggered_at": "t",
        "LINE_COUNT": 5,
        "FILE_SIZE": -1,
        "PROCESSING_COMPLETE": True,
    }


def test_notifications_are_routed_and_replayed_safely(spark, tmp_path):
    good = {"bucket_name": "b", "file_name": "f", "processing_request": "line_count"}
    lines = [
        json.dumps(good),
        json.dumps({**good, "bucket_name": ""}),
        json.dumps({"bucket_name": "b", "processing_request": "line_count"}),
        json.dumps({**good, "processing_request": "other"}),
        "not json",
    ]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "n.txt").write_text("\n".join(lines))
    stream = sources.notification_stream(spark, str(folder))
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    run(notifications.process_notifications(stream, target, checkpoint))
    run(notifications.process_notifications(stream, target, checkpoint))
    assert tuples(spark.read.parquet(f"{target}/requests"), "route") == [("ok",)]
    rejects = tuples(spark.read.parquet(f"{target}/rejects"), "route")
    assert rejects == [("bad_json",), ("missing_fields",), ("missing_fields",), ("other_request",)]


NUMBERED = """id, timestamp_seconds(id) AS at, CAST(timestamp_seconds(id) AS timestamp_ntz) AS plain,
  CAST(id AS decimal(20, 3)) AS amount, IF(id % 7 = 0, NULL, string(id)) AS name, array(id) AS list,
  CAST(id DIV 3 + 1 AS int) AS batch_number"""


def replayed(stream, checkpoint, seen, stop_after=None):
    def write(batch, _):
        seen.append(batch.collect())
        if len(seen) == stop_after:
            raise RuntimeError("stopped here")

    return run_to_end(sinks.to_batches(stream, write, checkpoint, every="0 seconds"))


@pytest.mark.parametrize("by_tasks", [True, False])
def test_replay_keeps_order_and_rows_over_restarts(spark, tmp_path, by_tasks):
    """90 rows in 30 batches, written by many tasks and taken four batches at a time."""
    rows = spark.range(90).selectExpr(*[x.strip() for x in _columns(NUMBERED)]).repartition(8)
    seen, checkpoint = [], str(tmp_path / "ck")
    stream = replay_batches(rows, batches_per_trigger=4, by_tasks=by_tasks)
    with pytest.raises(Exception, match="stopped here"):
        replayed(stream, checkpoint, seen, stop_after=3)
    assert [sorted({r.batch_number for r in part}) for part in seen] == [
        [1, 2, 3, 4], [5, 6, 7, 8], [9, 10, 11, 12],
    ]
    seen.pop()  # it failed, so it comes again
    replayed(stream, checkpoint, seen)
    expected = [list(range(k, min(k + 4, 31))) for k in range(1, 31, 4)]
    assert [sorted({r.batch_number for r in part}) for part in seen] == expected
    assert sorted(r for part in seen for r in part) == sorted(rows.collect())
    replayed(stream, checkpoint, seen)
    assert len(seen) == len(expected), "nothing is left after the end"


def _columns(text):
    """Splits a select list at the commas outside brackets."""
    depth, part = 0, ""
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            yield part
            part = ""
        else:
            part += c
    yield part


def test_a_replay_goes_on_with_batches_that_came_later(spark, tmp_path):
    """The offset is the batch number, also with another number of batches per trigger."""
    rows = spark.range(40).selectExpr("id", "CAST(id DIV 4 + 1 AS bigint) AS batch_number")
    path, checkpoint, seen = f"file://{tmp_path}/stored", str(tmp_path / "ck"), []
    store_batches(rows, path, per_folder=3)
    stored = spark.read.schema("id bigint, batch_number bigint, replay_folder int").parquet(path)
    first = stored.where("batch_number <= 5")
    replayed(replay_stored(first, path, Transactions(), 2, 3), checkpoint, seen)
    replayed(replay_stored(stored, path, Transactions(), 4, 3), checkpoint, seen)
    assert [sorted({r.batch_number for r in part}) for part in seen] == [
        [1, 2], [3, 4], [5], [6, 7, 8, 9], [10],
    ]
    assert sorted(r.id for part in seen for r in part) == list(range(40))


def test_a_trigger_reads_the_files_of_its_batches_only(spark, tmp_path):
    from tidemark.sources.stored_batches import _FileReader

    rows = spark.range(100).selectExpr("id", "CAST(id + 1 AS int) AS batch_number")
    path = str(tmp_path / "stored")
    store_batches(rows, path, per_folder=10)
    options = dict(first=1, last=100, per_trigger=5, path=path, column="batch_number", per_folder=10)
    reader = _FileReader({k: str(v) for k, v in options.items()}, rows.schema)
    assert (reader.initialOffset(), reader.latestOffset()) == ({"batch": 0}, {"batch": 5})
    files = reader.partitions({"batch": 18}, {"batch": 23})
    assert {f.name.split("replay_folder=")[1].split("/")[0] for f in files} == {"1", "2"}
    got = [v for f in files for b in reader.read(f) for v in b.column("batch_number").to_pylist()]
    assert sorted(got) == [19, 20, 21, 22, 23]
    assert reader.latestOffset() == {"batch": 28}


def test_small_batches_share_files_and_empty_tables_end_at_once(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 8).selectExpr("id", "CAST(id + 1 AS int) AS batch_number")
    store_batches(rows, str(tmp_path / "stored"), per_folder=250)
    assert len(list((tmp_path / "stored").rglob("*.parquet"))) <= 16
    seen = []
    none = rows.where("id < 0").unionByName(rows.selectExpr("id", "NULL AS batch_number").limit(2))
    replayed(replay_batches(none), str(tmp_path / "ck"), seen)
    assert sum(len(part) for part in seen) == 0


def test_stores_that_arrow_knows(tmp_path):
    assert arrow_reaches(str(tmp_path)) and arrow_reaches(f"file:{tmp_path}")
    assert arrow_reaches(f"file://{tmp_path}") and not arrow_reaches("viewfs://store/in")


def test_totals_outlive_the_kept_progress(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    totals = QueryTotals()
    spark.streams.addListener(totals)
    try:
        rows = spark.range(12).select("id", F.col("id").cast("int").alias("batch_number"))
        query = run_to_end(sinks.to_batches(
            replay_batches(rows), lambda batch, _: batch.count(), str(tmp_path / "ck"), "0 seconds"
        ))
        for _ in range(100):
            if totals.of(query)["input_rows"] >= 12:
                break
            time.sleep(0.1)
        assert query_status(query, totals)["input_rows"] >= 12
        assert query_status(query)["input_rows"] < 12
    finally:
        spark.streams.removeListener(totals)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_merged_sketches_equal_one_sketch_of_all(spark, tmp_path):
    """60,000 customers, far beyond what a sketch keeps apart, over windows and micro-batches."""
    at = F.timestamp_seconds(F.lit(1_705_312_800) + F.col("id") % 600)
    rows = spark.range(0, 90_000, 1, 6).select(
        at.alias("event_time"),
        (F.col("id") % 60_000).alias("customer_id"),
        F.lit(1.0).alias("final_amount"),
        F.lit(1).alias("batch_number"),
    )
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2)
    states = stream_window_states(
        stream.parquet(str(tmp_path / "in")), "event_time", "1 second", "1 minute"
    )
    stored, checkpoint = str(tmp_path / "windows"), str(tmp_path / "ck")
    run(sinks.to_batches(states, lambda b, k: sinks.replace_batch(b, stored, k), checkpoint, mode="complete"))
    last = spark.read.parquet(stored)
    last = last.where(F.col("batch_id") == last.agg(F.max("batch_id")).scalar())
    merged = op.merged_metrics(last).first()
    direct = [
        part.agg(estimated(sketch_of("customer_id"))).first()[0]
        for part in (rows, rows.coalesce(1), rows.orderBy(F.desc("customer_id")))
    ]
    assert {merged["unique_customers"]} == set(direct)
    assert merged["record_count"] == 90_000
    assert 0 < abs(direct[0] - 60_000) < 3 * DEVIATION * 60_000
    few = rows.where("customer_id < 4000")
    assert few.agg(estimated(sketch_of("customer_id"))).first()[0] == 4000


def test_state_of_a_stopped_stream(spark, tmp_path):
    """Batches of ten seconds; windows of five, closed ten seconds behind."""
    folder, checkpoint = tmp_path / "in", str(tmp_path / "ck")
    stream = lambda: stream_window_metrics(
        parsed_stream(spark, folder), "event_time", "10 seconds", "5 seconds"
    )
    held = []
    for k in range(3):
        write_file(folder, f"{k}.json", [message(i, i) for i in range(10 * k, 10 * k + 10)])
        run(sinks.to_files(stream(), str(tmp_path / "o"), checkpoint, "parquet"))
        rows = state.open_windows(spark, checkpoint).orderBy("window_start").collect()
        held.append([(r["window_start"].second, r["record_count"]) for r in rows])
    # The last rows came at 9, 19 and 29 s, so windows that end by 9 and 19 s are closed.
    assert held == [[(0, 5), (5, 5)], [(5, 5), (10, 5), (15, 5)], [(15, 5), (20, 5), (25, 5)]]
    closed = spark.read.parquet(str(tmp_path / "o"))
    assert sorted(r["window_start"].second for r in closed.collect()) == [0, 5, 10]
    operators = state.state_operators(spark, checkpoint).first()
    sizes = tuples(state.state_sizes(spark, checkpoint))
    assert len(sizes) == operators["maxBatchId"] - operators["minBatchId"] + 1
    assert sizes[-1] == (operators["maxBatchId"], 3)
    first = state.open_windows(spark, checkpoint, batch=0)
    assert first.count() == 2


def test_state_fields_of_one_name_are_numbered(spark, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "ck")
    write_file(folder, "a.json", [message(i, i, amount=float(i)) for i in range(4)])
    counts = parsed_stream(spark, folder).groupBy("customer_id").agg(
        F.count("*").alias("a"), F.count("final_amount").alias("b"), F.max("final_amount").alias("c")
    )
    run(sinks.to_batches(counts, lambda batch, _: batch.count(), checkpoint, mode="update"))
    rows = state.state_rows(spark, checkpoint)
    assert rows.columns == ["customer_id", "count", "count_2", "max"]
    assert tuples(rows) == [(f"C{i}", 1, 1, float(i)) for i in range(4)]


def test_totals_as_a_table(spark, tmp_path):
    """A row per run; storing again replaces; a failed run carries its error."""
    totals, path = QueryTotals(), str(tmp_path / "totals")
    spark.streams.addListener(totals)
    try:
        rows = spark.range(12).select("id", F.col("id").cast("int").alias("batch_number"))
        stream = replay_batches(rows.where("batch_number > 0"))
        done = run_to_end(
            sinks.to_batches(stream, lambda b, _: b.count(), str(tmp_path / "a"), "0 seconds")
        )

        def fail(batch, _):
            raise RuntimeError("no room")

        failed = sinks.to_batches(stream, fail, str(tmp_path / "b"), "0 seconds")
        with pytest.raises(Exception, match="no room"):
            run_to_end(failed)
        assert totals.wait(done) and totals.wait(failed)
    finally:
        spark.streams.removeListener(totals)
    for _ in range(2):
        store_totals(totals, spark, path)
    stored = {r["run_id"]: r for r in stored_totals(spark, path).collect()}
    assert len(stored) == 2
    good, bad = stored[str(done.runId)], stored[str(failed.runId)]
    assert (good["input_rows"], good["batches"] >= 11, good["error"]) == (11, True, None)
    assert good["ended"] and good["first_progress"] <= good["last_progress"]
    assert bad["input_rows"] == 0 and "no room" in bad["error"]


def test_console_memory_and_timed_triggers(spark, tmp_path):
    write_file(tmp_path / "in", "a.json", [message(1, 0)])
    stream = parsed_stream(spark, tmp_path / "in").select("customer_id")
    run(sinks.to_console(stream, str(tmp_path / "ck1")))
    query = sinks.to_memory(stream, "seen_customers", every="1 second")
    query.processAllAvailable()
    status = query_status(query)
    query.stop()
    assert (status["name"], status["active"]) == ("seen_customers", True)
    assert tuples(spark.table("seen_customers")) == [("C1",)]


def test_kafka_is_only_named_here(spark):
    """The connector is not on this class path; the call has to say so."""
    with pytest.raises(Exception, match="(?i)kafka"):
        sources.message_stream(spark, "kafka", servers="localhost:1", topic="t", starting="earliest")
    with pytest.raises(ValueError):
        sources.message_stream(spark, "pigeon")
    messages_out = spark.createDataFrame([("k", "{}")], "key string, value string")
    with pytest.raises(Exception, match="(?i)kafka"):
        write_messages(messages_out, "localhost:1", "t")


def test_latest_row_of_each_window_counts(spark):
    from tidemark.plans.transactions import latest_windows

    rows = [("a", 1, 0), ("b", 5, 0), ("a", 3, 2), ("a", 2, 1), ("c", None, 1)]
    stored = spark.createDataFrame(rows, "window_start string, record_count int, batch_id long")
    assert tuples(latest_windows(stored)) == [("a", 3), ("b", 5), ("c", None)]
