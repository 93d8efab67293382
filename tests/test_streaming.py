import time
import json
from datetime import datetime, timedelta

import pytest
from row_text import rows
from pyspark.sql import functions as F

from palimpsest.streaming import landing, rates, revisions
from palimpsest.streaming.health import StallListener

MESSAGES = "id string, ts timestamp_ntz, at int, magnitude double, status string"
START = datetime(2025, 1, 1)
LIMIT = {"maxFilesPerTrigger": "100"}


def messages(spark):
    data = [("a", 0, 4.0, "automatic"), ("b", 1, None, "automatic"), ("a", 2, 4.0, "automatic"),
            ("a", 3, 4.2, "automatic"), ("b", 4, None, "automatic"), ("b", 5, 3.0, "automatic"),
            ("a", 6, 4.2, "reviewed"), ("a", 6, 4.2, "reviewed"), ("b", 7, None, None),
            ("b", 8, None, None), ("c", 9, 1.0, "x")]
    return spark.createDataFrame(
        [(key, START + timedelta(minutes=minute), at, magnitude, status)
         for at, (key, minute, magnitude, status) in enumerate(data)], MESSAGES)


def run(spark, frame, folder, build, fmt="parquet"):
    """Add files to the input, then let the stream read everything that is new."""
    frame.write.mode("append").format(fmt).save(f"{folder}/in")
    stream = landing.read_stream(spark, fmt, LIMIT, frame.schema, f"{folder}/in")
    (build(stream).writeStream.format("parquet").option("path", f"{folder}/out")
     .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
     .awaitTermination())
    return spark.read.parquet(f"{folder}/out")


def test_kinds_in_a_batch(spark):
    found = revisions.batch_revisions(messages(spark), "id", ["ts", "at"]).orderBy("at")
    assert [(r.kind, r.previous_magnitude, r.previous_status) for r in found.collect()] == [
        ("nouveau", None, None), ("nouveau", None, None), ("repete", None, None),
        ("revise", 4.0, "automatic"), ("repete", None, None), ("revise", None, "automatic"),
        ("revise", 4.2, "automatic"), ("repete", None, None), ("revise", 3.0, "automatic"),
        ("repete", None, None), ("nouveau", None, None)]
    assert revisions.counters(found, "id").first() == (11, 3, 3, 4, 4)
    assert rows(revisions.batch_revisions(messages(spark), "id", ["ts", "at"],
                                          rows_per_task=2)) == rows(found)


def test_stream_equals_batch_over_restarts_and_reordered_rows(spark, tmp_path):
    frame = messages(spark)
    for low, high in ((0, 4), (4, 6), (6, 11)):
        piece = frame.filter((F.col("at") >= low) & (F.col("at") < high)).orderBy(F.desc("at"))
        found = run(spark, piece, tmp_path, lambda stream: revisions.stream_revisions(
            stream, "id", ["ts", "at"]))
    expected = revisions.batch_revisions(frame, "id", ["ts", "at"])
    assert rows(found.select(expected.columns)) == rows(expected)


def test_landing_is_exactly_once(spark, tmp_path):
    frame = messages(spark).select(F.to_json(F.struct("id", "at")).cast("binary").alias("value"),
                                   F.col("ts").cast("timestamp").alias("timestamp"))
    for piece in (frame.limit(4), frame.subtract(frame.limit(4)), None):
        if piece is not None:
            piece.write.mode("append").parquet(f"{tmp_path}/in")
        stream = landing.read_stream(spark, "parquet", LIMIT, frame.schema, f"{tmp_path}/in")
        landing.land(landing.bronze_rows(stream), f"{tmp_path}/out", f"{tmp_path}/state",
                     available_now=True).awaitTermination()
    landed = landing.read_landed(spark, f"{tmp_path}/out")
    assert rows(landed) == rows(landing.bronze_rows(frame))
    assert {json.loads(r.value)["at"] for r in landed.collect()} == set(range(11))


def test_streams_need_a_limit(spark):
    with pytest.raises(ValueError):
        landing.read_stream(spark, "parquet", {}, "a int", "/nowhere")


def test_rates(spark, tmp_path):
    base = datetime(2025, 1, 1, 12)
    stamps = [base, base, base + timedelta(seconds=30), base + timedelta(minutes=20)]
    frame = spark.createDataFrame([(s,) for s in stamps], "ts timestamp")
    batch = rates.rate_per_minute(frame, "ts")
    by_start = {r.window_start: (r.messages, r.cadence_par_minute) for r in batch.collect()}
    assert by_start[base] == (3, 6.0)
    assert by_start[base + timedelta(minutes=20)] == (1, 0.0)
    assert rates.rate_history(batch, 2).count() == 2
    late = frame.unionByName(spark.createDataFrame([(base + timedelta(hours=2),)],
                                                   "ts timestamp"))
    closed = run(spark, late, tmp_path, lambda stream: rates.rate_per_minute(
        stream, "ts", watermark="1 minute"))
    assert rows(closed) == rows(batch)


def test_equal_times_have_a_span_of_a_second(spark):
    frame = spark.createDataFrame([(START,)] * 4, "ts timestamp")
    assert rates.rate_per_minute(frame, "ts").first().cadence_par_minute == 240.0


def test_copies_within_the_delay_are_dropped(spark, tmp_path):
    frame = spark.createDataFrame([
        ("a", START), ("a", START + timedelta(minutes=50)), ("b", START)],
        "k string, ts timestamp")
    kept = run(spark, frame, tmp_path, lambda s: rates.first_within(s, "ts", "1 hour", ["k"]))
    assert sorted(r.k for r in kept.collect()) == ["a", "b"]


def test_backfill(spark):
    recent = landing.backfill(messages(spark), "ts", minutes=2)
    assert sorted(r["at"] for r in recent.collect()) == [8, 9, 10]
    empty = messages(spark).limit(0)
    assert landing.backfill(empty, "ts").count() == 0


def test_a_repeated_report_of_one_batch_is_a_stall():
    now = [0.0]
    listener = StallListener(tolerance=300, clock=lambda: now[0])
    assert not listener.healthy("q")
    listener.record("q", 1)
    now[0] = 200.0
    listener.record("q", 1)
    now[0] = 301.0
    assert not listener.healthy("q")
    listener.record("q", 2)
    assert listener.healthy("q")


def test_an_idle_stream_is_healthy_and_a_running_one_is_heard(spark, tmp_path):
    now = [0.0]
    listener = StallListener(tolerance=300, clock=lambda: now[0])
    idle = type("Idle", (), {"runId": "q"})
    listener.record("q", 1)
    now[0] = 400.0
    assert not listener.healthy("q")
    listener.onQueryIdle(idle)
    assert listener.healthy("q")
    spark.streams.addListener(listener)
    try:
        spark.range(3).write.parquet(str(tmp_path / "in"))
        query = (spark.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream
                 .format("memory").queryName("heard").trigger(availableNow=True).start())
        run = str(query.runId)
        heard = []
        listener.record = lambda name, batch: heard.append((name, batch))
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        deadline = time.time() + 20
        while (run, 0) not in heard and time.time() < deadline:
            time.sleep(0.2)
        assert (run, 0) in heard
    finally:
        spark.streams.removeListener(listener)


def test_keys_share_calls_and_nulls_of_the_order_come_first(spark, tmp_path):
    data = [(None if at % 41 == 0 else f"k{at % 40}", None if at > 150 else at // 2, at, float(at % 3), "p")
            for at in range(1, 161)]
    frame = spark.createDataFrame(data, "id string, ts long, at long, magnitude double, status string")
    for low, high in ((0, 70), (150, 161)):
        found = run(spark, frame.filter((F.col("at") >= low) & (F.col("at") < high)), tmp_path,
                    lambda stream: revisions.stream_revisions(stream, "id", ["ts", "at"], shards=4))
    # One slice brings both rows with and without a time; null keys are a key of their own.
    mixed = run(spark, frame, f"{tmp_path}/whole", lambda stream: revisions.stream_revisions(
        stream, "id", ["ts", "at"], shards=4))
    expected = revisions.batch_revisions(frame, "id", ["ts", "at"])
    assert rows(mixed.select(expected.columns)) == rows(expected)
    state = spark.read.format("statestore").option("stateVarName", "last").load(f"{tmp_path}/state")
    assert state.select("key").distinct().count() <= 4
    assert state.count() == found.select("id").distinct().count() > 4
