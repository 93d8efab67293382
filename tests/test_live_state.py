"""State that expires, sessions, rings and totals kept by streams, over restarts and repetitions."""
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from row_text import rows

from palimpsest.session import STATE_STORE
from palimpsest.streaming import landing, revisions, sink
from palimpsest.streaming.reorder import reordered_revisions
from palimpsest.streaming.ring import merge_rings, newest_by_shard
from palimpsest.streaming.sessions import sessions

START = datetime(2025, 1, 1)
LIMIT = {"maxFilesPerTrigger": "100"}
MESSAGES = "id string, at long, ts timestamp, magnitude double, status string"


@pytest.fixture(autouse=True)
def state_store(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def feed(spark, folder, schema, data):
    frame = spark.createDataFrame(data, schema).coalesce(1)
    frame.write.mode("append").parquet(f"{folder}/in")
    return landing.read_stream(spark, "parquet", LIMIT, frame.schema, f"{folder}/in")


def append(results, folder):
    query = (results.writeStream.format("parquet").option("path", f"{folder}/out").outputMode("append")
             .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def minute(at):
    return START + timedelta(minutes=at)


def reordered(stream):
    return reordered_revisions(stream, "id", "ts", ["at"], "10 minutes", 3600)


def test_late_rows_are_put_in_order_before_they_are_judged(spark, tmp_path):
    slices = [
        [("a", 2, minute(3), 4.2, "automatic"), ("b", 9, minute(1), None, None)],
        [("a", 1, minute(0), 4.0, "automatic"), ("a", 3, minute(3), 4.2, "automatic"), ("x", 0, None, 1.0, "x")],
        [("a", 4, minute(9), 4.2, "reviewed"), ("b", 8, minute(1), None, None), ("z", 0, minute(40), 0.0, "z")]]
    for piece in slices:
        append(reordered(feed(spark, tmp_path, MESSAGES, piece)), tmp_path)
    found = spark.read.parquet(f"{tmp_path}/out")
    assert [(r.at, r.kind, r.previous_magnitude, r.previous_status) for r in found.where("id = 'a'").orderBy("at").collect()] == [
        (1, "nouveau", None, None), (2, "revise", 4.0, "automatic"), (3, "repete", None, None), (4, "revise", 4.2, "automatic")]
    assert [(r.at, r.kind) for r in found.where("id = 'b'").orderBy("at").collect()] == [(8, "nouveau"), (9, "repete")]
    # The last message waits for the watermark; that without a time is left out.
    assert found.where("id in ('x', 'z')").count() == 0


def test_any_cut_of_the_stream_gives_the_batch_result(spark, tmp_path):
    rng = random.Random(4)
    data = [(rng.choice("abc"), at, minute(rng.randrange(600)), rng.choice([None, 1.0, 2.0]), rng.choice(["p", None]))
            for at in range(150)] + [("end", 999, minute(9999), 0.0, "p")]
    data.sort(key=lambda row: (row[2] + timedelta(minutes=rng.randrange(9)), row[1]))
    for low, high in ((0, 40), (40, 90), (90, len(data))):
        append(reordered(feed(spark, tmp_path, MESSAGES, data[low:high])), tmp_path)
    frame = spark.createDataFrame(data[:-1], MESSAGES)
    expected = revisions.batch_revisions(frame, "id", ["ts", "at"])
    found = spark.read.parquet(f"{tmp_path}/out").select(expected.columns)
    gaps = {}
    for row in sorted(data[:-1], key=lambda row: (row[0], row[2], row[1])):
        gaps.setdefault(row[0], []).append(row)
    silent = {b[1] for of in gaps.values() for a, b in zip(of, of[1:]) if b[2] - a[2] >= timedelta(hours=1)}
    again = F.col("at").isin(*silent)
    expected = expected.withColumn("kind", F.when(again, "nouveau").otherwise(F.col("kind"))).withColumns(
        {name: F.when(~again, F.col(name)) for name in ("previous_magnitude", "previous_status")})
    assert rows(found) == rows(expected.select(found.columns))


def test_state_shrinks_when_keys_fall_silent(spark, tmp_path):
    def keys():
        state = spark.read.format("statestore").option("stateVarName", "last").load(f"{tmp_path}/state")
        return state.select("key.id").distinct().count()

    append(reordered(feed(spark, tmp_path, MESSAGES, [
        *[(f"k{at}", at, minute(at), 1.0, "p") for at in range(20)], ("on", 0, minute(50), 1.0, "p")])), tmp_path)
    append(reordered(feed(spark, tmp_path, MESSAGES, [("on", 1, minute(70), 1.0, "p")])), tmp_path)
    assert keys() == 21
    append(reordered(feed(spark, tmp_path, MESSAGES, [("on", 2, minute(100), 1.0, "p")])), tmp_path)
    assert keys() == 1
    append(reordered(feed(spark, tmp_path, MESSAGES, [("k3", 9, minute(101), 1.0, "p"), ("on", 3, minute(130), 1.0, "p")])),
           tmp_path)
    found = spark.read.parquet(f"{tmp_path}/out")
    assert found.where("id = 'k3'").select("kind").collect() == [("nouveau",), ("nouveau",)]
    assert found.where("id = 'on' and kind = 'nouveau'").count() == 1


def test_keys_of_a_shard_share_calls_and_are_forgotten(spark, tmp_path):
    rng = random.Random(6)
    data = [(rng.choice([None, *range(40)]), at, minute(rng.randrange(400)), rng.choice([None, 1.0, 2.0]),
             rng.choice(["p", None])) for at in range(400)] + [(99, 999, minute(9999), 0.0, "p")]
    data.sort(key=lambda row: (row[2] + timedelta(minutes=rng.randrange(9)), row[1]))
    schema = MESSAGES.replace("id string", "id long")
    groups = []
    for low, high in ((0, 150), (150, 300), (300, len(data))):
        for folder, shards in (("one", None), ("dealt", 3)):
            path = f"{tmp_path}/{folder}"
            append(reordered_revisions(feed(spark, path, schema, data[low:high]), "id", "ts", ["at"], "10 minutes",
                                       3600, shards), path)
        state = spark.read.format("statestore").option("stateVarName", "waiting").load(f"{tmp_path}/dealt/state")
        groups.append(state.select("key").distinct().count())
    # Forty keys are put in order by at most three calls a micro-batch.
    assert 1 <= min(groups) and max(groups) <= 3
    found = spark.read.parquet(f"{tmp_path}/dealt/out")
    assert found.count() == 400 and found.where("id is null").count() > 0
    assert rows(found) == rows(spark.read.parquet(f"{tmp_path}/one/out"))
    assert found.where("kind = 'nouveau'").count() > 41 and found.where("kind = 'repete'").count() > 0
    # After a silence of all keys nothing is kept of them.
    last = spark.read.format("statestore").option("stateVarName", "last").load(f"{tmp_path}/dealt/state")
    assert last.count() == 0


def test_sessions_merge_over_restarts(spark, tmp_path):
    def build(stream):
        return sessions(stream, ["id"], "ts", "10 minutes", {"n": F.count(F.lit(1)), "top": F.max("magnitude")}, "30 minutes")

    slices = [[("a", 1, minute(0), 1.0, "p"), ("a", 2, minute(16), 5.0, "p"), (None, 3, minute(1), 2.0, "p")],
              [("a", 4, minute(8), 2.0, "p"), ("a", 5, minute(27), 1.0, "p"), ("x", 6, None, 1.0, "p")],
              [("b", 7, minute(100), 1.0, "p")]]
    for piece in slices:
        append(build(feed(spark, tmp_path, MESSAGES, piece)), tmp_path)
    found = spark.read.parquet(f"{tmp_path}/out")
    # Eight minutes joins the first two; minute 27 is more than ten after 16; b is not over yet.
    assert sorted(((r.id or "", r.session_start, r.session_end, r.n, r.top) for r in found.collect())) == [
        ("", minute(1), minute(11), 1, 2.0), ("a", minute(0), minute(26), 3, 5.0), ("a", minute(27), minute(37), 1, 1.0)]
    batch = sessions(spark.read.parquet(f"{tmp_path}/in"), ["id"], "ts", "10 minutes",
                     {"n": F.count(F.lit(1)), "top": F.max("magnitude")})
    assert rows(batch.where("id is null or id <> 'b'")) == rows(found)


def test_ring_keeps_the_newest(spark, tmp_path):
    rng = random.Random(2)
    data = [(rng.choice("ab"), at, minute(rng.randrange(300)) if at % 11 else None, 1.0, None) for at in range(120)]
    data += data[100:105]
    for low in range(0, len(data), 50):
        stream = feed(spark, tmp_path, MESSAGES, data[low:low + 50])
        rings = newest_by_shard(stream, ["ts", "at"], size=20, shards=3)
        sink.start(rings, f"{tmp_path}/rings", f"{tmp_path}/state").awaitTermination()
        kept = sink.newest(spark, f"{tmp_path}/rings", rings.schema, ["shard"])
        assert kept.count() <= 60 and kept.groupBy("shard").count().where("count > 20").count() == 0
        frame = spark.createDataFrame(data[:low + 50], MESSAGES)
        expected = frame.orderBy(F.desc_nulls_last("ts"), F.desc("at")).limit(20)
        assert rows(merge_rings(kept, ["ts", "at"], ["ts"], 20).select(expected.columns)) == rows(expected)


def test_totals_stand_after_a_batch_is_repeated(spark, tmp_path):
    schema = "id string, kind string"

    def run(data):
        totals = revisions.running_totals(feed(spark, tmp_path, schema, data))
        sink.start(totals, f"{tmp_path}/totals", f"{tmp_path}/state").awaitTermination()
        return revisions.total_counters(sink.newest(spark, f"{tmp_path}/totals", totals.schema, ["kind"])).first()

    assert run([("a", "nouveau"), ("b", "nouveau"), ("a", "revise")]) == (3, 2, 2, 1, 0)
    assert run([("a", "repete"), ("c", "nouveau")]) == (5, 3, 3, 1, 1)
    # The second batch ended, but its end was not noted down: it runs again.
    commits = f"{tmp_path}/state/commits"
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    assert not os.path.exists(f"{commits}/1")
    assert run([("d", "nouveau")]) == (6, 4, 4, 1, 1)
    batches = sink.read_batches(spark, f"{tmp_path}/totals", "kind string, messages long")
    assert batches.select("batch").distinct().count() == 3
    assert batches.where("batch = 1").count() == 2


def test_totals_of_nothing(spark):
    empty = spark.createDataFrame([], "kind string, messages long")
    assert revisions.total_counters(empty).first() == (0, 0, 0, 0, 0)
