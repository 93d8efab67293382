from pathlib import Path

import pytest
from row_text import rows
from pyspark.sql import functions as F

from palimpsest.operators.snapshot_diff import compare_snapshots, diff_summary, largest_gaps
from palimpsest.scratch import NoSharedFolder, all_files_there, materialise, scope, shared_root
from palimpsest.sources import ingest
from palimpsest.sources.files import (TableMissing, available_tables, layer_footprint,
                                      load_table, read_optional, write_table)
from palimpsest.sources.snapshots import RepeatedKey, SnapshotTable, read_as_of

LINES = "period string, value string"


def lines_of(spark, months, per_month=5):
    return spark.createDataFrame([(m, f"{m}-{at}") for m in months for at in range(per_month)],
                                 LINES)


def test_scratch_is_the_folder_of_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert rows(materialise(spark.range(3), "t")) == [("0",), ("1",), ("2",)]


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})

    with pytest.raises(NoSharedFolder):
        shared_root(Session())


def test_a_scope_leaves_its_folder_empty(spark):
    with scope(spark) as folder:
        frame = materialise(spark.range(5), "t")
        assert all_files_there(frame) and frame.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(
            folder.split(":", 1)[-1].lstrip("/"))
        with scope(spark) as inner:
            materialise(spark.range(2), "u")
        assert not Path(inner).exists() and frame.count() == 5
    assert not Path(folder).exists()
    assert not all_files_there(frame)


def test_replay_writes_nothing_twice(spark, tmp_path):
    landing = ingest.BatchLanding(spark, str(tmp_path / "lake"), limit=100)
    lines = lines_of(spark, ["2025-01", "2025-02", "2025-03"])
    landing.ingest(lines.filter("period = '2025-01'"))
    first = rows(ingest.replay_state(landing))
    landing.ingest(lines)
    complete, marks = rows(ingest.replay_state(landing)), rows(landing.manifest())
    landing.ingest(lines)
    assert first != complete
    assert rows(ingest.replay_state(landing)) == complete and rows(landing.manifest()) == marks
    assert landing.manifest().count() == 3


def test_interrupted_write_is_invisible_and_replaced(spark, tmp_path):
    landing = ingest.BatchLanding(spark, str(tmp_path / "lake"), limit=100)
    lines = lines_of(spark, ["2025-01", "2025-02"])
    landing.ingest(lines.filter("period = '2025-01'"))
    lines.filter("period = '2025-02'").limit(2).write.mode("append").partitionBy("period").text(
        f"{landing.root}/data")
    assert landing.landed().count() == 5
    landing.ingest(lines)
    assert rows(landing.landed().select("period", "value")) == rows(lines)


def outcomes(frame):
    return sorted((r.period, r.outcome) for r in frame.collect())


def test_every_batch_has_an_outcome(spark, tmp_path):
    lines = lines_of(spark, ["2025-01"], 9).unionByName(lines_of(spark, ["2025-02", "2025-03"], 4))
    landing = ingest.BatchLanding(spark, str(tmp_path / "lake"), limit=5)
    first = landing.ingest(lines)
    assert outcomes(first) == [("2025-01", "rejected"), ("2025-02", "landed"), ("2025-03", "landed")]
    with pytest.raises(ingest.BatchesRefused, match="2025-01: rejected .9 events"):
        ingest.require_landed(first)
    landing = ingest.BatchLanding(spark, landing.root)
    again = ingest.require_landed(landing.ingest(lines))
    assert outcomes(again) == [("2025-01", "landed"), ("2025-02", "already marked"), ("2025-03", "already marked")]
    assert landing.landed().count() == 17 and landing.manifest().count() == 3


def test_what_was_written_wrong_is_not_marked(spark, tmp_path, monkeypatch):
    landing = ingest.BatchLanding(spark, str(tmp_path / "lake"))
    real = landing.written
    monkeypatch.setattr(landing, "written", lambda names: real(names).withColumn(
        "digest", F.when(F.col("period") == "2025-01", "0").otherwise(F.col("digest"))))
    assert outcomes(landing.ingest(lines_of(spark, ["2025-01", "2025-02"]))) == [
        ("2025-01", "mismatch"), ("2025-02", "landed")]
    assert [r.period for r in landing.manifest().collect()] == ["2025-02"]


def test_force_lands_a_marked_batch_again(spark, tmp_path):
    landing = ingest.BatchLanding(spark, str(tmp_path / "lake"))
    landing.ingest(lines_of(spark, ["2025-01", "2025-02"]))
    longer = lines_of(spark, ["2025-01"], 8)
    assert outcomes(landing.ingest(longer)) == [("2025-01", "already marked")]
    assert outcomes(landing.ingest(longer, force=True)) == [("2025-01", "landed")]
    assert landing.landed().count() == 13
    assert {r.period: r.events for r in landing.manifest().collect()} == {"2025-01": 8, "2025-02": 5}


def test_the_check_reads_only_what_was_written(spark, tmp_path):
    landing = ingest.BatchLanding(spark, str(tmp_path / "lake"))
    landing.ingest(lines_of(spark, ["2025-01", "2025-02", "2025-03"]))
    plan = landing.written(["2025-02"])._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "2025-02" in scan.split("PartitionFilters")[1]


def test_cut_batches_stay_pending(spark, tmp_path):
    landing = ingest.BatchLanding(spark, str(tmp_path / "lake"), limit=5)
    lines = lines_of(spark, ["2025-01"], 5).unionByName(lines_of(spark, ["2025-02"], 4))
    assert ingest.truncated_batches(lines, 5).collect() == [("2025-01", 5)]
    landing.ingest(lines)
    bounds = spark.sql("select date'2024-12-15' a, date'2025-02-01' b")
    calendar = ingest.month_calendar(bounds, "a", "b")
    assert [str(r.ends_before) for r in calendar.orderBy("period").collect()] == [
        "2025-01-01", "2025-02-01", "2025-03-01"]
    left = ingest.pending(calendar, landing.manifest())
    assert sorted(r.period for r in left.collect()) == ["2024-12", "2025-01"]


def test_replay_of_nothing_is_no_proof(spark, tmp_path):
    landing = ingest.BatchLanding(spark, str(tmp_path / "lake"))
    landing.ingest(spark.createDataFrame([], LINES))
    with pytest.raises(ingest.EmptyCheck):
        ingest.replay_state(landing)


def test_digest_is_free_of_order(spark):
    lines = lines_of(spark, ["m"])
    shuffled = lines.orderBy(F.desc("value")).repartition(3)
    assert rows(ingest.describe(lines, "period")) == rows(ingest.describe(shuffled, "period"))


def test_cohorts_and_batches(spark):
    frame = spark.createDataFrame(
        [(f"t{at}", f",t{at},usauto{at},") for at in range(7)]
        + [(f"c{at:03}", f",c{at:03},") for at in range(50)] + [(None, ",usauto9,")]
        + [(f"t{at}", f",t{at},") for at in range(7)],  # also without the automatic alias
        "id string, ids string")
    chosen = ingest.select_cohorts(frame, "id", "ids", control=20)
    again = ingest.select_cohorts(frame.repartition(7), "id", "ids", control=20)
    assert rows(chosen) == rows(again) and chosen.count() == 27
    other = ingest.select_cohorts(frame, "id", "ids", control=20, seed=1)
    assert rows(other) != rows(chosen)
    batches = ingest.assign_batches(chosen, [F.col("cohort") != "traced", F.col("event_id")], 10)
    assert sorted(map(tuple, batches.groupBy("batch").count().collect())) == [
        (0, 10), (1, 10), (2, 7)]
    assert batches.filter("batch = 0 and cohort = 'traced'").count() == 7
    answers = chosen.select("event_id", F.lit("xy").alias("value")).filter("cohort = 'traced'")
    made = {r.batch: (r.requested, r.events, r.failures, r.bytes)
            for r in ingest.batch_manifest(batches, answers).collect()}
    assert made == {0: (10, 7, 3, 21), 1: (10, 0, 10, 0), 2: (7, 0, 7, 0)}


def test_snapshots(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    with pytest.raises(TableMissing):
        table.read()
    first = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    table.merge(first, ["k"])
    table.merge(spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"), ["k"])
    assert rows(table.read()) == [("'a'", "1"), ("'b'", "2"), ("'c'", "2")]
    assert rows(table.as_of(0)) == rows(first)
    assert [tuple(r)[:1] + tuple(r)[2:] for r in table.history().collect()] == [
        (1, "MERGE", 3, 1, 1), (0, "WRITE", 2, None, None)]
    assert rows(read_as_of(spark, table.root, 0)) == rows(first)
    with pytest.raises(TableMissing):
        table.as_of(7)


def test_a_source_with_a_key_twice_is_refused(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(RepeatedKey):
        table.merge(twice, ["k"])
    table.merge(twice.limit(1), ["k"])
    with pytest.raises(RepeatedKey):
        table.merge(twice, ["k"])
    assert table.read().count() == 1 and table.history().count() == 1


def test_interrupted_snapshot_is_not_seen(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.overwrite(spark.range(3))
    spark.range(99).write.parquet(f"{table.root}/data/snapshot=1")
    assert table.read().count() == 3
    assert table.overwrite(spark.range(4)) == 1 and table.read().count() == 4


STATE = "event_key string, place string, event_time timestamp, magnitude double, " \
        "magnitude_type string, review_status string, usgs_id string"


def test_diff_of_all_kinds_with_nulls(spark):
    def state(*entries):
        return spark.createDataFrame(
            [(key, "p", None, m, "mb", "reviewed", i) for key, m, i in entries], STATE)

    before = state(("gone", 1.0, "u"), ("same", None, None), ("moved", 1.0, "u"),
                   ("lost", 2.0, "u"))
    after = state(("new", 1.0, None), ("same", None, None), ("moved", 1.6, "u"),
                  ("lost", None, "u"))
    every = compare_snapshots(before, after, keep_unchanged=True)
    assert {r.event_key: r.statut for r in every.collect()} == {
        "gone": "disparu", "same": "inchange", "moved": "modifie", "lost": "modifie",
        "new": "apparu"}
    changed = compare_snapshots(before, after)
    assert sorted(map(tuple, diff_summary(changed).collect())) == [
        ("apparu", 1), ("disparu", 1), ("modifie", 2)]
    assert [(r.event_key, r.ecart_magnitude) for r in largest_gaps(changed).collect()] == [
        ("moved", 0.6)]


def test_tables_by_name(spark, tmp_path):
    root = str(tmp_path)
    assert read_optional(spark, f"{root}/none") is None
    with pytest.raises(TableMissing):
        load_table(spark, root, "none")
    write_table(spark.range(5), root, "five")
    write_table(spark.range(6), root, "five")
    assert load_table(spark, root, "five").count() == 6
    assert rows(available_tables(spark, root)) == [("'five'",)]
    layers = layer_footprint(spark, {"gold": f"{root}/five"}).first()
    assert layers.couche == "gold" and layers.fichiers >= 1 and layers.octets > 0
