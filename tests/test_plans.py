import json

import pytest

from pyspark.sql import functions as F

from palimpsest.plans.bundle import build_bundle, write_bundle
from palimpsest.plans.gold import event_tables, revision_tables, write_tables
from palimpsest.sources.ingest import BatchLanding, EmptyCheck
from palimpsest.plans.silver import events_timeline, store_events, version_history
from palimpsest.sources.snapshots import SnapshotTable


def feature(identifier, magnitude, updated, ids=None):
    return {"type": "Feature", "id": identifier,
            "properties": {"mag": magnitude, "magType": "mb", "time": 1_700_000_000_000,
                           "updated": updated, "status": "automatic", "felt": 7, "cdi": 3.0,
                           "mmi": 2.0, "ids": ids or f",{identifier},"},
            "geometry": {"type": "Point", "coordinates": [1.0, 2.0, 3.0]}}


def test_from_files_to_finished_tables(spark, tmp_path):
    (tmp_path / "live.txt").write_text("\n".join(json.dumps(
        {"fetched_at": "x", "usgs_id": "us1", "raw": entry}) for entry in (
            feature("us1", 4.0, 1_700_000_060_000), feature("us1", 4.0, 1_700_000_120_000),
            feature("us1", 4.6, 1_700_000_180_000))))
    (tmp_path / "catalog.json").write_text(json.dumps(
        {"features": [feature("us1", 4.6, 1_700_000_240_000), feature("us2", 5.0, None)]}))
    timeline = events_timeline(spark, str(tmp_path / "catalog.json"),
                               str(tmp_path / "live.txt"))
    table = SnapshotTable(spark, str(tmp_path / "silver"), ["origin"])
    assert store_events(timeline, table) == 0 and store_events(timeline, table) == 1
    stored = table.read()
    assert stored.count() == 3 and stored.filter("is_current").count() == 2

    landing = BatchLanding(spark, str(tmp_path / "versions"), "batch")
    with pytest.raises(EmptyCheck):
        version_history(landing)
    document = json.dumps({
        "event_id": "us1", "event_time": 1_700_000_000_000, "cohort": "traced", "place": "p",
        "products": {"origin": [
            {"source": "us", "code": "c", "status": "UPDATE", "updateTime": 1_700_000_060_000,
             "properties": {"magnitude": "4.0", "magnitude-type": "mb"}},
            {"source": "us", "code": "c", "status": "UPDATE", "updateTime": 1_700_000_180_000,
             "properties": {"magnitude": "4.6", "magnitude-type": "mww"}}]}})
    unmarked = document.replace("us1", "us9")
    spark.createDataFrame([("1", unmarked)], "batch string, value string").write.partitionBy("batch").text(
        str(tmp_path / "versions/data"))
    landing.ingest(spark.createDataFrame([("0", document)], "batch string, value string"))
    ranked = version_history(landing)
    assert {r.event_id for r in ranked.collect()} == {"us1"}
    plan = version_history(landing)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    tables = {**event_tables(stored), **revision_tables(ranked, stored)}
    paths = write_tables(tables, str(tmp_path / "gold"))
    assert len(paths) == 8
    history, = spark.read.parquet(paths["revision_history"]).collect()
    assert (history.event_key, history.magnitude_shift, history.minutes_to_final) == (
        "us1", 0.6, 2.0)
    witness, = spark.read.parquet(paths["human_witness"]).collect()
    assert witness.has_witness and witness.witness_louder and witness.moved_up
    curve = spark.read.parquet(paths["alert_curve"])
    assert curve.filter("threshold = 4.5").first().alerte_manquee == 1


def test_bundle_pages_long_timelines(spark, tmp_path):
    versions = spark.range(1, 2502).select(F.lit("e").alias("event_id"),
                                           F.col("id").alias("version_rank"),
                                           (F.col("id") / 10).alias("magnitude"))
    report = spark.createDataFrame([("a", 1)], "nom string, seismes int")
    bundle = build_bundle({"familles": report, "modele": None}, versions, "event_id",
                          "version_rank")
    write_bundle(bundle, str(tmp_path / "bundle"))
    found = spark.read.json(str(tmp_path / "bundle"))
    pages = found.filter("section = 'chronologies'").orderBy("page").collect()
    assert [len(json.loads(page.contenu)) for page in pages] == [1000, 1000, 501]
    ranks = [entry["version_rank"] for page in pages for entry in json.loads(page.contenu)]
    assert ranks == list(range(1, 2502))
    assert json.loads(found.filter("section = 'familles'").first().contenu) == {
        "nom": "a", "seismes": 1}


def test_filters_and_columns_reach_the_scan(spark, sf):
    from catalogue.batch import THRESHOLDS, dataset
    from palimpsest.operators.thresholds import alert_curve

    plan = alert_curve(dataset(spark, sf), thresholds=THRESHOLDS)._jdf.queryExecution()
    scans = [line for line in plan.executedPlan().toString().splitlines() if "FileScan" in line]
    lineitem = next(line for line in scans if "lineitem" in line)
    assert "l_returnflag" not in lineitem.split("ReadSchema")[1]
    assert "CartesianProduct" not in plan.toString()


def test_version_documents_are_compressed_in_files_of_bounded_length(spark, sf, monkeypatch):
    from catalogue import landing

    monkeypatch.setattr(landing, "LINES_PER_FILE", 1000, raising=False)
    documents = landing.version_documents(spark, sf)
    files = documents.inputFiles()
    assert all(name.endswith(".gz") for name in files)
    assert max(spark.read.text(name).count() for name in files[:2]) <= 1000
    assert documents.count() == spark.read.parquet(f"{sf}/lineitem.parquet").count()
