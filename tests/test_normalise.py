import json

import pytest
from pyspark.sql import functions as F

from palimpsest.operators.live import (alarm_flags, domain_state, parse_messages, search_place)
from palimpsest.operators.normalise import (FLAT_COLUMNS, active_versions, explode_versions,
                                            flatten_features, union_sources)
from palimpsest.operators.profiles import nested_total, review_lag
from palimpsest.operators.rings import compact_rings, ring_points
from palimpsest.sources.files import read_documents, read_envelopes, read_versions
from palimpsest.sources.schemas import ENVELOPE, FEATURE


def feature(identifier, coordinates=(1.0, 2.0, 3.0), **properties):
    return {"type": "Feature", "id": identifier,
            "properties": {"mag": 4.5, "magType": "mb", "time": 1_700_000_000_123,
                           "ids": f",{identifier},", **properties},
            "geometry": {"type": "Point", "coordinates": list(coordinates)}}


def test_scans_of_envelopes_and_documents(spark, tmp_path):
    live = tmp_path / "ingest_date=2025-01-01"
    live.mkdir()
    lines = [json.dumps({"fetched_at": "x", "usgs_id": "us1", "raw": feature("us1")}),
             "{not json", json.dumps({"fetched_at": "x", "raw": {"id": None}}),
             json.dumps({"fetched_at": "x", "raw": feature("us2", (1.0, 2.0))}),
             json.dumps({"fetched_at": "x", "raw": feature("us3", time=None)})]
    (live / "part.txt").write_text("\n".join(lines))
    flat = flatten_features(read_envelopes(spark, f"{tmp_path}/ingest_date=*/*.txt"), "live")
    assert flat.columns == list(FLAT_COLUMNS)
    got = {row.usgs_id: row for row in flat.collect()}
    assert got.keys() == {"us1", "us2"} and got["us2"].depth_km is None
    assert got["us1"].event_time.microsecond == 123000
    assert got["us1"].longitude == 1.0 and got["us1"].latitude == 2.0

    (tmp_path / "events.geojson").write_text(json.dumps(
        {"type": "FeatureCollection", "features": [feature("us8"), feature("us9")]}, indent=1))
    catalog = flatten_features(read_documents(spark, f"{tmp_path}/events.geojson"), "catalog")
    merged = union_sources([flat.drop("place"), None, catalog])
    assert merged.groupBy("origin").count().orderBy("origin").collect() == [
        ("catalog", 2), ("live", 2)]
    with pytest.raises(ValueError):
        union_sources([None])


def test_dirty_version_products(spark, tmp_path):
    def product(status, **properties):
        return {"source": "us", "code": "c", "status": status, "updateTime": 1_700_000_000_000,
                "properties": {k.replace("_", "-"): v for k, v in properties.items()}}

    document = {"event_id": "e", "event_time": 1_700_000_000_000, "cohort": "traced",
                "products": {"origin": [
                    product("UPDATE", magnitude="4.5", magnitude_type=" MB "),
                    product("UPDATE", magnitude="1.5x"), product("UPDATE"),
                    product("DELETE", magnitude="4.6"), product(None, magnitude="4.7")]}}
    (tmp_path / "versions.jsonl").write_text(
        json.dumps(document) + "\n" + json.dumps({"event_id": None}) + "\n")
    versions = explode_versions(read_versions(spark, f"{tmp_path}/versions.jsonl"))
    assert versions.count() == 5
    row, = active_versions(versions).collect()
    assert (row.magnitude, row.magnitude_type, row.product_status) == (4.5, "mb", "update")


def test_messages_without_identifier_are_ignored(spark):
    texts = [json.dumps({"usgs_id": "us1", "raw": feature("us1")}), "{broken",
             json.dumps({"usgs_id": "", "raw": {}}), json.dumps({"raw": feature("us2", ())}),
             json.dumps([1, 2])]
    frame = spark.createDataFrame([(at, text) for at, text in enumerate(texts)],
                                  "offset int, value string")
    got = {r.id: (r.offset, r.latitude) for r in parse_messages(frame, ENVELOPE).collect()}
    assert got == {"us1": (0, 2.0), "us2": (3, None)}


def test_states_alarms_and_search(spark):
    frame = spark.createDataFrame(
        [(None, True, None, None, None, None), (3.9, True, 19, 181.0, "automatic", "South Pole"),
         (4.0, True, 20, 180.0, "reviewed", "north"), (4.0, False, 20, 180.0, "x", "NORTHERN")],
        "m double, s boolean, n int, g double, st string, place string")
    states = [r[0] for r in frame.select(domain_state(F.col("m"), F.col("s"))).collect()]
    assert states == [None, "hors_domaine", "suspect", "stable"]
    flags = alarm_flags(F.col("n"), F.col("g"), F.col("st"))
    assert [tuple(r) for r in frame.select(*flags.values()).collect()] == [
        (False, False, False), (True, True, True), (False, False, False), (False, False, False)]
    assert search_place(frame, " North ").count() == 2 and search_place(frame, " ").count() == 4


def test_negative_lags_leave_after_rounding(spark):
    frame = spark.createDataFrame([(0,), (-2,), (-3,), (60,)], "s int").select(
        F.lit("r").alias("review_status"), F.lit("f").alias("magnitude_family"),
        F.timestamp_seconds(F.lit(1000)).alias("event_time"),
        F.timestamp_seconds(F.lit(1000) + F.col("s")).alias("updated_time"))
    for exact in (True, False):
        row = review_lag(frame, exact).first()
        assert (row.events, row.lag_median_minutes, row.lag_p90_minutes) == (3, 0.0, 1.0)


def test_nested_total_counts_absent_arrays_as_empty(spark):
    frame = spark.createDataFrame([([1, 2],), ([],), (None,)], "a array<int>")
    assert nested_total(frame, "a", "n").first()["n"] == 2


@pytest.mark.parametrize("limit", [2, 1_000_000])
def test_rings(spark, limit):
    square = [[0.001, 0.0], [0.002, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 1.004]]
    thin = [[0.0, 0.0], [0.001, 0.001], [5.0, 5.0], [5.001, 5.0]]
    frame = spark.createDataFrame([
        ("p", ("Polygon", json.dumps([square, thin]))),
        ("m", ("MultiPolygon", json.dumps([[square], [thin, square]]))),
        ("x", ("Point", json.dumps([1.0, 2.0])))],
        "key string, geometry struct<type: string, coordinates: string>")
    points = compact_rings(ring_points(frame, "key"), ["key", "ring"], [F.col("position")],
                           rows_per_task=limit)
    got = {}
    for row in points.orderBy("key", "ring", "point").collect():
        got.setdefault((row.key, row.ring), []).append((row.x, row.y))
    expected = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    assert got == {("p", 0): expected, ("m", 0): expected, ("m", 2): expected}
