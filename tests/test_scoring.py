import json

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
from row_text import rows

from palimpsest.sources.schemas import ENVELOPE
from palimpsest.streaming import landing, scoring
from palimpsest.streaming.scoring import domain_bounds, score_messages


def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


class Halves:
    """In place of a fitted model: suspicion is a tenth of the magnitude."""

    def transform(self, records):
        share = F.coalesce(F.col("first_magnitude"), F.lit(0.0)) / 10
        return records.withColumn("probability", array_to_vector(F.array(1 - share, share))).withColumn(
            "prediction", (share > 0.5).cast("double"))


def message(name, magnitude, scale="mb"):
    return json.dumps({"usgs_id": name, "raw": {"id": name, "properties": {
        "mag": magnitude, "magType": scale, "status": "automatic", "net": "us", "time": 1_700_000_000_000},
        "geometry": {"coordinates": [1.0, 2.0, 3.0]}}})


DATA = [message("a", 4.5), message("b", 6.0), message("c", 6.0, "mww"), message("d", None), message("e", 1.0, "xx"),
        message("f", 4.0, "xx"), "no envelope", message("", 5.0), message("a", 4.6)]


@pytest.fixture(scope="module")
def bounds(spark):
    train = spark.createDataFrame([("body_wave", 5.0), ("body_wave", 7.0), ("moment", 3.0), ("local", None)],
                                  "first_family string, first_magnitude double")
    return domain_bounds(train)


def test_states_by_the_bound_of_their_family(spark, bounds):
    found = score_messages(spark.createDataFrame([(x,) for x in DATA], "value string"), ENVELOPE, Halves(), bounds, now())
    got = [(r.id, r.magnitude, r.suspicion, r.in_domain, r.etat) for r in found.collect()]
    assert sorted(got, key=str) == sorted([
        ("a", 4.5, 45.0, False, "hors_domaine"), ("a", 4.6, 46.0, False, "hors_domaine"), ("b", 6.0, 60.0, True, "suspect"),
        ("c", 6.0, 60.0, True, "suspect"), ("d", None, None, None, None), ("e", 1.0, 10.0, False, "hors_domaine"),
        ("f", 4.0, 40.0, True, "stable")], key=str)


def test_two_halves_of_a_stream_give_what_the_batch_gives(spark, bounds, tmp_path):
    for half in (DATA[:4], DATA[4:]):
        spark.createDataFrame([(x,) for x in half], "value string").write.mode("append").parquet(f"{tmp_path}/in")
        stream = landing.read_stream(spark, "parquet", {"maxFilesPerTrigger": "100"}, "value string", f"{tmp_path}/in")
        (score_messages(stream, ENVELOPE, Halves(), bounds, now()).drop("updated").writeStream.format("parquet")
         .option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state")
         .trigger(availableNow=True).start().awaitTermination())
    batch = score_messages(spark.createDataFrame([(x,) for x in DATA], "value string"), ENVELOPE, Halves(), bounds, now())
    found = spark.read.parquet(f"{tmp_path}/out")
    names = ["id", "magnitude", "suspicion", "suspect", "in_domain", "etat"]
    assert rows(found.select(names)) == rows(batch.select(names))


def test_bounds_are_few_or_refused(spark, bounds, monkeypatch):
    monkeypatch.setattr(scoring, "MAX_HOT", 1)
    with pytest.raises(ValueError):
        score_messages(spark.createDataFrame([], "value string"), ENVELOPE, Halves(), bounds, now())
