import pytest
from pyspark.sql import functions as F

from palimpsest.plans.profile import observed, profile

STEPS = [("all", lambda frame: frame), ("kept", lambda frame: frame.where("id % 3 = 0")),
         ("twice", lambda frame: frame.withColumn("x", F.explode(F.array(F.lit(1), F.lit(2))))),
         ("grouped", lambda frame: frame.groupBy("id").count())]


def test_rows_of_each_step_in_one_run(spark, tmp_path):
    source = spark.range(0, 90, 1, 4)
    found = profile(source, STEPS, "id", lambda frame: frame.write.parquet(f"{tmp_path}/out"))
    assert [tuple(row) for row in found.orderBy("place").collect()] == [
        ("all", 1, 90, 0), ("kept", 2, 30, 0), ("twice", 3, 60, 0), ("grouped", 4, 30, 0)]
    assert spark.read.parquet(f"{tmp_path}/out").count() == 30


def test_null_keys_and_no_rows(spark):
    source = spark.createDataFrame([(None,), (3,)], "id long")
    assert [row.null_keys for row in profile(source, STEPS[:1], "id").collect()] == [1]
    assert [row.rows for row in profile(source.limit(0), STEPS[:3], "id").orderBy("place").collect()] == [0, 0, 0]


def test_names_stand_once(spark):
    with pytest.raises(ValueError):
        observed(spark.range(3), [STEPS[0], STEPS[0]], "id")
