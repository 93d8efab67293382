import random

from pyspark.sql import functions as F

from palimpsest.operators.sketches import merged_quantiles, rank_error, sketch_by_period, within_error

WANTED = {"median": ("x", 0.5), "p90": ("x", 0.9), "low": ("y", 0.1)}


def test_marks_of_merged_periods_are_within_the_error(spark):
    # One group owns most rows; the others are small, one has no value at all.
    frame = spark.range(0, 200_000, 1, 6).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        (F.col("id") % 12).alias("month"), (F.rand(3) * F.rand(4)).alias("x"), (-F.col("id")).cast("double").alias("y"))
    frame = frame.unionAll(spark.createDataFrame(
        [("none", 1, None, float("nan")), (None, 1, 5.0, 1.0)], "g string, month long, x double, y double"))
    sketches = sketch_by_period(frame, ["g"], F.col("month"), ["x", "y"])
    assert sketches.count() <= 9 * 12
    marks = merged_quantiles(sketches, ["g"], WANTED)
    found = {row.g: row for row in marks.collect()}
    assert found["none"].median is None and found["none"].n_x == 0
    assert found[None].median == 5.0 and found["hot"].n_x == 160_000
    real = frame.where("g is null or g <> 'none'")
    checked = within_error(real, spark.createDataFrame(list(found.values()), marks.schema), ["g"], WANTED, rank_error())
    assert all(row.median and row.p90 and row.low for row in checked.collect()) and checked.count() == 9
    # The check is one that fails: the median is no mark of the 90th percentile.
    wrong = spark.createDataFrame(list(found.values()), marks.schema).withColumn("p90", F.col("median"))
    assert not within_error(real, wrong, ["g"], WANTED, rank_error()).where("g = 'hot'").first().p90


def test_a_new_period_adds_its_sketches(spark):
    rng = random.Random(1)
    data = [("a", at % 4, rng.random()) for at in range(4000)]
    old = sketch_by_period(spark.createDataFrame(data[:3000], "g string, month int, x double"), ["g"], F.col("month"), ["x"])
    new = sketch_by_period(spark.createDataFrame(data[3000:], "g string, month int, x double"), ["g"], F.col("month"), ["x"])
    mark = merged_quantiles(old.unionAll(new), ["g"], {"median": ("x", 0.5)}).first()
    values = sorted(x for *_, x in data)
    assert mark.n_x == 4000
    assert abs(sum(x < mark.median for x in values) / 4000 - 0.5) <= rank_error()
    assert rank_error(800) < rank_error(400) < 0.02


def test_no_rows(spark):
    empty = spark.createDataFrame([], "g string, month int, x double")
    sketches = sketch_by_period(empty, ["g"], F.col("month"), ["x"])
    assert merged_quantiles(sketches, ["g"], {"median": ("x", 0.5)}).collect() == []
