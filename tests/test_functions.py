import math

from pyspark.sql import functions as F

from palimpsest.functions.content import fingerprint
from palimpsest.functions.geometry import bar_height, sphere_point
from palimpsest.functions.identifiers import canonical_key, split_aliases
from palimpsest.functions.scales import (display_ceiling, family_of, is_saturated,
                                         saturation_of)


def test_scale_rules(spark):
    frame = spark.createDataFrame(
        [("mww",), ("MW",), (" mb_lg ",), ("ms_vx",), ("mlr",), ("Md",), ("mh",), ("?",), (None,)],
        "t string")
    t = F.col("t")
    got = frame.select("t", family_of(t), saturation_of(t), display_ceiling(t)).collect()
    assert [tuple(row) for row in got] == [
        ("mww", "moment", 10.0, None), ("MW", "moment", 10.0, None),
        (" mb_lg ", "body_wave", 6.5, 6.5), ("ms_vx", "surface_wave", 8.0, 8.0),
        ("mlr", "local", 6.5, 6.5), ("Md", "duration", 5.0, 5.0), ("mh", "duration", 5.0, 5.0),
        ("?", "inconnue", 5.0, None), (None, "inconnue", 5.0, None)]


def test_null_magnitude_is_not_saturated_nor_unsaturated(spark):
    frame = spark.createDataFrame([(None, "mb"), (6.5, "mb"), (6.4, "mb")], "m double, t string")
    got = frame.select(is_saturated(F.col("m"), F.col("t"))).collect()
    assert [row[0] for row in got] == [None, True, False]


def test_aliases_and_key(spark):
    frame = spark.createDataFrame(
        [(",b,a,b,", "z"), (",,", "z"), (None, "z"), ("", None)], "ids string, id string")
    aliases = split_aliases(F.col("ids"))
    got = frame.select(aliases, canonical_key(aliases, F.col("id"))).collect()
    assert [tuple(row) for row in got] == [(["a", "b"], "a"), ([], "z"), ([], "z"), ([], None)]


def test_fingerprint_ignores_time_and_sees_identifier(spark):
    names = ("magnitude", "usgs_id")
    frame = spark.createDataFrame([(1.0, "a", 1), (1.0, "a", 2), (1.0, "b", 1), (None, "a", 1)],
                                  "magnitude double, usgs_id string, updated_time int")
    marks = [row[0] for row in frame.select(fingerprint(names)).collect()]
    assert marks[0] == marks[1] and len(set(marks)) == 3


def test_points_lie_on_the_sphere(spark):
    frame = spark.createDataFrame([(10.0, 20.0), (-80.0, 179.0)], "lat double, lon double")
    point = sphere_point(F.col("lat"), F.col("lon"), F.lit(2.0))
    for x, y, z in frame.select(*point.values()).collect():
        assert math.isclose(math.sqrt(x * x + y * y + z * z), 2.0)
    heights = spark.createDataFrame([(None,), (-9.0,)], "s double").select(bar_height(F.col("s")))
    assert [round(row[0], 6) for row in heights.collect()] == [0.04, 0.584]


def test_a_scale_is_put_in_lower_case_once(spark):
    frame = spark.range(3).select(F.col("id").cast("string").alias("t"))
    plan = frame.select(family_of(F.col("t")).alias("family"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1
