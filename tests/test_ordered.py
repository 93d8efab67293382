import random

import pytest
from row_text import rows
from pyspark.sql import functions as F

from palimpsest.operators.ordered import order_rows
from palimpsest.operators.quantiles import exact_quantiles
from palimpsest.operators.skew import find_hot_keys, lookup

WANTED = dict(rank="n", count="total_rows", lag={"before": "v"}, lead={"after": "v"},
              running={"upto": "v"}, total={"whole": "v"})


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belongs to one key; some keys and values are null."""
    rng = random.Random(7)
    data = []
    for at in range(3000):
        key = "hot" if at % 3 == 0 else rng.choice([None, *"abcdefgh"])
        data.append((key, rng.randrange(40), at, rng.choice([None, 1, 2, 3])))
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, t int, i int, v bigint").repartition(5)


def test_hot_keys_are_found_and_bounded(spark, skewed):
    hot = find_hot_keys(skewed, ["k"], 900)
    assert len(hot.hashes) == 1 and hot.rows >= 1000
    assert {row.k for row in skewed.filter(hot.condition).select("k").distinct().collect()} == {
        "hot"}
    assert not find_hot_keys(skewed, ["k"], 5000)


def test_large_limits_sample(spark):
    frame = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    hot = find_hot_keys(frame, ["k"], 2000)
    assert len(hot.hashes) == 1 and 9000 < hot.rows < 11_000
    ranked = order_rows(frame, ["k"], [F.col("id")], rank="n", rows_per_task=2000)
    assert ranked.filter("k = -1").agg(F.max("n"), F.count_distinct("n")).first() == (
        10_000, 10_000)


def test_ranges_give_the_same_as_windows(spark, skewed):
    order = [F.col("t"), F.col("i")]
    plain = order_rows(skewed, ["k"], order, **WANTED, rows_per_task=10_000)
    for limit in (50, 400, 900):
        assert rows(order_rows(skewed, ["k"], order, **WANTED, rows_per_task=limit)) == rows(plain)


def test_one_key_with_one_time_is_still_cut(spark):
    frame = spark.range(2000).select(F.lit("k").alias("k"), F.lit(1).alias("t"), "id")
    ranked = order_rows(frame, ["k"], [F.col("t"), F.col("id")], rank="n", lag={"b": "id"},
                        rows_per_task=100)
    got = sorted((row.n, row.id, row.b) for row in ranked.collect())
    assert got == [(at + 1, at, at - 1 if at else None) for at in range(2000)]


def test_whole_frame_is_numbered_without_one_task(spark):
    frame = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    numbered = order_rows(frame, [], [F.col("x")], rank="n")
    assert sorted((row.x, row.n) for row in numbered.collect()) == [
        (at, at + 1) for at in range(1000)]
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    numbering = [line for line in plan.splitlines() if "row_number()" in line]
    assert numbering and all("_range#" in line for line in numbering)


def test_lookup_around_hot_keys(spark, skewed):
    facts = spark.createDataFrame([("hot", 1), ("a", 2)], "k string, f int")
    plain = skewed.join(facts, ["k"], "left")
    assert rows(lookup(skewed, facts, ["k"], "left", 100)) == rows(plain)
    assert rows(lookup(skewed, facts, ["k"], "inner", 100)) == rows(
        skewed.join(facts, ["k"], "inner"))


def test_only_hot_rows_meet_a_broadcast(spark, skewed):
    facts = spark.createDataFrame([("hot", 1)], "k string, f int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lookup(skewed, facts, ["k"], "left", 900)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") >= 1 and "SortMergeJoin" in plan


@pytest.mark.parametrize("limit", [10_000, 60])
def test_exact_quantiles(spark, skewed, limit):
    shares = {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {row.k: tuple(row[name] for name in shares) for row in
           exact_quantiles(skewed, ["k"], "t", shares, rows_per_task=limit).collect()}
    groups = {}
    for row in skewed.collect():
        groups.setdefault(row.k, []).append(row.t)
    assert got.keys() == groups.keys()
    for key, values in groups.items():
        values.sort()
        expected = []
        for share in (10, 50, 90, 100):
            at = -(-share * len(values) // 100)
            expected.append(values[at - 1])
        assert got[key] == tuple(expected)


def test_quantiles_of_a_whole_frame_and_of_nothing(spark):
    frame = spark.range(1, 11).withColumnRenamed("id", "v")
    assert exact_quantiles(frame, [], "v", {"m": 0.5}).first()["m"] == 5
    assert exact_quantiles(frame.filter("v > 99"), [], "v", {"m": 0.5}).first()["m"] is None


def test_rows_of_a_sort_are_bounded_where_shuffle_partitions_are_few(spark, skewed, monkeypatch):
    from palimpsest.operators import ordered

    def ends():
        return ordered.summarise_keys(skewed, ["k"], ["t", "i"], ["i"], ["i"], {"n": F.count(F.lit(1))})

    expected = rows(ends())
    few = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        monkeypatch.setattr(ordered, "ROWS_PER_SORT", 100, raising=False)
        assert ends().rdd.getNumPartitions() == 30
        assert rows(ends()) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", few)
