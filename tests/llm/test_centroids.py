import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import centroids
from palimpsest.llm.centroids import TooLarge, cluster, displacements, pack_blocks, reassign, squared, usable

SCHEMA = "vec_id long, embedding array<float>, cluster int, distance string"


def lloyd(rows, number=8, rounds=10, seed=3):
    """Every distance of every round, in whole numbers."""
    kept = [(key, [math.floor(float(np.float32(x)) * 1024) for x in vector]) for key, vector in rows
            if vector is not None and len(vector) == 64 and all(x is not None and math.isfinite(x) for x in vector)]
    drawn = sorted((key is None, "" if key is None else hashlib.sha256(f"{seed}:{key}".encode()).hexdigest(), key or 0, vector)
                   for key, vector in kept)
    centres = [vector for *_, vector in drawn[:number]]

    def apart(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min((apart(vector, centre), at) for at, centre in enumerate(centres)) for _, vector in kept]

    for _ in range(rounds):
        groups = {}
        for (_, vector), (_, at) in zip(kept, assign()):
            groups.setdefault(at, []).append(vector)
        for at, vectors in groups.items():
            centres[at] = [sum(column) // len(vectors) for column in zip(*vectors)]
    return [(key, at, distance) for (key, _), (distance, at) in zip(kept, assign())], centres


def result(frame):
    return sorted(((row.vec_id, row.cluster, row.distance) for row in frame.collect()), key=repr)


def made(spark, rows, slices=3):
    return spark.createDataFrame([(key, vector, 5, "x") for key, vector in rows], SCHEMA).repartition(slices)


def test_like_brute_force_with_ties_and_repeats(spark):
    rng = np.random.default_rng(5)
    # Few values, so that many vectors are equally far from two centroids.
    rows = [(at, (rng.integers(0, 2, 64) / 1024 * (rng.integers(0, 9, 64) == 0)).tolist()) for at in range(300)]
    rows += rows[:40] + [(None, rows[3][1]), (None, rows[9][1])]
    report = []
    got, middle = cluster(made(spark, rows), report=report)
    want, centres = lloyd(rows)
    assert result(got) == sorted(want, key=repr)
    assert [row.centroid for row in middle.orderBy("cluster").collect()] == centres
    assert not spark.sql("show tables like 'palimpsest_*'").collect()
    assert report[0] == 8 * len(rows) and len(report) == 11


def test_bounds_spare_evaluations(spark):
    rng = np.random.default_rng(6)
    middles = rng.normal(size=(8, 64))
    rows = [(at, (middles[at % 8] + rng.normal(size=64) * 0.05).tolist()) for at in range(1500)]
    report = []
    got, _ = cluster(made(spark, rows), report=report)
    assert result(got) == sorted(lloyd(rows)[0], key=repr)
    assert sum(report[3:]) < 0.5 * 8 * len(rows) * len(report[3:])


@pytest.mark.parametrize("scale", [1, 3_000_000, 100_000_000])
def test_bounds_round_by_round(scale):
    """Assignments equal full scans also where squares pass what doubles hold exactly."""
    rng = np.random.default_rng(scale)
    vectors = rng.integers(-scale, scale + 1, (400, 64)).astype(np.int32)
    own, distances = np.zeros(400, np.int16), np.zeros((400, 8), np.float32)
    rounds = np.full((400, 8), -1, np.int8)
    history = rng.integers(-scale, scale + 1, (1, 8, 64))
    for step in range(12):
        reassign(vectors, own, distances, rounds, history)
        exact = [[sum((int(x) - int(y)) ** 2 for x, y in zip(vector, centre)) for centre in history[-1]] for vector in vectors]
        assert own.tolist() == [row.index(min(row)) for row in exact]
        assert squared(vectors, history[-1][0]).tolist() == [row[0] for row in exact]
        drift = rng.integers(-scale // 20 - 1, scale // 20 + 2, (8, 64)) // (step + 1)
        history = np.concatenate([history, (history[-1] + drift)[None]])


def test_displacement_is_the_norm_of_the_whole_way():
    history = np.array([[[0, 0]], [[3, 4]], [[0, 0]]])
    assert displacements(history)[:, 0].tolist() == [0.0, 5.0, 0.0]


def test_unusable_vectors_take_no_part(spark):
    ones = [1.0] * 64
    rows = [(1, None), (2, []), (3, ones[:63]), (4, ones + [1.0]), (5, [None] + ones[1:]), (6, [float("nan")] + ones[1:]),
            (7, [float("inf")] + ones[1:]), (8, ones), (9, [-0.0005] * 64), (8, ones)]
    want, _ = lloyd(rows)
    assert result(cluster(made(spark, rows))[0]) == sorted(want, key=repr)
    assert {key for key, *_ in want} == {8, 9}
    assert [frame.collect() for frame in cluster(made(spark, rows[:7]))] == [[], []]
    assert cluster(made(spark, []))[0].columns == ["vec_id", "cluster", "distance"]


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="beyond"):
        cluster(made(spark, [(1, [1e30] * 64)]))
    with pytest.raises(Exception, match="beyond"):
        cluster(made(spark, [(at, [float(at)] * 64) for at in range(20)] + [(0, [2e5] * 64)]), number=2)
    assert issubclass(TooLarge, ValueError)


def test_rounds_move_no_vector(spark):
    """The bounds of a round are joined where the vectors lie."""
    rows = usable(made(spark, [(at, [float(at % 7)] * 64) for at in range(200)]), "vec_id", "embedding", 64, 1024)
    store = centroids.Buckets(spark, 4)
    blocks = store.write(pack_blocks(rows, 64).repartition(4, "block"), "vectors")
    history = np.zeros((1, 3, 64), np.int64)
    first = store.write(centroids.next_bounds(blocks, None, history), "bounds")
    later = centroids.next_bounds(blocks, first.hint("merge"), history)
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    for name in list(store.names):
        store.drop(name)


def test_query_keeps_every_vector(spark, sf):
    from palimpsest.llm.queries import QUERIES
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(row.vec_id, row.embedding) for row in vectors.collect()]
    got = QUERIES["op12_centroid_clustering"](spark, sf)
    want, centres = lloyd(rows)
    assert result(got) == sorted(want, key=repr)
    row = got.where(F.col("cluster") == 0).first()
    assert row.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[0])).encode()).hexdigest()
    assert row.inertia == sum(distance for *_, distance in want)
    assert row.cluster_inertia == sum(distance for _, at, distance in want if at == 0)
