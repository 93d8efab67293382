import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm.multi_index import _blocks, nearest_neighbours, visit


def frame(spark, rows):
    def floats(vector):
        return vector and [x if x is None else float(x) for x in vector]
    return spark.createDataFrame([(key, floats(vector), 1, 0.5) for key, vector in rows],
                                 "vec_id long, embedding array<float>, rank int, score double").repartition(4)


def brute(rows, asks, nearest):
    best = {}
    vectors = {}
    for key, vector in rows:
        if key is None or vector is None or len(vector) != 8 or any(x is None or not np.isfinite(x) for x in vector):
            continue
        if any(vector):
            vectors.setdefault(key, []).append(np.array(vector, np.float32).astype(np.float64))
    for query in filter(asks, vectors):
        found = sorted((-max(float(v @ q) for v in vectors[key] for q in vectors[query]), key)
                       for key in vectors if key != query)
        best[query] = [(key, -score) for score, key in found[:nearest]]
    return best


def sample(count=600, hot=200):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    rows = [(at, (centres[at % 12] + rng.normal(size=8) * .2).tolist()) for at in range(count)]
    rows += [(1000 + at, [1.0, 2, 0, 0, 0, 1, 0, 0]) for at in range(hot)]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [None] + [1.0] * 7), (2060, [float("nan")] + [1.0] * 7),
             (2080, [float("inf")] + [1.0] * 7), (2100, [1.0, 2]), (None, [1.0] * 8), (20, rows[20][1]), (7, rows[7][1])]
    return rows


@pytest.mark.parametrize("block", [4096, 64])
def test_recall_scores_and_ranks(spark, block):
    rows = sample()
    truth = brute(rows, lambda key: key % 20 == 0, 10)
    got = {}
    result = nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0, 10, centroids=16, block_rows=block)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    for row in result.collect():
        got.setdefault(row.query_id, {})[row.rank] = (row.vec_id, row.score)
    assert set(got) == set(truth)
    hits = 0
    for query, found in got.items():
        assert sorted(found) == list(range(1, 11))
        ordered = [found[rank] for rank in sorted(found)]
        assert ordered == sorted(ordered, key=lambda x: (-x[1], x[0])) and len({x[0] for x in ordered}) == 10
        hits += len({x[0] for x in ordered} & {x[0] for x in truth[query]})
    assert hits >= 0.9 * 10 * len(truth)


@pytest.mark.parametrize("block", [4096, 64])
def test_rows_that_repeat_an_id_cost_no_neighbour(spark, block):
    rng = np.random.default_rng(8)
    rows = [(at, rng.normal(size=8).tolist()) for at in range(100)]
    often = [(1001, [9 * x for x in rows[0][1]])] * 200
    got = {}
    for row in nearest_neighbours(frame(spark, rows * 2 + often), F.col("vec_id") % 20 == 0, 20, centroids=4,
                                  block_rows=block).collect():
        got.setdefault(row.query_id, []).append((row.rank, row.vec_id))
    assert set(got) == {0, 20, 40, 60, 80}
    for found in got.values():
        assert sorted(rank for rank, _ in found) == list(range(1, 21)) and len({key for _, key in found}) == 20


def test_all_candidates_when_there_are_few(spark):
    rows = [(0, [1.0, 0, 0, 0, 0, 0, 0, 0]), (1, [1.0] * 8), (2, [-1.0] * 8)]
    got = nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, -1.0)]


def test_nothing_to_search(spark):
    every = F.col("vec_id") % 20 == 0
    assert nearest_neighbours(frame(spark, []), every).collect() == []
    assert nearest_neighbours(frame(spark, [(0, None), (1, [0.0])]), every).collect() == []
    assert nearest_neighbours(frame(spark, [(0, [1.0, 2.0])]), every).collect() == []


def test_cells_come_by_falling_sum():
    rng = np.random.default_rng(5)
    a, b, counts = rng.normal(size=6), rng.normal(size=6), rng.integers(0, 4, 36)
    sums = (a[:, None] + b[None, :]).ravel()
    expected = [cell for cell in np.argsort(-sums) if counts[cell]]
    assert visit((a, b), counts, int(counts.sum())) == expected
    some = visit((a, b), counts, 9)
    assert some == expected[:len(some)] and counts[some].sum() >= 9 > counts[some[:-1]].sum()


def test_blocks_are_bounded():
    counts = np.array([0, 3, 5, 0, 40, 1, 9, 10, 2])
    first, parts = _blocks(counts, 10)
    assert parts.tolist() == [1, 1, 1, 1, 4, 1, 1, 1, 1]
    held = {}
    for cell, count in enumerate(counts):
        for part in range(parts[cell]):
            held[first[cell] + part] = held.get(first[cell] + part, 0) + count / parts[cell]
    assert max(held.values()) <= 10 and (np.diff(first) >= 0).all()
