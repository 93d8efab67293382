import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm.sharding import draw, draw_matrix, shard_sizes, shuffle_into_shards, write_shards


@pytest.mark.parametrize("rows,shards,block", [(1000, 24, 20_000), (1000, 7, 10), (5, 24, 10), (0, 3, 10), (9, 1, 2)])
def test_sizes_and_slots_are_exact(spark, rows, shards, block):
    frame = spark.range(0, rows, 1, 5).select(F.col("id"), F.when(F.col("id") % 3 > 0, 1).alias("hot"), F.lit("x").alias("slot"))
    dealt = shuffle_into_shards(frame, shards, 3, block)
    assert dealt.columns == ["id", "hot", "shard", "slot"]
    got = dealt.collect()
    assert sorted(r.id for r in got) == list(range(rows))
    for shard, size in enumerate(shard_sizes(rows, shards)):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(size))


def test_repeated_and_null_rows_each_get_a_place(spark):
    frame = spark.createDataFrame([(None,)] * 40 + [(7,)] * 60, "key int").repartition(3)
    got = shuffle_into_shards(frame, 8).collect()
    assert len({(r.shard, r.slot) for r in got}) == 100 and sum(r.key is None for r in got) == 40


def test_the_shuffle_is_uniform(spark):
    frame = spark.range(0, 6000, 1, 6)
    one = {r.id: (r.shard, r.slot) for r in shuffle_into_shards(frame, 6, 1).collect()}
    two = {r.id: (r.shard, r.slot) for r in shuffle_into_shards(frame, 6, 2).collect()}
    assert one == {r.id: (r.shard, r.slot) for r in shuffle_into_shards(frame, 6, 1).collect()}
    assert sum(one[x] == two[x] for x in one) < 10
    met = np.zeros((6, 6))
    for row, (shard, slot) in one.items():
        met[row // 1000, shard] += 1
    assert ((met - 1000 / 6) ** 2 / (1000 / 6)).sum() < 60  # chi squared, 25 degrees
    order = np.corrcoef([[x, slot] for x, (_, slot) in one.items()], rowvar=False)[0, 1]
    assert abs(order) < 0.06


def test_draws_are_hypergeometric():
    for good, bad, size in ((7, 5, 6), (40, 300, 90), (3, 0, 2), (0, 9, 4)):
        rng = np.random.default_rng(8)
        ours = np.bincount([draw(good, bad, size, rng) for _ in range(6000)], minlength=size + 1)
        theirs = np.bincount(np.random.default_rng(9).hypergeometric(good, bad, size, 60_000), minlength=size + 1) / 10
        assert (np.abs(ours - theirs) < 6 * np.sqrt(theirs) + 8).all()
    large = [draw(10**12, 3 * 10**12, 10**9, np.random.default_rng(at)) for at in range(30)]
    assert abs(np.mean(large) / 10**9 - 0.25) < 1e-4 and np.std(large) > 1000


def test_matrix_fills_every_shard():
    sizes, room = [5, 0, 90, 13], shard_sizes(108, 10)
    matrix = np.array(draw_matrix(sizes, room, np.random.default_rng(1)))
    assert matrix.sum(axis=1).tolist() == sizes and matrix.sum(axis=0).tolist() == room and (matrix >= 0).all()


def test_files(spark, tmp_path):
    write_shards(spark.range(500), str(tmp_path / "out"), 4, block_rows=50)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 500 and back.select("shard").distinct().count() == 4
    with pytest.raises(ValueError):
        shuffle_into_shards(spark.range(3), 0)
