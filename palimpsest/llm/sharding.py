"""Uniform shuffle of rows into shards of exact sizes through a communication matrix.

How many rows each partition sends to each shard follows the multivariate hypergeometric law that
a uniform permutation has. The matrix is drawn in two levels: the driver draws it for ``GROUPS``
groups of partitions, and each group divides its line among its partitions in a task, so neither
holds a line for every partition. Rows are then permuted inside their partition, cut by its line,
exchanged, and permuted again inside their shard, block by block.

The rows get a place (partition, number) that is written before anything is drawn, so a lost
executor repeats the same draws. Defined cases: rows need no key, so nulls, repeated rows and hot
keys make no difference; an empty table gives an empty result; with fewer rows than shards, the
first shards get one each. All columns are kept; a column named shard or slot is replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palimpsest.llm.registry import query, table
from palimpsest.scratch import materialise

GROUPS = 256
BLOCK_ROWS = 20_000


def draw(good: int, bad: int, size: int, rng: np.random.Generator) -> int:
    """How many of ``size`` rows taken from good + bad are good. By inversion from the mode, with
    ratios of neighbouring probabilities, so there is no limit on the numbers."""
    low, high = max(0, size - bad), min(size, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((size + 1) * (good + 1) // (total + 2), low), high)
    spread = (size * (good / total) * (bad / total) * ((total - size) / max(total - 1, 1))) ** 0.5
    reach = int(12 * spread) + 30
    up = np.arange(mode, min(high, mode + reach), dtype=np.float64)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=np.float64)
    above = np.cumprod((good - up) * (size - up) / ((up + 1) * (bad - size + up + 1)))
    below = np.cumprod(down * (bad - size + down) / ((good - down + 1) * (size - down + 1)))
    weights = np.concatenate([below[::-1], [1.0], above])
    sums = np.cumsum(weights)
    return mode - len(below) + int(np.searchsorted(sums, rng.random() * sums[-1], "right").clip(0, len(sums) - 1))


def draw_line(capacities: list[int], size: int, rng: np.random.Generator) -> list[int]:
    """How many of ``size`` rows go to each shard, given the room left in the shards."""
    left, out = sum(capacities), []
    for room in capacities:
        taken = draw(room, left - room, size, rng) if size else 0
        out.append(taken)
        left, size = left - room, size - taken
    return out


def draw_matrix(sizes: list[int], capacities: list[int], rng: np.random.Generator) -> list[list[int]]:
    room, lines = list(capacities), []
    for size in sizes:
        line = draw_line(room, size, rng)
        room = [a - b for a, b in zip(room, line)]
        lines.append(line)
    return lines


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (at < rows % shards) for at in range(shards)]


def shuffle_into_shards(frame: DataFrame, shards: int, seed: int = 1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add shard (0 to shards - 1, sizes at most one apart) and slot (0, 1, ... inside the shard)."""
    if shards < 1:
        raise ValueError("at least one shard")
    spark: SparkSession = frame.sparkSession
    names = [name for name in frame.columns if name not in ("shard", "slot")]
    placed = materialise(frame.select(*names).withColumns({
        "__part": F.spark_partition_id(),
        "__row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "placed")
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size")).withColumn(
        "__group", F.pmod("__part", F.lit(GROUPS)))
    groups = sizes.groupBy("__group").agg(F.sum("__size").alias("size")).orderBy("__group").collect()
    rows = sum(row["size"] for row in groups)
    lines = draw_matrix([row["size"] for row in groups], shard_sizes(rows, shards),
                        np.random.default_rng([seed, shards]))
    matrix = spark.createDataFrame([(row["__group"], line) for row, line in zip(groups, lines)],
                                   "__group int, line array<long>")

    def divide(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("__part")
        rng = np.random.default_rng([seed, shards, int(part["__group"].iloc[0]) + 1])
        cuts = draw_matrix(part["__size"].tolist(), [int(x) for x in part["line"].iloc[0]], rng)
        return pd.DataFrame({"__part": part["__part"], "cuts": [np.cumsum(cut).tolist() for cut in cuts]})

    cuts = sizes.join(F.broadcast(matrix), "__group").groupBy("__group").applyInPandas(
        divide, "__part int, cuts array<long>")

    def lottery(salt: int):
        return F.xxhash64(F.lit(seed), F.lit(salt), "__part", "__row")

    rank = F.row_number().over(Window.partitionBy("__part").orderBy(lottery(1), "__row")) - 1
    blocks = max(1, -(-rows // (shards * block_rows)))
    ticket = lottery(2)
    block = F.shiftright(F.shiftrightunsigned(ticket, 33) * F.lit(blocks), 31)
    sent = materialise(
        placed.select("__part", "__row").withColumn("__rank", rank).join(cuts, "__part").select(
            "__part", "__row", F.size(F.filter("cuts", lambda x: x <= F.col("__rank"))).alias("shard"),
            ticket.alias("__ticket"), block.alias("__block")), "sent")
    in_order = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    begins = sent.groupBy("shard", "__block").agg(F.count(F.lit(1)).alias("__size")).withColumn(
        "__begin", F.coalesce(F.sum("__size").over(in_order), F.lit(0))).drop("__size")
    place = F.row_number().over(Window.partitionBy("shard", "__block").orderBy("__ticket", "__part", "__row"))
    slots = sent.withColumn("__place", place).join(begins, ["shard", "__block"]).select(
        "__part", "__row", "shard", (F.col("__begin") + F.col("__place") - 1).alias("slot"))
    return placed.join(slots, ["__part", "__row"]).select(*names, "shard", "slot")


def write_shards(frame: DataFrame, path: str, shards: int, seed: int = 1, block_rows: int = BLOCK_ROWS) -> None:
    """Parquet files below ``path``/shard=N, each a stretch of slots in order."""
    dealt = shuffle_into_shards(frame, shards, seed, block_rows)
    stretch = F.floor(F.col("slot") / block_rows)
    dealt.withColumn("__stretch", stretch).repartition("shard", "__stretch").sortWithinPartitions(
        "shard", "slot").drop("__stretch").write.partitionBy("shard").parquet(path)


@query("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    return shuffle_into_shards(rows, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
