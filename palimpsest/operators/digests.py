"""Comparison of two stored states that reads only what differs.

A state is written in folders by key bucket, with a digest of each bucket that does not depend on
the order of rows. Digests of buckets make those of nodes above them, so two states that are alike
are told so by one row, and what differs is found from there. Only buckets with unequal digests are
read and joined. Two digests of 64 bits and a count must all agree for a bucket to pass as equal.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from palimpsest.operators.snapshot_diff import COMPARED, CONTEXT, compare_snapshots

BUCKET, NODE = "bucket", "node"
ROWS_PER_BUCKET = 250_000
LEAST_BUCKETS, MOST_BUCKETS = 16, 4096
FAN_OUT = 64


def bucket_number(rows: int) -> int:
    """A power of two, so that states of one table can share it while they grow."""
    wanted = max(LEAST_BUCKETS, -(-rows // ROWS_PER_BUCKET))
    return min(MOST_BUCKETS, 1 << (wanted - 1).bit_length())


def _combined(one: Column, other: Column) -> tuple[Column, ...]:
    return (F.count(F.lit(1)).alias("n"), F.sum(one.cast("decimal(38,0)")).alias("total"), F.bit_xor(other).alias("mixed"))


def digest_rows(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row a bucket. Nulls differ from every value, and a value from the same in the next column."""
    parts = [item for name in columns for item in (F.col(name).isNull(), F.col(name))]
    return frame.groupBy(BUCKET).agg(*_combined(F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)))


def digest_nodes(digests: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """One row for each ``fan_out`` buckets, from their digests alone."""
    mark = F.xxhash64(BUCKET, "n", "total", "mixed")
    return digests.withColumn(NODE, F.floor(F.col(BUCKET) / fan_out)).groupBy(NODE).agg(
        *_combined(mark, F.xxhash64(F.lit(1), mark)))


@dataclass(frozen=True)
class StoredState:
    """Where a state lies, in how many buckets, and its columns."""

    spark: SparkSession
    path: str
    buckets: int
    schema: StructType

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields]).add(BUCKET, IntegerType())).parquet(f"{self.path}/rows")

    @property
    def digests(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/digests")


def store_state(frame: DataFrame, path: str, key: str, compared: Sequence[str], buckets: int) -> StoredState:
    """Write a state and its digests over the key and the compared columns."""
    state = StoredState(frame.sparkSession, path, buckets, frame.schema)
    numbered = frame.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    numbered.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/rows")
    digest_rows(state.rows, [key, *compared]).coalesce(1).write.parquet(f"{path}/digests")
    return state


def _differing(one: DataFrame, other: DataFrame, by: str) -> list[int]:
    """Numbers whose digests differ; there are at most as many as buckets."""
    same = [F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}")) for name in ("n", "total", "mixed")]
    found = one.alias("a").join(other.alias("b"), F.col(f"a.{by}") == F.col(f"b.{by}"), "full_outer").where(
        ~(same[0] & same[1] & same[2]))
    return sorted(row[0] for row in found.select(F.coalesce(f"a.{by}", f"b.{by}")).collect())


def unequal_buckets(before: StoredState, after: StoredState, fan_out: int = FAN_OUT) -> list[int]:
    """From the nodes down: digests of buckets below equal nodes are not compared."""
    if before.buckets != after.buckets:
        raise ValueError("states to compare have the same number of buckets")
    nodes = _differing(digest_nodes(before.digests, fan_out), digest_nodes(after.digests, fan_out), NODE)
    if not nodes:
        return []
    below = F.floor(F.col(BUCKET) / fan_out).isin(nodes)
    return _differing(before.digests.where(below), after.digests.where(below), BUCKET)


def compare_states(before: StoredState, after: StoredState, key: str = "event_key",
                   compared: Sequence[str] = COMPARED, context: Sequence[str] = CONTEXT) -> DataFrame:
    """What ``compare_snapshots`` gives for the whole states, from the unequal buckets alone."""
    wanted = F.col(BUCKET).isin(unequal_buckets(before, after))
    return compare_snapshots(before.rows.where(wanted).drop(BUCKET), after.rows.where(wanted).drop(BUCKET), key,
                             compared, context)
