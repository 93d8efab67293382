"""Hot keys: finding them in a sample, and joining around them.

A key may own a third of all rows. Everything here stays exact: the sample only chooses between
two ways that give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this does not go through one task as a whole.
ROWS_PER_TASK = 1_000_000
# The hot keys kept are the largest ones, at most this many whatever the size of the input: the
# bound of the driver's list and of every broadcast built on it. A key beyond the list has fewer
# than a MAX_HOT-th of all rows.
MAX_HOT = 10_000
# Sampled rows expected of a key of ROWS_PER_TASK rows, and how many of them make it hot: at
# 1000 expected, fewer than 800 have a chance below 1e-9.
EXPECTED_HITS, HOT_HITS = 1000, 800
SEED = 1


@dataclass(frozen=True)
class HotKeys:
    keys: tuple[str, ...]
    hashes: tuple[int, ...]
    rows: int

    def __bool__(self) -> bool:
        return bool(self.hashes)

    @property
    def condition(self) -> Column:
        """True on rows of a hot key. A hash collision sends a cold key the hot way, no harm."""
        return F.xxhash64(*self.keys).isin(list(self.hashes))


def find_hot_keys(frame: DataFrame, keys: Sequence[str],
                  rows_per_task: int = ROWS_PER_TASK) -> HotKeys:
    """One pass over the key columns; only counts of sampled keys are shuffled.

    The share sampled depends on ``rows_per_task`` alone; small limits count every row.
    """
    share = min(1.0, EXPECTED_HITS / rows_per_task)
    least = HOT_HITS if share < 1.0 else rows_per_task + 1
    hashes = frame.select(F.xxhash64(*keys).alias("key_hash"))
    sampled = hashes.sample(share, SEED) if share < 1.0 else hashes
    top = (sampled.groupBy("key_hash").agg(F.count(F.lit(1)).alias("hits"))
           .filter(F.col("hits") >= least)
           .orderBy(F.desc("hits"), "key_hash").limit(MAX_HOT).collect())
    return HotKeys(tuple(keys), tuple(row["key_hash"] for row in top),
                   int(sum(row["hits"] for row in top) / share))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on every key."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def lookup(rows: DataFrame, facts: DataFrame, keys: Sequence[str], how: str = "left",
           rows_per_task: int = ROWS_PER_TASK, at_most: int | None = None) -> DataFrame:
    """Join ``rows`` (any number per key) to ``facts`` (one row per key).

    Rows of hot keys are not shuffled: the facts of those keys, MAX_HOT rows at most but for
    hash collisions, are broadcast to them. With ``at_most`` rows known to be few enough for
    one task no key can be hot, and none is looked for.
    """
    few = at_most is not None and at_most <= rows_per_task
    hot = None if few else find_hot_keys(rows, keys, rows_per_task)
    if not hot:
        return rows.join(facts, list(keys), how)
    cold_part = rows.filter(~hot.condition).join(facts.filter(~hot.condition), list(keys), how)
    hot_part = rows.filter(hot.condition).join(
        F.broadcast(facts.filter(hot.condition)), list(keys), how)
    return cold_part.unionByName(hot_part)
