"""Quantiles from sketches that are kept by period and merged.

A KLL sketch of each group and period is made in one read of the data and stored; a report over any
span of periods merges stored sketches and reads no data. A new period adds its own sketches. The
sketch of a group is combined on the map side, so a group that owns a third of all rows sends one
sketch a task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 400
# The rank error of a KLL sketch of size k, at 99 per cent, is FACTOR / k ** POWER.
FACTOR, POWER = 2.296, 0.9723
COUNTED = "n_{}"


def rank_error(k: int = K) -> float:
    """By how much of all rows a quantile may be off, about five standard deviations."""
    return 2 * FACTOR / k ** POWER


def sketch_by_period(frame: DataFrame, groups: Sequence[str], period: Column, values: Sequence[str],
                     k: int = K) -> DataFrame:
    """A row a group and period, with a sketch of each value; nulls and NaN are in none."""
    def kept(value: str) -> Column:
        number = F.col(value).cast("double")
        return F.when(~F.isnan(number), number)

    return frame.groupBy(*groups, period.alias("period")).agg(
        *[F.kll_sketch_agg_double(kept(value), k).alias(value) for value in values])


def merged_quantiles(sketches: DataFrame, groups: Sequence[str], wanted: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Per group, the number of values of each kind and the quantiles: alias -> (value, share). A
    group without any value has none."""
    values = sorted({value for value, _ in wanted.values()})
    merged = sketches.groupBy(*groups).agg(*[F.kll_merge_agg_double(value).alias(value) for value in values])
    counts = {value: F.coalesce(F.kll_sketch_get_n_double(value), F.lit(0)) for value in values}
    return merged.select(
        *groups, *[counts[value].alias(COUNTED.format(value)) for value in values],
        *[F.when(counts[value] > 0, F.kll_sketch_get_quantile_double(F.col(value), F.lit(share))).alias(name)
          for name, (value, share) in wanted.items()])


def within_error(frame: DataFrame, marks: DataFrame, groups: Sequence[str],
                 wanted: Mapping[str, tuple[str, float]], error: float) -> DataFrame:
    """Whether each mark is within ``error`` of its share in rank: one pass over the data against
    the marks, one row a group, which are report sized."""
    marked = marks.select(*[F.col(name).alias(f"_{name}") for name in groups], *wanted)
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in groups])
    counts = []
    for name, (value, _) in wanted.items():
        counts += [F.count_if(F.col(value) < F.col(name)).alias(f"_below_{name}"),
                   F.count_if(F.col(value) <= F.col(name)).alias(f"_upto_{name}"),
                   F.count(value).alias(f"_all_{name}")]
    ranked = frame.join(F.broadcast(marked), same).groupBy(*groups).agg(*counts)
    return ranked.select(*groups, *[
        ((F.col(f"_below_{name}") <= F.lit(share + error) * F.col(f"_all_{name}"))
         & (F.col(f"_upto_{name}") >= F.lit(share - error) * F.col(f"_all_{name}"))).alias(name)
        for name, (_, share) in wanted.items()])
