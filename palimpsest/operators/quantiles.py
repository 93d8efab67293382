"""Grouped quantiles: approximate by a bounded sketch, or exact by counting values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.ordered import order_rows
from palimpsest.operators.skew import ROWS_PER_TASK
from palimpsest.scratch import materialise

ACCURACY = 10_000


def approximate(value: Column, share: float, accuracy: int = ACCURACY) -> Column:
    return F.percentile_approx(value, share, accuracy)


def exact_quantiles(frame: DataFrame, groups: Sequence[str], value: str,
                    shares: Mapping[str, float],
                    rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Smallest value whose cumulative share reaches each given share, one row per group.

    Values are counted before anything is ordered, so equal values travel once and the input is
    read once; no group is gathered in one task, as a percentile aggregate would do.
    """
    counts = materialise(frame.filter(F.col(value).isNotNull())
              .groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n")), "counts")
    ranked = order_rows(counts, groups, [F.col(value)], running={"_upto": "_n"},
                        total={"_total": "_n"}, rows_per_task=rows_per_task)
    return ranked.groupBy(*groups).agg(*[
        F.min(F.when(F.col("_upto") >= F.lit(Decimal(str(share))) * F.col("_total"),
                     F.col(value))).alias(name)
        for name, share in shares.items()])


def exact_quantiles_of(frame: DataFrame, groups: Sequence[str],
                       wanted: Mapping[str, tuple[str, float]],
                       rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Quantiles of several columns in one pass: alias -> (column, share), as doubles."""
    sources = sorted({source for source, _ in wanted.values()})
    shares = {f"_q{at}": share for at, share in
              enumerate(sorted({share for _, share in wanted.values()}))}
    named = {share: name for name, share in shares.items()}
    entries = F.array(*[F.struct(F.lit(source).alias("_measure"),
                                 F.col(source).cast("double").alias("_value"))
                        for source in sources])
    stacked = frame.select(*groups, F.explode(entries).alias("_e")).select(*groups, "_e.*")
    marks = exact_quantiles(stacked, [*groups, "_measure"], "_value", shares, rows_per_task)
    return marks.groupBy(*groups).agg(*[
        F.max(F.when(F.col("_measure") == source, F.col(named[share]))).alias(name)
        for name, (source, share) in wanted.items()])
