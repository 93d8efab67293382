"""What changed between two states of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values.
COMPARED = ("magnitude", "magnitude_type", "review_status", "usgs_id")
CONTEXT = ("place", "event_time")


def compare_snapshots(before: DataFrame, after: DataFrame, key: str = "event_key",
                      compared: Sequence[str] = COMPARED, context: Sequence[str] = CONTEXT,
                      keep_unchanged: bool = False) -> DataFrame:
    """One row per key that appeared, vanished or changed; both sides hold a key once.

    Presence is a flag of its own, so null values on a side do not read as absence.
    """
    left = before.select(key, *[F.col(name).alias(f"avant_{name}") for name in compared],
                         F.lit(True).alias("_before"))
    right = after.select(key, *context,
                         *[F.col(name).alias(f"apres_{name}") for name in compared],
                         F.lit(True).alias("_after"))
    same = reduce(and_, [F.col(f"avant_{name}").eqNullSafe(F.col(f"apres_{name}"))
                         for name in compared])
    status = (F.when(F.col("_before").isNull(), "apparu")
              .when(F.col("_after").isNull(), "disparu")
              .when(same, "inchange").otherwise("modifie"))
    joined = (right.join(left, key, "full_outer")
              .withColumn("statut", status)
              .withColumn("ecart_magnitude", F.round(
                  F.col("apres_magnitude") - F.col("avant_magnitude"), 2))
              .drop("_before", "_after"))
    return joined if keep_unchanged else joined.filter("statut <> 'inchange'")


def diff_summary(difference: DataFrame) -> DataFrame:
    return difference.groupBy("statut").agg(F.count(F.lit(1)).alias("count"))


def largest_gaps(difference: DataFrame, key: str = "event_key", top: int = 10) -> DataFrame:
    gap = F.abs("ecart_magnitude")
    return (difference.filter(gap > 0)
            .select(key, "avant_magnitude", "apres_magnitude", "ecart_magnitude",
                    "avant_usgs_id", "apres_usgs_id")
            .orderBy(F.desc(gap), key).limit(top))
