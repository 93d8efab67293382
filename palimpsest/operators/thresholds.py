"""Decisions at a threshold: raised on the announced value, deserved on the final one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
ALERT_THRESHOLDS = (3.0, 3.5, 4.0, 4.5, 5.0, 5.5, 6.0, 6.5, 7.0)
CURVE_THRESHOLDS = tuple(round(3.0 + 0.1 * step, 1) for step in range(41))


def _reached(value: Column, thresholds: Sequence[float]) -> Column:
    """How many of the ascending thresholds the value reaches; null for null."""
    return reduce(add, [(value >= F.lit(float(t))).cast("int") for t in thresholds])


def decision_counts(pairs: DataFrame, announced: str, confirmed: str,
                    thresholds: Sequence[float]) -> DataFrame:
    """Two-by-two counts at each threshold.

    Pairs are first counted by the thresholds both values reach. With T thresholds that
    leaves at most (T + 2)^2 cells, combined on the map side; only cells are spread over
    thresholds, never pairs. A pair with a null value is evaluated and counts nowhere else.
    """
    grid = sorted({float(t) for t in thresholds})
    cells = (pairs.select(_reached(F.col(announced), grid).alias("a"),
                          _reached(F.col(confirmed), grid).alias("c"))
             .groupBy("a", "c").agg(F.count(F.lit(1)).alias("n")))
    steps = F.array(*[F.lit(t) for t in grid])
    spread = cells.select("a", "c", "n", F.posexplode(steps).alias("step", "threshold"))
    raised, deserved = F.col("a") > F.col("step"), F.col("c") > F.col("step")

    def counted(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    return spread.groupBy("threshold").agg(
        F.sum("n").alias("evaluated"),
        counted(raised & deserved).alias("justified"),
        counted(raised & ~deserved).alias("false"),
        counted(~raised & deserved).alias("missed"),
        counted(~raised & ~deserved).alias("silent"))


def rate(part: Column, whole: Column, digits: int, scale: float = 1.0) -> Column:
    """Null where nothing can be rated."""
    return F.round(F.try_divide(F.lit(scale) * part, whole), digits)


def alert_reliability(revisions: DataFrame, announced: str = "first_magnitude",
                      confirmed: str = "final_magnitude",
                      thresholds: Sequence[float] = ALERT_THRESHOLDS) -> DataFrame:
    """Ratios; the miss rate is over all evaluated pairs. Pairs with a null are left out."""
    known = revisions.filter(F.col(announced).isNotNull() & F.col(confirmed).isNotNull())
    counts = decision_counts(known, announced, confirmed, thresholds)
    raised = F.col("justified") + F.col("false")
    return counts.select(
        "threshold", F.col("evaluated").alias("events_evaluated"),
        raised.alias("alerts_raised"), F.col("justified").alias("alerts_confirmed"),
        F.col("false").alias("false_alerts"), F.col("missed").alias("missed_events"),
        rate(F.col("false"), raised, 4).alias("false_alert_rate"),
        rate(F.col("missed"), F.col("evaluated"), 4).alias("miss_rate")).orderBy("threshold")


def alert_curve(dataset: DataFrame, announced: str = "first_magnitude",
                confirmed: str = "final_magnitude",
                thresholds: Sequence[float] = CURVE_THRESHOLDS) -> DataFrame:
    """Percentages; the miss rate is over the pairs that deserved an alert."""
    counts = decision_counts(dataset, announced, confirmed, thresholds)
    raised, deserved = (F.col("justified") + F.col("false"),
                        F.col("justified") + F.col("missed"))
    return counts.select(
        "threshold", F.col("evaluated").alias("seismes"),
        F.col("justified").alias("alerte_justifiee"), F.col("false").alias("fausse_alerte"),
        F.col("missed").alias("alerte_manquee"), F.col("silent").alias("silence_justifie"),
        raised.alias("alertes_emises"),
        rate(F.col("false"), raised, 2, 100.0).alias("taux_fausse_alerte_pct"),
        deserved.alias("meritaient_alerte"),
        rate(F.col("missed"), deserved, 2, 100.0).alias("taux_manque_pct")).orderBy("threshold")


def crossing(curve: DataFrame) -> DataFrame:
    """Threshold at which both rates are closest; the lowest of equals."""
    gap = F.abs(F.col("taux_fausse_alerte_pct") - F.col("taux_manque_pct"))
    best = F.struct(F.round(gap, 2).alias("ecart"), "threshold", "taux_fausse_alerte_pct",
                    "taux_manque_pct")
    return (curve.filter(gap.isNotNull()).agg(F.min(best).alias("best"))
            .filter("best IS NOT NULL").select("best.*"))
