"""Human reports against revisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.pairing import percent

MINIMUM_REPORTS = 5
SIGNIFICANT_SHIFT = 0.2
MINIMUM_COMPARABLE = 10


def join_reports(revisions: DataFrame, reports: DataFrame,
                 identifier: str = "usgs_id") -> DataFrame:
    """Revisions whose event is in the catalogue, with the catalogue's report columns.

    Both sides hold about one row per event; AQE splits a partition that is larger.
    """
    return revisions.join(reports.withColumnRenamed(identifier, "event_id"), "event_id")


def witness_columns(joined: DataFrame) -> DataFrame:
    gap = F.round(F.col("community_intensity") - F.col("instrumental_intensity"), 2)
    return joined.withColumns({
        "has_witness": F.col("felt_reports") >= MINIMUM_REPORTS,
        "intensity_gap": gap, "witness_louder": gap > 0,
        "moved_up": F.col("shift") >= SIGNIFICANT_SHIFT,
        "moved_down": F.col("shift") <= -SIGNIFICANT_SHIFT})


def witness_report(witness: DataFrame) -> DataFrame:
    """By presence of a witness; unknown presence is a group of its own."""
    return witness.groupBy("has_witness").agg(
        F.count(F.lit(1)).alias("seismes"), percent("moved_up").alias("pct_hausse"),
        percent("moved_down").alias("pct_baisse"),
        F.round(F.avg("shift_abs"), 3).alias("ecart_absolu_moyen")).orderBy("has_witness")


def louder_report(witness: DataFrame, minimum: int = MINIMUM_COMPARABLE) -> DataFrame:
    """By felt above measured intensity; empty below ``minimum`` comparable rows.

    The guard reads the total from the report itself, so the rows are aggregated once.
    """
    comparable = witness.filter("has_witness AND intensity_gap IS NOT NULL")
    report = comparable.groupBy("witness_louder").agg(
        F.count(F.lit(1)).alias("seismes"), percent("moved_up").alias("pct_hausse"),
        F.round(F.avg("shift"), 3).alias("ecart_moyen"),
        F.round(F.avg("intensity_gap"), 2).alias("ecart_intensite_moyen"))
    # At most three rows: true, false, null.
    entries = report.agg(F.collect_list(F.struct(*report.columns)).alias("rows"),
                         F.sum("seismes").alias("total"))
    return (entries.filter(F.col("total") >= minimum)
            .select(F.explode("rows").alias("r")).select("r.*").orderBy("witness_louder"))
