"""Finished tables, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from palimpsest.operators.identity import identity_history
from palimpsest.operators.pairing import pairs_by_join, revision_columns, revision_history
from palimpsest.operators.profiles import magnitude_scales, review_lag
from palimpsest.operators.thresholds import alert_curve, alert_reliability
from palimpsest.operators.timeline import current_versions
from palimpsest.operators.witness import join_reports, witness_columns
from palimpsest.sources.files import write_table

REPORT_COLUMNS = ("usgs_id", "felt_reports", "community_intensity", "instrumental_intensity",
                  "alert_level", "tsunami_flag")
REVISION_COLUMNS = ("event_id", "place", "first_magnitude", "first_magnitude_type",
                    "first_station_count", "final_magnitude", "shift", "shift_abs",
                    "direction", "cohort")


def event_tables(timeline: DataFrame) -> dict[str, DataFrame]:
    current = current_versions(timeline)
    revisions = revision_history(timeline)
    return {"revision_history": revisions,
            "identity_history": identity_history(current),
            "alert_reliability": alert_reliability(revisions),
            "magnitude_scales": magnitude_scales(current),
            "review_lag": review_lag(current)}


def revision_tables(ranked: DataFrame, timeline: DataFrame | None = None
                    ) -> dict[str, DataFrame]:
    dataset = revision_columns(pairs_by_join(ranked))
    tables = {"magnitude_revision": dataset, "alert_curve": alert_curve(dataset)}
    if timeline is not None:
        reports = current_versions(timeline).select(*REPORT_COLUMNS)
        tables["human_witness"] = witness_columns(
            join_reports(dataset.select(*REVISION_COLUMNS), reports))
    return tables


def write_tables(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    return {name: write_table(frame, root, name) for name, frame in tables.items()}
