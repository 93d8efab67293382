"""Epoch arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_epoch_ms(milliseconds: Column) -> Column:
    return F.timestamp_millis(milliseconds)


def minutes_after(published_ms: Column, event_time: Column) -> Column:
    """Minutes from the event (whole seconds) to its publication (milliseconds kept)."""
    return F.round((published_ms / F.lit(1000.0) - F.unix_timestamp(event_time)) / F.lit(60.0), 2)


def whole_second_minutes(later: Column, earlier: Column) -> Column:
    """Minutes between two timestamps, whole seconds, to a tenth."""
    return F.round((later.cast("long") - earlier.cast("long")) / F.lit(60.0), 1)


def lag_units(column: str) -> dict[str, Column]:
    """Hours and days of a lag given in minutes."""
    minutes = F.col(column)
    return {"lag_median_hours": F.round(minutes / F.lit(60), 1),
            "lag_median_days": F.round(minutes / F.lit(1440), 1)}
