"""Content fingerprints: two records with the same fingerprint say the same thing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The columns that make a version, the separator and the mark for null.
VERSION_COLUMNS = ("magnitude", "magnitude_type", "review_status", "latitude", "longitude",
                   "depth_km", "station_count", "azimuthal_gap", "residual_rms", "usgs_id")
SEPARATOR = "|"
NULL_MARK = "~"


def fingerprint(columns: Sequence[str] = VERSION_COLUMNS) -> Column:
    """SHA-256 of the text forms; publication time is left out on purpose."""
    texts = [F.coalesce(F.col(name).cast("string"), F.lit(NULL_MARK)) for name in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *texts), 256)


def line_weight(line: Column) -> Column:
    """48 bits of a line's SHA-256 as a number: their sum is a digest free of line order."""
    return F.conv(F.substring(F.sha2(line, 256), 1, 12), 16, 10).cast("decimal(38,0)")
