"""Outlines made smaller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.ordered import order_rows
from palimpsest.operators.skew import ROWS_PER_TASK

DECIMALS = 2
MINIMUM_POINTS = 4


def ring_points(features: DataFrame, key: str) -> DataFrame:
    """Points of polygons and multi-polygons as rows: key, ring, position, x, y.

    ``geometry`` carries ``type`` and JSON text ``coordinates``; other shapes have no rings.
    """
    shape = F.col("geometry.type")
    text = F.col("geometry.coordinates")
    ring_type = "array<array<array<double>>>"
    polygons = (F.when(shape == "Polygon", F.array(F.from_json(text, ring_type)))
                .when(shape == "MultiPolygon", F.from_json(text, f"array<{ring_type}>")))
    rings = features.select(key, F.posexplode(F.flatten(polygons)).alias("ring", "points"))
    return (rings.select(key, "ring", F.posexplode("points").alias("position", "point"))
            .select(key, "ring", "position", F.get("point", F.lit(0)).alias("x"),
                    F.get("point", F.lit(1)).alias("y")))


def compact_rings(points: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Round, drop points equal to the one before, drop rings that keep fewer than four.

    Rings stay rows of points, so a ring of any length is spread over tasks.
    """
    rounded = points.withColumns({"x": F.round("x", DECIMALS), "y": F.round("y", DECIMALS)})
    followed = order_rows(rounded, keys, order, rank="_at", lag={"_x": "x", "_y": "y"},
                          rows_per_task=rows_per_task)
    repeated = (F.col("_at") > 1) & F.col("x").eqNullSafe(F.col("_x")) & F.col("y").eqNullSafe(
        F.col("_y"))
    marked = followed.withColumn("_kept", F.when(repeated, 0).otherwise(1))
    numbered = order_rows(marked, keys, [F.col("_at")], running={"point": "_kept"},
                          total={"_points": "_kept"}, rows_per_task=rows_per_task)
    return (numbered.filter((F.col("_kept") == 1) & (F.col("_points") >= MINIMUM_POINTS))
            .select(*keys, "point", "x", "y", F.col("_points").alias("points")))
