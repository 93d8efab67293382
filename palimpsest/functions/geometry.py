"""Points on the unit sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the bar that shows a shift: base height, largest shift drawn, height per unit.
BAR_BASE, BAR_CAP, BAR_SCALE = 0.04, 1.6, 0.34


def sphere_point(latitude: Column, longitude: Column, radius: Column) -> dict[str, Column]:
    polar = F.radians(F.lit(90.0) - latitude)
    turn = F.radians(longitude + F.lit(180.0))
    return {"x": -radius * F.sin(polar) * F.cos(turn),
            "y": radius * F.cos(polar),
            "z": radius * F.sin(polar) * F.sin(turn)}


def bar_height(shift: Column) -> Column:
    return F.lit(BAR_BASE) + F.least(F.abs(F.coalesce(shift, F.lit(0.0))),
                                     F.lit(BAR_CAP)) * F.lit(BAR_SCALE)
