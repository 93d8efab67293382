"""Magnitude scales: prefix rules to a family and to the value above which a scale saturates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (prefix, family, saturates above). The first rule that matches wins.
SCALE_RULES = (
    ("mww", "moment", 10.0),
    ("mwr", "moment", 10.0),
    ("mwc", "moment", 10.0),
    ("mwb", "moment", 10.0),
    ("mw", "moment", 10.0),
    ("ms_vx", "surface_wave", 8.0),
    ("ms", "surface_wave", 8.0),
    ("mb_lg", "body_wave", 6.5),
    ("mb", "body_wave", 6.5),
    ("ml", "local", 6.5),
    ("mlr", "local", 6.5),
    ("md", "duration", 5.0),
    ("mh", "duration", 5.0),
)
# Alternatives are tried from left to right, so the first rule that matches wins here too.
PREFIXES = "^(" + "|".join(rule[0] for rule in SCALE_RULES) + ")"
REFERENCE_FAMILY = "moment"
UNKNOWN_FAMILY = "inconnue"
UNKNOWN_SATURATION = 5.0
# Scales that saturate this high are not drawn with a ceiling.
CEILING_LIMIT = 9.0


def _first_rule(scale_type: Column, position: int) -> Column:
    """What the first matching rule says, else null. The text is put in lower case once: inside the
    branches of a conditional, Spark would do it again for each rule."""
    prefix = F.regexp_extract(F.lower(F.trim(scale_type)), PREFIXES, 1)
    table = F.create_map(*[F.lit(item) for rule in SCALE_RULES for item in (rule[0], rule[position])])
    return F.try_element_at(table, prefix)


def family_of(scale_type: Column) -> Column:
    return F.coalesce(_first_rule(scale_type, 1), F.lit(UNKNOWN_FAMILY))


def saturation_of(scale_type: Column) -> Column:
    return F.coalesce(_first_rule(scale_type, 2), F.lit(UNKNOWN_SATURATION))


def is_saturated(magnitude: Column, scale_type: Column) -> Column:
    """Null when the magnitude is null."""
    return magnitude >= saturation_of(scale_type)


def is_reference(scale_type: Column) -> Column:
    return family_of(scale_type) == F.lit(REFERENCE_FAMILY)


def display_ceiling(scale_type: Column) -> Column:
    """Ceiling to draw: null for unknown scales and for those that hardly saturate."""
    ceiling = _first_rule(scale_type, 2)
    return F.when(ceiling < CEILING_LIMIT, ceiling)
