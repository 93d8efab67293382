"""Input schemas: fixed and explicit, never inferred. Names and types are fixed values."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DataType, DoubleType, MapType, StringType,
                               StructType)


def struct(**fields: str | DataType) -> StructType:
    """A struct of nullable fields; plain types are given by name."""
    built = StructType()
    for name, kind in fields.items():
        built.add(name, kind)
    return built


PROPERTIES = struct(
    mag="double", place="string", time="long", updated="long", tz="long", felt="long",
    cdi="double", mmi="double", alert="string", status="string", tsunami="long", sig="long",
    net="string", code="string", ids="string", sources="string", nst="long", dmin="double",
    rms="double", gap="double", magType="string", type="string")
GEOMETRY = struct(type="string", coordinates=ArrayType(DoubleType()))
FEATURE = struct(type="string", id="string", properties=PROPERTIES, geometry=GEOMETRY)
ENVELOPE = struct(fetched_at="string", usgs_id="string", raw=FEATURE)
DOCUMENT = struct(type="string", features=ArrayType(FEATURE))

ORIGIN_PRODUCT = struct(
    source="string", code="string", status="string", updateTime="long", preferredWeight="long",
    properties=MapType(StringType(), StringType()))
VERSIONS = struct(
    event_id="string", event_time="long", current_magnitude="double",
    current_magnitude_type="string", place="string", cohort="string",
    products=struct(origin=ArrayType(ORIGIN_PRODUCT)))
