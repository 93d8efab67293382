"""Where queries are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from palimpsest.session import apply_runtime_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(apply_runtime_settings(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build
    return add


def plain(frame: DataFrame) -> DataFrame:
    """Timestamps without zone, as SQL engines without zones show them."""
    zoned = [field.name for field in frame.schema if isinstance(field.dataType, TimestampType)]
    if not zoned:
        return frame
    return frame.select(*[
        F.col(name).cast("timestamp_ntz").alias(name) if name in zoned else F.col(name)
        for name in frame.columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
