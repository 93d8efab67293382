"""Spark session settings the library relies on."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Values every job needs; partition counts and memory belong to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
}

# State of the streaming operators lives in RocksDB, beside the heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str, master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
                **(extra or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options on a session that somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, as --py-files would, once an application."""
    if spark.sparkContext.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(spark.sparkContext.applicationId)
