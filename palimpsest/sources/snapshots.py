"""Versioned tables: numbered Parquet snapshots, and a manifest that makes them visible.

A snapshot is written completely before its manifest row; readers only see snapshots that
have one, so a write that was cut short leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.sources.files import TableMissing, read_optional

MANIFEST_SCHEMA = ("version bigint, commit_time timestamp, operation string, lignes bigint, "
                   "inserees bigint, mises_a_jour bigint")


class RepeatedKey(ValueError):
    pass


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str,
                 partition_by: Sequence[str] = ()) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = list(partition_by)

    def history(self) -> DataFrame:
        """Versions, newest first: time, operation, rows, inserted, updated."""
        manifest = read_optional(self.spark, f"{self.root}/manifest")
        if manifest is None:
            manifest = self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return manifest.orderBy(F.desc("version"))

    def current_version(self) -> int | None:
        return self.history().agg(F.max("version")).first()[0]

    def as_of(self, version: int) -> DataFrame:
        if self.history().filter(F.col("version") == version).isEmpty():
            raise TableMissing(f"{self.root} has no version {version}")
        return self.spark.read.parquet(self._path(version))

    def read(self) -> DataFrame:
        version = self.current_version()
        if version is None:
            raise TableMissing(f"{self.root} has no version yet")
        return self.spark.read.parquet(self._path(version))

    def overwrite(self, frame: DataFrame) -> int:
        """Replace rows and schema."""
        return self._commit(frame, "WRITE")

    def merge(self, source: DataFrame, keys: Sequence[str]) -> int:
        """Rows with a known key replace it, the others are added. A source that holds a key
        more than once is refused: which of its rows should win is not known."""
        twice = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        if found := twice.limit(1).collect():
            raise RepeatedKey(f"{list(keys)} = {list(found[0])[:-1]} is there {found[0]['_n']} times")
        if self.current_version() is None:
            return self.overwrite(source)
        kept = self.read().join(source, list(keys), "left_anti")
        merged = kept.unionByName(source, allowMissingColumns=True)
        return self._commit(merged, "MERGE", source)

    def _path(self, version: int) -> str:
        return f"{self.root}/data/snapshot={version}"

    def _commit(self, frame: DataFrame, operation: str,
                source: DataFrame | None = None) -> int:
        last = self.history().first()
        version = 0 if last is None else last["version"] + 1
        writer = frame.write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(self._path(version))
        rows = self.spark.read.parquet(self._path(version)).count()
        # A merge adds what the table gained; the other source rows replaced one each.
        inserted = None if source is None else rows - last["lignes"]
        updated = None if source is None else source.count() - inserted
        entry = (version, datetime.now(timezone.utc), operation, rows, inserted, updated)
        (self.spark.createDataFrame([entry], MANIFEST_SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{self.root}/manifest"))
        return version


def read_as_of(spark: SparkSession, path: str, version: int, fmt: str = "parquet") -> DataFrame:
    """Time travel by number: numbered snapshots here, or a table format that is installed."""
    if fmt == "parquet":
        return SnapshotTable(spark, path).as_of(version)
    return spark.read.format(fmt).option("versionAsOf", version).load(path)
