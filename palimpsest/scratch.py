"""Intermediate tables that cut lineage and survive the loss of executors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
# Where the tables of the scopes that are open now go, the innermost last.
_open: list[str] = []


class NoSharedFolder(RuntimeError):
    pass


def shared_root(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``. Nothing is guessed: a folder
    that only one machine sees would lose tables with it."""
    configured = spark.conf.get(SETTING, None)
    if not configured:
        raise NoSharedFolder(f"set {SETTING} to a folder that all executors can reach")
    return configured.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    scope = _open[-1] if _open else f"{shared_root(spark)}/palimpsest"
    return f"{scope}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scope(spark: SparkSession) -> Iterator[str]:
    """Tables made inside are removed at the end, so results must be written or collected by then.

    Without a scope, tables stay until the cluster expires the folder's content.
    """
    folder = new_folder(spark, "scope")
    _open.append(folder)
    try:
        yield folder
    finally:
        _open.remove(folder)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` once and read it back: a stable, prunable table without lineage."""
    spark = frame.sparkSession
    path = new_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Remove the files of a table that ``materialise`` gave and nothing reads any more."""
    spark = frame.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def all_files_there(frame: DataFrame) -> bool:
    """Whether the files of a table that was read back still exist."""
    spark = frame.sparkSession
    paths = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name) for name in frame.inputFiles()]
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    return all(path.getFileSystem(settings).exists(path) for path in paths)
