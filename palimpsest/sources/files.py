"""Scans of landed files and of finished tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palimpsest.sources.schemas import DOCUMENT, ENVELOPE, VERSIONS


class TableMissing(RuntimeError):
    pass


def read_json_lines(spark: SparkSession, paths: str | Sequence[str],
                    schema: StructType) -> DataFrame:
    """One JSON object per line; a line that is no JSON gives nulls, not an error."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(paths)


def read_envelopes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Features of live envelopes; envelopes without a raw identifier are dropped."""
    return (read_json_lines(spark, paths, ENVELOPE)
            .filter(F.col("raw.id").isNotNull()).select("raw.*"))


def read_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Features of whole-file documents, one row each."""
    documents = spark.read.schema(DOCUMENT).option("multiLine", "true").json(paths)
    return documents.select(F.explode("features").alias("feature")).select("feature.*")


def read_versions(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_json_lines(spark, paths, VERSIONS)


def read_completed(landed: DataFrame, manifest: DataFrame, batch: str = "batch") -> DataFrame:
    """Only batches that have a manifest row; the batch column prunes partitions."""
    return landed.join(manifest.select(batch).distinct(), batch, "left_semi")


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None when it is not there."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    frame = read_optional(spark, f"{root}/{name}")
    if frame is None:
        raise TableMissing(f"no Parquet files under {root}/{name}")
    return frame


def write_table(frame: DataFrame, root: str, name: str) -> str:
    """Replace a table. File count follows the data: nothing is forced into one task."""
    target = f"{root}/{name}"
    frame.write.mode("overwrite").parquet(target)
    return target


def available_tables(spark: SparkSession, root: str) -> DataFrame:
    """Names of the tables below ``root`` that hold files."""
    return (footprint_files(spark, f"{root}/*")
            .select(F.element_at(F.split("path", "/"), -2).alias("table"))
            .distinct().orderBy("table"))


def footprint_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below ``path``; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", "length"))


def layer_footprint(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """Files and bytes per layer."""
    frames = [footprint_files(spark, path).select(F.lit(name).alias("couche"), "length")
              for name, path in layers.items()]
    listed = frames[0]
    for frame in frames[1:]:
        listed = listed.unionByName(frame)
    return listed.groupBy("couche").agg(
        F.count(F.lit(1)).alias("fichiers"), F.sum("length").alias("octets"))
