"""Results of a stream that change, kept as one folder a micro-batch.

A micro-batch overwrites the folder of its own number, so a batch that is repeated after a failure
leaves what it left before. A reader takes, for each key, the rows of the highest number; a folder
can go once all its keys are in folders of higher numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

BATCH = "batch"


def write_batch(path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: the rows of a micro-batch, in place of any it left before."""
    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return write


def start(results: DataFrame, path: str, checkpoint: str, mode: str = "update",
          available_now: bool = True, interval: str = "30 seconds") -> StreamingQuery:
    writer = results.writeStream.foreachBatch(write_batch(path)).outputMode(mode).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def read_batches(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All rows with the number of their micro-batch."""
    return spark.read.schema(schema).parquet(path).withColumn(BATCH, F.col(BATCH).cast("long"))


def newest(spark: SparkSession, path: str, schema: StructType | str, keys: Sequence[str]) -> DataFrame:
    """The rows of each key from the last micro-batch that has any of it. What is shuffled is one
    number a key and task; keys that own many rows stay where they are read."""
    rows = read_batches(spark, path, schema)
    last = rows.groupBy(*keys).agg(F.max(BATCH).alias("_last"))
    same = [F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}")) for key in keys]
    found = rows.alias("l").join(last.alias("r"), [*same, F.col(f"l.{BATCH}") == F.col("r._last")])
    return found.select("l.*").drop(BATCH)

