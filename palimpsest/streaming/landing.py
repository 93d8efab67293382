"""Messages from a stream to partitioned text, exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

# Fixed values.
TRIGGER_INTERVAL = "30 seconds"
BACKFILL_MINUTES = 10
# Options by which a source limits what one micro-batch admits.
LIMITS = ("maxOffsetsPerTrigger", "maxFilesPerTrigger", "maxBytesPerTrigger")
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def read_stream(spark: SparkSession, fmt: str, options: dict[str, str],
                schema: StructType | str | None = None, path: str | None = None) -> DataFrame:
    """A stream from Kafka, or from files with a fixed schema.

    A limit per micro-batch is required: it bounds what a single key can bring to one task.
    """
    if not any(name in options for name in LIMITS):
        raise ValueError(f"set one of {', '.join(LIMITS)}")
    merged = {**(KAFKA_DEFAULTS if fmt == "kafka" else {}), **options}
    reader = spark.readStream.format(fmt).options(**merged)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def bronze_rows(messages: DataFrame) -> DataFrame:
    """Message text and the day it was produced."""
    return messages.select(F.col("value").cast("string").alias("value"),
                           F.date_format("timestamp", "yyyy-MM-dd").alias("ingest_date"))


def land(rows: DataFrame, path: str, checkpoint: str, available_now: bool = False,
         partition: str = "ingest_date") -> StreamingQuery:
    """Append to text files by day. The checkpoint makes a restart continue where it stopped."""
    writer = (rows.writeStream.format("text").option("path", path)
              .option("checkpointLocation", checkpoint).partitionBy(partition)
              .outputMode("append"))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=TRIGGER_INTERVAL))
    return writer.start()


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, ingest_date string").text(path)


def backfill(messages: DataFrame, time: str, minutes: int = BACKFILL_MINUTES) -> DataFrame:
    """Messages of the last ``minutes`` before the newest one. On Kafka the same is asked of
    the source, by ``startingTimestamp``."""
    newest = messages.agg(F.max(time).alias("newest")).first()["newest"]
    if newest is None:
        return messages
    return messages.filter(
        F.col(time) >= F.lit(newest) - F.expr(f"interval {minutes} minutes"))
