"""Message rates and deduplication by event time, on batches and on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values.
RATE_WINDOW = "300 seconds"
RATE_STEP = "60 seconds"
HISTORY = 90


def rate_per_minute(messages: DataFrame, produced: str,
                    watermark: str | None = None) -> DataFrame:
    """Messages per minute in sliding windows of production time, not of arrival.

    The span covered by the messages divides, but at least a second; fewer than two messages
    have no rate. Counts are combined on the map side. On a stream give a watermark.
    """
    timed = messages.withWatermark(produced, watermark) if watermark else messages
    span = F.greatest(F.col("newest").cast("double") - F.col("oldest").cast("double"),
                      F.lit(1.0))
    return (timed.select(F.col(produced).alias("produced"))
            .groupBy(F.window("produced", RATE_WINDOW, RATE_STEP).alias("w"))
            .agg(F.count(F.lit(1)).alias("messages"), F.min("produced").alias("oldest"),
                 F.max("produced").alias("newest"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "messages",
                    F.when(F.col("messages") < 2, F.lit(0.0))
                    .otherwise(F.round(F.col("messages") * 60.0 / span, 1))
                    .alias("cadence_par_minute")))


def rate_history(rates: DataFrame, size: int = HISTORY) -> DataFrame:
    """The latest rates."""
    return rates.orderBy(F.desc("window_end")).limit(size)


def first_within(messages: DataFrame, time: str, delay: str,
                 content: Sequence[str]) -> DataFrame:
    """Copies of the same content that come within ``delay`` are dropped; state is bounded by
    the watermark."""
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(content))
