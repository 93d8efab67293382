"""Sessions of messages: those of a key that follow each other within a gap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sessions(messages: DataFrame, keys: list[str], time: str, gap: str, measures: dict[str, Column],
             delay: str | None = None) -> DataFrame:
    """One row a session: from its first message to ``gap`` after its last, both of event time.

    Messages that come in any order merge the sessions they connect. On a stream give the delay by
    which messages may be late: a session comes out once the watermark has passed its end, and the
    state keeps open sessions only. Rows without a time are in no session. Parts of a session are
    combined before the shuffle.
    """
    timed = messages.where(F.col(time).isNotNull())
    timed = timed.withWatermark(time, delay) if delay else timed
    grouped = timed.groupBy(*keys, F.session_window(time, gap).alias("_session"))
    return grouped.agg(*[measure.alias(name) for name, measure in measures.items()]).select(
        *keys, F.col("_session.start").alias("session_start"), F.col("_session.end").alias("session_end"), *measures)
