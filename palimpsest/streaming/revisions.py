"""Revisions seen live: is a message new, a repetition, or a correction?"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType

from palimpsest.operators.live import NEW, REPEATED, REVISED
from palimpsest.operators.ordered import order_rows
from palimpsest.operators.skew import ROWS_PER_TASK


def batch_revisions(messages: DataFrame, key: str, order: Sequence[str],
                    rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Kind of each message against the one before it, and what it corrects.

    A change of magnitude or of status is a revision; null equals null.
    """
    seen = order_rows(messages, [key], [F.col(name) for name in order], rank="_at",
                      lag={"_magnitude": "magnitude", "_status": "status"},
                      rows_per_task=rows_per_task)
    same = (F.col("magnitude").eqNullSafe(F.col("_magnitude"))
            & F.col("status").eqNullSafe(F.col("_status")))
    kind = F.when(F.col("_at") == 1, NEW).when(same, REPEATED).otherwise(REVISED)
    return (seen.withColumn("kind", kind)
            .withColumn("previous_magnitude", F.when(F.col("kind") == REVISED,
                                                     F.col("_magnitude")))
            .withColumn("previous_status", F.when(F.col("kind") == REVISED, F.col("_status")))
            .drop("_at", "_magnitude", "_status"))


# Names of columns that reach a state processor must not begin with an underscore.
SHARD = "shard_of_key"
SHARDS = 512


class LastKnown(StatefulProcessor):
    """Keeps the last magnitude and status of each key of a shard in the state store.

    Keys are many and their rows few, and a call of Python, a batch of its results and a data frame
    each cost more than the rows of a key; so one call has the keys of a shard. Their rows arrive
    unordered within a micro-batch and are put in order here, nulls first; the limit that
    ``read_stream`` demands bounds how many there can be. Only keys that are in the micro-batch are
    read from the state, and only what changed is written.
    """

    def __init__(self, key: StructField, order: Sequence[str], columns: Sequence[str]) -> None:
        self.key, self.order, self.columns = key, list(order), list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", StructType([self.key]), "magnitude double, status string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        name = self.key.name
        frame = pd.concat(list(rows)).sort_values([name, *self.order], na_position="first", ignore_index=True)
        values = frame[["magnitude", "status"]].astype(object)
        values = values.where(values.notna(), None)
        opens, closes = ~frame[name].duplicated(), ~frame[name].duplicated(keep="last")
        before = values.shift(1)
        keys = [None if pd.isna(value) else value for value in frame[name][opens].tolist()]
        stored = [self.last.getValue((value,)) for value in keys]
        before.loc[opens, ["magnitude", "status"]] = [tuple(pair or (None, None)) for pair in stored]
        before = before.where(before.notna(), None)
        same = ((values == before) | (values.isna() & before.isna())).all(axis=1)
        kind = pd.Series(REVISED, index=frame.index).mask(same, REPEATED)
        kind[opens] = kind[opens].where([pair is not None for pair in stored], NEW)
        revised = kind == REVISED
        frame["kind"] = kind
        frame["previous_magnitude"] = before["magnitude"].where(revised, None).astype("float64")
        frame["previous_status"] = before["status"].where(revised, None)
        for value, pair, newest in zip(keys, stored, values[closes].itertuples(index=False, name=None), strict=True):
            if pair is None or tuple(pair) != newest:
                self.last.updateValue((value,), newest)
        yield frame[self.columns]

    def close(self) -> None:
        pass


def stream_revisions(messages: DataFrame, key: str, order: Sequence[str], shards: int = SHARDS) -> DataFrame:
    """The same as ``batch_revisions`` on a stream; state survives restarts and lost executors.

    Needs the RocksDB state store (see ``session.STATE_STORE``). Only the columns the result
    has go to the state operator: key, order, magnitude (double), status. ``shards`` bounds the tasks
    that can share the work; a stream keeps the number it was started with.
    """
    narrow = messages.select(key, *order, F.col("magnitude").cast("double").alias("magnitude"),
                             F.col("status").cast("string").alias("status"))
    schema = StructType.fromJson(narrow.schema.jsonValue())
    schema = (schema.add("kind", "string").add("previous_magnitude", "double")
              .add("previous_status", "string"))
    sharded = narrow.withColumn(SHARD, F.pmod(F.xxhash64(key), F.lit(shards)).cast("int"))
    return sharded.groupBy(SHARD).transformWithStateInPandas(
        statefulProcessor=LastKnown(narrow.schema[key], order, schema.names), outputStructType=schema,
        outputMode="Append", timeMode="None")


def counters(tracked: DataFrame, key: str) -> DataFrame:
    """Messages, distinct keys, first appearances, revisions, repetitions.

    Every key has exactly one first appearance, but keys are counted on their own so that the
    two figures check each other.
    """
    per_key = tracked.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == NEW).alias("new"),
        F.count_if(F.col("kind") == REVISED).alias("revised"),
        F.count_if(F.col("kind") == REPEATED).alias("repeated"))
    return per_key.agg(
        F.sum("n").alias("messages_total"), F.count(F.lit(1)).alias("seismes_distincts"),
        F.sum("new").alias("premieres_apparitions"),
        F.sum("revised").alias("revisions_captees"), F.sum("repeated").alias("repetitions"))


def running_totals(tracked: DataFrame) -> DataFrame:
    """Messages of each kind so far. On a stream, in update mode, only kinds that changed come out;
    counts are combined on the map side, and the state has one row a kind."""
    return tracked.groupBy("kind").agg(F.count(F.lit(1)).alias("messages"))


def total_counters(totals: DataFrame) -> DataFrame:
    """The figures of ``counters`` from totals by kind; where state does not expire, a key has one
    first appearance."""
    def of(*kinds: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind").isin(*kinds), F.col("messages"))), F.lit(0))

    return totals.agg(
        of(NEW, REVISED, REPEATED).alias("messages_total"), of(NEW).alias("seismes_distincts"),
        of(NEW).alias("premieres_apparitions"), of(REVISED).alias("revisions_captees"),
        of(REPEATED).alias("repetitions"))
