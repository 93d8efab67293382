"""The newest messages of a stream, kept in the state of a fixed number of shards.

Each shard keeps the newest ``size`` messages it has met in list state; all of them hold every
message that can be among the newest ``size`` of the whole stream, so one merge of at most
``shards`` * ``size`` rows gives these exactly. A shard whose ring changed puts it out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampNTZType, TimestampType

from palimpsest.operators.live import RING_SIZE

SHARDS = 16


class NewestRows(StatefulProcessor):
    """``fields`` are those of a message; ``order`` names the columns by which the newest is the
    largest, nulls the oldest. Equal messages are kept as often as they came."""

    def __init__(self, fields: StructType, order: Sequence[str], size: int) -> None:
        self.fields, self.order, self.size = fields, list(order), size
        self.names = fields.fieldNames()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", self.fields)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = list(self.ring.get())
        before = len(kept)
        found = pd.DataFrame(kept, columns=self.names, dtype=object).assign(_old=True)
        for frame in rows:
            # A batch is cut to the ring's size before it meets the ring.
            fresh = frame[self.names].sort_values(self.order, ascending=False, na_position="last").head(self.size)
            fresh = fresh.astype(object).where(fresh.notna(), None).assign(_old=False)
            found = pd.concat([found, fresh], ignore_index=True).sort_values(
                self.order, ascending=False, na_position="last", kind="stable").head(self.size)
        if len(found) == before and found["_old"].all():
            return
        newest = [tuple(self._whole(value, name) for value, name in zip(row, self.names))
                  for row in found[self.names].itertuples(index=False, name=None)]
        self.ring.put(newest)
        yield pd.DataFrame([(key[0], *row) for row in newest], columns=["shard", *self.names])

    def _whole(self, value, name: str):
        if value is None or pd.isna(value):
            return None
        return int(value) if self.fields[name].dataType.typeName() in ("long", "integer", "short", "byte") else value

    def close(self) -> None:
        pass


def newest_by_shard(messages: DataFrame, order: Sequence[str], size: int = RING_SIZE, shards: int = SHARDS) -> DataFrame:
    """Rings that changed, as rows with their shard. Times are carried in microseconds, so order
    and state need no zone. Needs the RocksDB state store."""
    timed = [field.name for field in messages.schema if isinstance(field.dataType, (TimestampType, TimestampNTZType))]
    plain = messages.select(*[
        F.unix_micros(F.col(name).cast("timestamp")).alias(name) if name in timed else F.col(name)
        for name in messages.columns])
    fields = StructType(plain.schema.fields)
    sharded = plain.withColumn("shard", F.pmod(F.xxhash64(*plain.columns), F.lit(shards)).cast("int"))
    return sharded.groupBy("shard").transformWithStateInPandas(
        statefulProcessor=NewestRows(fields, order, size),
        outputStructType=StructType([StructField("shard", IntegerType()), *fields.fields]),
        outputMode="Update", timeMode="None")


def merge_rings(rings: DataFrame, order: Sequence[str], timed: Sequence[str] = (), size: int = RING_SIZE) -> DataFrame:
    """The newest messages of all shards."""
    found = rings.orderBy(*[F.desc_nulls_last(name) for name in order]).limit(size).drop("shard")
    return found.withColumns({name: F.timestamp_micros(name) for name in timed})
