"""Revisions of a stream whose rows come late and out of order, with state that expires.

Rows wait in list state, packed as Arrow batches, until the watermark has passed them. An event-time
timer at the earliest of them then releases all that are due, in order, so what is put in order at once
are the rows of a group within the watermark's delay and those that a micro-batch brings. The last
values of each key stand in map state and are forgotten when the watermark is ``quiet`` beyond them; the
next message of the key is a first appearance again, and is one too if the message before it is so old
when both are released together, so the outcome does not depend on how the stream is cut into
micro-batches.

A group is one key, or, with ``shards``, all keys of a shard: where keys are many and their rows few, a
call of Python, a data frame and a timer a key cost more than the rows. A shard forgets by looking
through its keys, at most ``SWEEPS`` times in ``quiet``.

Rows without a time are left out; rows older than the watermark are late and dropped by Spark.
Rows that the watermark has not passed when the stream stops stay in the state for its next run.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from palimpsest.operators.live import NEW, REPEATED, REVISED

# Names of columns that reach a state processor must not begin with an underscore.
MICROS = "micros_of_time"
SHARD = "shard_of_key"
RESULT = "kind string, previous_magnitude double, previous_status string"
CHUNK_ROWS = 10_000
SWEEPS = 8


def _bare(values: pd.Series) -> np.ndarray:
    """Values as the state keeps them: nulls as None."""
    return values.astype(object).where(values.notna(), None).to_numpy()


class Reordered(StatefulProcessor):
    """``fields`` are those of a waiting row: its key, its time in microseconds, the order, the values."""

    def __init__(self, fields: StructType, order: Sequence[str], quiet: int) -> None:
        self.fields, self.order, self.quiet = fields, list(order), quiet
        self.key = fields[0]
        self.packed = to_arrow_schema(fields)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.last = handle.getMapState("last", StructType([self.key]), "micros long, magnitude double, status string")
        self.sweep = handle.getValueState("sweep", "millis long")
        self.served = set()

    def _chunks(self, frame: pd.DataFrame) -> list[tuple[bytes]]:
        rows = pa.Table.from_pandas(frame[self.packed.names], self.packed, preserve_index=False)
        found = []
        for batch in rows.combine_chunks().to_batches(CHUNK_ROWS):
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, self.packed) as stream:
                stream.write_batch(batch)
            found.append((out.getvalue().to_pybytes(),))
        return found

    def _held(self) -> pd.DataFrame:
        tables = [pa.ipc.open_stream(bytes(rows)).read_all() for (rows,) in self.waiting.get()]
        return pa.concat_tables([self.packed.empty_table(), *tables]).to_pandas(integer_object_nulls=True)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for frame in rows:
            self.waiting.appendList(self._chunks(frame))
            first = int(frame[MICROS].min())
            earliest = first if earliest is None else min(earliest, first)
        self.handle.registerTimer(earliest // 1000 + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # Timers of several micro-batches may expire at once; the first serves them all.
        if key in self.served:
            return
        self.served.add(key)
        watermark = timerValues.getCurrentWatermarkInMs()
        held = self._held()
        passed = held[MICROS] // 1000 < watermark
        oldest = None
        if passed.any():
            rest = held[~passed]
            if len(rest):
                self.waiting.put(self._chunks(rest))
                self.handle.registerTimer(int(rest[MICROS].min()) // 1000 + 1)
            else:
                self.waiting.clear()
            found, oldest = self._judge(held[passed], watermark)
            yield found
        self._forget(oldest, watermark)

    def _silent(self, micros: int, watermark: int) -> bool:
        return micros // 1000 + self.quiet < watermark

    def _judge(self, due: pd.DataFrame, watermark: int) -> tuple[pd.DataFrame, int | None]:
        """Rows with their kinds, and the oldest time that was noted down as a key's last."""
        name = self.key.name
        rows = due.sort_values([name, MICROS, *self.order], na_position="first", ignore_index=True)
        opens, closes = (np.flatnonzero(~rows[name].duplicated(keep=keep)) for keep in ("first", "last"))
        at, magnitude, status = rows[MICROS].to_numpy(), rows["magnitude"].to_numpy(float), _bare(rows["status"])
        keys = _bare(rows[name].iloc[opens]).tolist()
        stored = [self.last.getValue((key,)) for key in keys]

        before_at, before_magnitude, before_status = (np.roll(values, 1) for values in (at, magnitude, status))
        fresh = np.zeros(len(rows), bool)
        for row, pair in zip(opens, stored, strict=True):
            fresh[row] = pair is None
            before_at[row], before_magnitude[row], before_status[row] = pair or (0, None, None)
        fresh |= at - before_at >= self.quiet * 1000
        same = (magnitude == before_magnitude) | (np.isnan(magnitude) & np.isnan(before_magnitude))
        same &= (status == before_status).astype(bool)
        revised = ~fresh & ~same

        oldest = None
        for key, pair, row in zip(keys, stored, closes, strict=True):
            last = int(at[row])
            if not self._silent(last, watermark):
                value = None if np.isnan(magnitude[row]) else float(magnitude[row])
                self.last.updateValue((key,), (last, value, status[row]))
                oldest = last if oldest is None else min(oldest, last)
            elif pair is not None:
                self.last.removeKey((key,))
        return rows.assign(
            kind=np.where(fresh, NEW, np.where(same, REPEATED, REVISED)),
            previous_magnitude=np.where(revised, before_magnitude, np.nan),
            previous_status=np.where(revised, before_status, None)), oldest

    def _forget(self, oldest: int | None, watermark: int) -> None:
        """Look through the keys when one of them may be silent, and set the time to look again."""
        due = self.sweep.get()[0] if self.sweep.exists() else None
        after = None
        if due is not None and due <= watermark:
            gone, oldest = [], None
            for key, value in self.last.iterator():
                if self._silent(value[0], watermark):
                    gone.append(tuple(key))
                else:
                    oldest = value[0] if oldest is None else min(oldest, value[0])
            for key in gone:
                self.last.removeKey(key)
            self.sweep.clear()
            due, after = None, watermark + self.quiet // SWEEPS
        if due is None and oldest is not None:
            due = max(oldest // 1000 + self.quiet + 1, after or 0)
            self.sweep.update((due,))
            self.handle.registerTimer(due)

    def close(self) -> None:
        pass


def reordered_revisions(messages: DataFrame, key: str, time: str, order: Sequence[str], delay: str,
                        quiet_seconds: int, shards: int | None = None) -> DataFrame:
    """Kind of each message that the watermark has passed against the one before it in (time,
    ``order``), for messages that come at most ``delay`` late. Needs the RocksDB state store.

    ``shards``: the groups that keys are dealt into, which bounds the tasks that can share the work;
    without it each key is a group. A stream keeps the number it was started with.
    """
    timed = messages.withColumn(time, F.col(time).cast("timestamp")).where(F.col(time).isNotNull())
    narrow = timed.withWatermark(time, delay).select(
        key, time, F.unix_micros(time).alias(MICROS), *order,
        F.col("magnitude").cast("double").alias("magnitude"), F.col("status").cast("string").alias("status"))
    waiting = StructType([narrow.schema[name] for name in (key, MICROS, *order, "magnitude", "status")])
    schema = StructType([*waiting.fields, *StructType.fromDDL(RESULT).fields])
    grouped = narrow.groupBy(key) if shards is None else narrow.withColumn(
        SHARD, F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")).groupBy(SHARD)
    found = grouped.transformWithStateInPandas(
        statefulProcessor=Reordered(waiting, order, quiet_seconds * 1000), outputStructType=schema,
        outputMode="Append", timeMode="EventTime")
    return found.select(key, *order, F.timestamp_micros(MICROS).alias(time), "magnitude", "status", "kind",
                        "previous_magnitude", "previous_status")
