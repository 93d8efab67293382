"""Rows of a key in order: numbers, neighbours, running sums, whatever the size of a key.

Ordinary keys use one Window, one shuffle and one sort. A hot key is cut into ranges of its
order by ``repartitionByRange``; windows run inside each range, and one summary row per range
(count, first row, last row) carries numbers and neighbours across the cuts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.skew import ROWS_PER_TASK, HotKeys, find_hot_keys, same_keys
from palimpsest.scratch import materialise

RANGE = "_range"
RANK = "_rank"
WHOLE = "_whole"
# Rows that one task sorts by key: some 130 MB of wide rows.
ROWS_PER_SORT = 250_000


def order_rows(frame: DataFrame, keys: Sequence[str], order: Sequence[Column], *,
               rank: str | None = None, count: str | None = None,
               lag: Mapping[str, str] | None = None, lead: Mapping[str, str] | None = None,
               running: Mapping[str, str] | None = None,
               total: Mapping[str, str] | None = None, keys_of: DataFrame | None = None,
               rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add per-key columns that depend on the order of rows.

    ``order`` holds ascending expressions (nulls first) and must be total. ``lag``, ``lead``,
    ``running`` and ``total`` (sum up to the row, sum over the key) map a new column to the
    column it reads; ``rank`` and ``count`` name the row number and the number of rows of the
    key. Without ``keys`` the whole frame is one sequence. Hot keys are looked for in
    ``keys_of`` when it is given: a frame that is cheaper to read and has no fewer rows of a key.
    """
    wanted = _Wanted(rank, count, dict(lag or {}), dict(lead or {}), dict(running or {}),
                     dict(total or {}))
    if not keys:
        whole = frame.withColumn(WHOLE, F.lit(0))
        ranges = max(2, -(-frame.count() // rows_per_task))
        return _by_ranges(whole, [WHOLE], order, wanted, ranges).drop(WHOLE)

    hot = find_hot_keys(frame if keys_of is None else keys_of, keys, rows_per_task)
    if not hot:
        return _by_window(frame, keys, order, wanted)
    cold_part = _by_window(frame.filter(~hot.condition), keys, order, wanted)
    hot_part = _by_ranges(frame.filter(hot.condition), keys, order, wanted,
                          _range_count(hot, rows_per_task))
    return cold_part.unionByName(hot_part)


def summarise_keys(frame: DataFrame, keys: Sequence[str], order: Sequence[str],
                   first: Sequence[str], last: Sequence[str],
                   folds: Mapping[str, Column] | None = None, keys_of: DataFrame | None = None,
                   rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row per key: ``_first`` and ``_last``, structs of columns of the key's first and last
    row in ``order``, and aggregates over all its rows.

    One shuffle, one sort and one window; nothing is aggregated through a sort of its own. Rows
    of hot keys are combined on the map side instead and never meet in one task.
    """
    folds = dict(folds or {})
    searched = frame if keys_of is None else keys_of
    hot = find_hot_keys(searched, keys, rows_per_task)
    cold = dealt(frame.filter(~hot.condition) if hot else frame, keys, searched.count())
    along = Window.partitionBy(*keys).orderBy(*order)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summary = cold.select(
        *keys, F.row_number().over(along).alias(RANK), F.struct(*first).alias("_first"),
        F.last(F.struct(*last)).over(whole).alias("_last"),
        *[fold.over(whole).alias(name) for name, fold in folds.items()]).filter(
        F.col(RANK) == 1).drop(RANK)
    if not hot:
        return summary
    position = F.struct(*order)
    return summary.unionByName(frame.filter(hot.condition).groupBy(*keys).agg(
        F.min_by(F.struct(*first), position).alias("_first"),
        F.max_by(F.struct(*last), position).alias("_last"),
        *[fold.alias(name) for name, fold in folds.items()]))


def dealt(frame: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``frame`` in one partition for each ROWS_PER_SORT of its ``rows``, where the session's number of
    shuffle partitions is smaller: that is fixed, and a task would sort ever more of a larger table."""
    partitions = -(-rows // ROWS_PER_SORT)
    if partitions <= int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return frame
    return frame.repartition(partitions, *keys)


class _Wanted:
    def __init__(self, rank, count, lag, lead, running, total):
        self.rank, self.count = rank, count
        self.lag, self.lead, self.running, self.total = lag, lead, running, total

    def columns(self, ordered) -> list[Column]:
        """Window columns of one specification, all in one select: one sort serves them."""
        whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        built = []
        if self.rank:
            built.append(F.row_number().over(ordered).cast("long").alias(self.rank))
        if self.count:
            built.append(F.count(F.lit(1)).over(whole).alias(self.count))
        built += [F.lag(source).over(ordered).alias(name) for name, source in self.lag.items()]
        built += [F.lead(source).over(ordered).alias(name) for name, source in self.lead.items()]
        built += [F.sum(source).over(so_far).alias(name)
                  for name, source in self.running.items()]
        built += [F.sum(source).over(whole).alias(name) for name, source in self.total.items()]
        return built


def _range_count(hot: HotKeys, rows_per_task: int) -> int:
    return max(2, -(-hot.rows // rows_per_task) + len(hot.hashes))


def _by_window(frame, keys, order, wanted: _Wanted) -> DataFrame:
    return frame.select("*", *wanted.columns(Window.partitionBy(*keys).orderBy(*order)))


def _by_ranges(frame, keys, order, wanted: _Wanted, partitions: int) -> DataFrame:
    # Written once, so that the range numbers seen by both branches below are the same.
    placed = materialise(
        frame.repartitionByRange(partitions, *[F.col(key) for key in keys], *order)
        .withColumn(RANGE, F.spark_partition_id()), "ranges")

    inner = _Wanted(RANK, "_in_range", wanted.lag, wanted.lead, wanted.running, {})
    local = placed.select("*", *inner.columns(
        Window.partitionBy(*keys, RANGE).orderBy(*order)))

    position = F.struct(*order)
    edges = placed.groupBy(*keys, RANGE).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min_by(F.struct(F.lit(1), *sorted(set(wanted.lead.values()))), position).alias("_first"),
        F.max_by(F.struct(F.lit(1), *sorted(set(wanted.lag.values()))), position).alias("_last"),
        *[F.sum(source).alias(f"_sum_{name}")
          for name, source in {**wanted.running, **wanted.total}.items()])

    # One row per range and key in it. It is broadcast only where Spark finds it small.
    along = Window.partitionBy(*keys).orderBy(RANGE)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    bridge = edges.select(
        *keys, RANGE,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(whole).alias("_all"),
        F.lag("_last").over(along).alias("_previous"),
        F.lead("_first").over(along).alias("_next"),
        *[F.sum(f"_sum_{name}").over(before).alias(f"_carried_{name}")
          for name in wanted.running],
        *[F.sum(f"_sum_{name}").over(whole).alias(name) for name in wanted.total])

    joined = local.join(bridge, same_keys(local, bridge, [*keys, RANGE]))
    columns = [local[name] for name in frame.columns]
    if wanted.rank:
        columns.append((local[RANK] + bridge["_offset"]).alias(wanted.rank))
    if wanted.count:
        columns.append(bridge["_all"].alias(wanted.count))
    for name, source in wanted.lag.items():
        columns.append(F.when(local[RANK] == 1, bridge["_previous"][source])
                       .otherwise(local[name]).alias(name))
    for name, source in wanted.lead.items():
        columns.append(F.when(local[RANK] == local["_in_range"], bridge["_next"][source])
                       .otherwise(local[name]).alias(name))
    for name in wanted.running:
        carried = bridge[f"_carried_{name}"]
        columns.append(F.coalesce(local[name] + carried, local[name], carried).alias(name))
    columns += [bridge[name] for name in wanted.total]
    return joined.select(*columns)
