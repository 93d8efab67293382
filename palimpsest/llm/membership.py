"""Which rows may have a partner in a join, by a bitmap of fixed size.

A join of all texts with lists that some of them have would send every text over the network. The
ids that have a list set bits in a map of ``BITS`` bits (1 MB at most, whatever the number of ids),
which is broadcast; rows whose bit is not set have no partner for certain and stay where they are.
With very many ids most bits are set and the filter passes more, never less than it must. A null id
has no partner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23
ROW = 15  # bits of a position in one row of the map


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(BITS))


def bitmap(ids: DataFrame) -> DataFrame:
    """The map of a frame of one column of ids: at most BITS >> ROW rows of 4 KB."""
    bit = _bit(F.col(ids.columns[0]))
    return ids.where(F.col(ids.columns[0]).isNotNull()).select(
        F.shiftright(bit, ROW).alias("__row"), bit.bitwiseAND(F.lit((1 << ROW) - 1)).alias("__at")).groupBy("__row").agg(
        F.bitmap_construct_agg("__at").alias("__bits"))


def divide(frame: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among the ids, and rows whose key is not."""
    bit = _bit(F.col(key))
    marked = frame.withColumns({
        "__number": F.shiftright(bit, ROW), "__at": bit.bitwiseAND(F.lit((1 << ROW) - 1)).cast("int")}).join(
        F.broadcast(bitmap(ids)), F.col("__number") == F.col("__row"), "left")
    may = F.coalesce(F.expr("shiftright(cast(conv(hex(substring(__bits, __at div 8 + 1, 1)), 16, 10) as int), "
                            "__at % 8) & 1") == 1, F.lit(False)) & F.col(key).isNotNull()
    return marked.where(may).select(*frame.columns), marked.where(~may).select(*frame.columns)
