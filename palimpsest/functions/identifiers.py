"""Comma-wrapped alias sets and the keys derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: prefix of identifiers given by an automatic solution.
AUTOMATIC_PREFIX = "usauto"


def split_tokens(raw: Column) -> Column:
    """``",a,b,"`` to ``[a, b]`` in the given order; null gives an empty array."""
    return F.filter(F.split(F.coalesce(raw, F.lit("")), ","), lambda token: token != "")


def split_aliases(raw: Column) -> Column:
    """Sorted distinct aliases."""
    return F.array_sort(F.array_distinct(split_tokens(raw)))


def canonical_key(aliases: Column, fallback: Column) -> Column:
    """Smallest alias, or the record's own identifier when it has none."""
    return F.coalesce(F.try_element_at(aliases, F.lit(1)), fallback)


def has_automatic_alias(aliases: Column) -> Column:
    return F.exists(aliases, lambda alias: alias.startswith(AUTOMATIC_PREFIX))
