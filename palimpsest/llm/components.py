"""Connected components of undirected links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.scratch import materialise


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node with a link.

    ``links`` has two long columns. Alternating large-star and small-star steps (Kiveris et al.,
    2014): minima per node are combined before they are shuffled, and a node with very many links
    is a skewed join, which adaptive execution splits. Each round is a written table.
    """
    low, high = links.columns
    edges = materialise(_stars(links.select(F.col(low).alias("a"), F.col(high).alias("b"))), "links")
    seen = None
    while (mark := _signature(edges)) != seen:
        seen = mark
        edges = materialise(_stars(_large(edges)), "links")
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(roots)


def joined_components(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links: only the graph of components is walked again. ``found`` is
    a result of ``components``, ``links`` has two long columns."""
    low, high = links.columns

    def root(node: str, name: str) -> DataFrame:
        return found.select(F.col("node").alias(node), F.col("component").alias(name))

    between = links.join(root(low, "a"), low, "left").join(root(high, "b"), high, "left").select(
        F.coalesce("a", low).alias("a"), F.coalesce("b", high).alias("b")).where("a <> b").distinct()
    moved = components(between).select(F.col("node").alias("old"), F.col("component").alias("new"))
    kept = found.join(moved, F.col("component") == F.col("old"), "left").select(
        "node", F.coalesce("new", "component").alias("component"))
    added = moved.join(found.select("node"), F.col("old") == F.col("node"), "left_anti")
    return kept.unionAll(added.select("old", "new"))


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour, or to the node."""
    # The smallest neighbour of ``lo`` is below it if it is itself the ``hi`` of an edge.
    least = edges.groupBy(F.col("hi").alias("at")).agg(F.min("lo").alias("least"))
    return edges.join(least, F.col("lo") == F.col("at"), "left").select(
        F.col("hi").alias("a"), F.coalesce("least", "lo").alias("b"))


def _stars(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to its smallest neighbour."""
    edges = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo")
    least = edges.groupBy(F.col("hi").alias("at")).agg(F.min("lo").alias("least"))
    moved = edges.join(least, F.col("hi") == F.col("at"))
    return moved.select("hi", F.col("least").alias("lo")).unionAll(
        moved.select(F.col("lo").alias("hi"), F.col("least").alias("lo"))).where("hi <> lo").distinct()
