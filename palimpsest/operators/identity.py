"""Which identifiers name the same record."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.identifiers import AUTOMATIC_PREFIX, has_automatic_alias
from palimpsest.operators.skew import ROWS_PER_TASK, lookup
from palimpsest.scratch import materialise


def identity_history(current: DataFrame) -> DataFrame:
    """Aliases of each current record, and whether its automatic identifier was replaced."""
    automatic = has_automatic_alias(F.col("all_ids"))
    return current.select(
        "event_key", "usgs_id", "all_ids", "networks", "reporting_network",
        F.size("all_ids").alias("identifier_count"), automatic.alias("automatic_origin"),
        (automatic & ~F.col("usgs_id").startswith(AUTOMATIC_PREFIX)).alias("identity_changed"),
        "review_status", "magnitude", "magnitude_type", "event_time", "place")


def identity_loss(identity: DataFrame) -> DataFrame:
    """Records that a join on the plain identifier would count twice."""
    return (identity.agg(F.count(F.lit(1)).alias("catalogue"),
                         F.count_if("automatic_origin").alias("traces"),
                         F.count_if("identity_changed").alias("identite_changee"))
            .withColumns({
                "part_tracee_pct": F.round(F.try_divide(
                    F.lit(100.0) * F.col("traces"), F.col("catalogue")), 1),
                "part_changee_pct": F.round(F.try_divide(
                    F.lit(100.0) * F.col("identite_changee"), F.col("catalogue")), 1)}))


def alias_histogram(identity: DataFrame) -> DataFrame:
    return identity.groupBy("identifier_count").agg(F.count(F.lit(1)).alias("seismes"))


def resolve_identities(records: DataFrame, identifier: str, aliases: str,
                       rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``resolved_key``: the smallest identifier reachable through shared aliases. Null
    aliases count as none; a record without any identifier has a null key.

    Connected components by alternating large-star and small-star steps (Kiveris et al.,
    2014). A record of k aliases gives k - 1 edges, a star and never all pairs. Each round is
    a map-combined minimum per node and a lookup of that minimum, in which hot nodes are not
    shuffled. Rounds are cut by written tables; they end when the edges no longer change.
    """
    rooted = _rooted(records, identifier, aliases)
    labels = _labels(rooted.select("_root", F.explode("_known").alias("hi")).filter("hi <> _root")
                     .select("hi", F.col("_root").alias("lo")), rows_per_task)
    return (lookup(rooted, labels.select(F.col("hi").alias("_root"), F.col("lo").alias("_label")),
                   ["_root"], "left", rows_per_task)
            .withColumn("resolved_key", F.coalesce("_label", "_root"))
            .select(*records.columns, "resolved_key"))


def _rooted(records: DataFrame, identifier: str, aliases: str) -> DataFrame:
    """Records with their sorted distinct identifiers and the smallest of them."""
    listed = F.coalesce(F.col(aliases), F.array().cast(records.schema[aliases].dataType))
    known = F.array_sort(F.array_distinct(F.array_compact(
        F.array_append(listed, F.col(identifier)))))
    return records.withColumn("_known", known).withColumn(
        "_root", F.try_element_at("_known", F.lit(1)))


def _labels(pairs: DataFrame, rows_per_task: int) -> DataFrame:
    """hi, lo: the smallest node that each node is joined with; smallest nodes have no row."""
    edges = materialise(pairs.distinct(), "edges")
    seen = None
    while (mark := _signature(edges)) != seen:
        seen = mark

        def meet(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
            return lookup(rows, facts, [key], "inner", rows_per_task, at_most=mark[0])

        edges = materialise(_small_star(_large_star(edges, meet), meet), "edges")
    return edges


@dataclass(frozen=True)
class Identities:
    """What is known after some batches. ``nodes`` (node, label) gets rows and never changes one;
    ``moved`` (label, component) says which labels have been joined with a smaller one since."""

    nodes: DataFrame
    moved: DataFrame


def no_identities(spark: SparkSession) -> Identities:
    return Identities(spark.createDataFrame([], "node string, label string"),
                      spark.createDataFrame([], "label string, component string"))


def extend_identities(known: Identities, records: DataFrame, identifier: str, aliases: str,
                      rows_per_task: int = ROWS_PER_TASK) -> Identities:
    """Identities after one more batch of records. Stored components are contracted to one node
    each, so only edges of the batch are walked, however large the components are that they join.

    The batch's identifiers are looked up in ``nodes``; the new rows are written as a table of
    their own beside the old ones. Rows of hot identifiers are not shuffled.
    """
    rooted = _rooted(records, identifier, aliases)
    stars = materialise(rooted.filter("_root is not null").select(
        F.col("_root").alias("root"), F.explode("_known").alias("node")).distinct(), "stars")
    mine = stars.select("node").distinct()
    labelled = mine.join(known.nodes, "node", "left").join(known.moved, "label", "left").select(
        "node", F.coalesce("component", "label", "node").alias("at"), F.col("label").isNull().alias("new"))
    labelled = materialise(labelled, "labelled")

    def at(rows: DataFrame, name: str, end: str) -> DataFrame:
        return lookup(rows, labelled.select(F.col("node").alias(name), F.col("at").alias(end)), [name], "inner", rows_per_task)

    contracted = at(at(stars, "node", "one"), "root", "other").filter("one <> other").select(
        F.greatest("one", "other").alias("hi"), F.least("one", "other").alias("lo"))
    labels = _labels(contracted, rows_per_task).select(F.col("hi").alias("old"), F.col("lo").alias("least"))
    joined = labelled.join(labels, F.col("at") == F.col("old"), "left")
    new = materialise(joined.filter("new").select("node", F.coalesce("least", "at").alias("label")), "nodes")
    again = known.moved.join(labels, F.col("component") == F.col("old"), "left").select(
        "label", F.coalesce("least", "component").alias("component"))
    first = joined.filter(~F.col("new") & F.col("least").isNotNull()).select(
        F.col("at").alias("label"), F.col("least").alias("component")).distinct()
    return Identities(known.nodes.unionAll(new), materialise(again.unionAll(first), "moved"))


def resolved_by(known: Identities, records: DataFrame, identifier: str, aliases: str,
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``resolved_key`` to records of batches that are in ``known``."""
    rooted = _rooted(records, identifier, aliases)
    labelled = lookup(rooted, known.nodes.select(F.col("node").alias("_root"), F.col("label").alias("_label")),
                      ["_root"], "left", rows_per_task)
    found = lookup(labelled, known.moved.select(F.col("label").alias("_label"), "component"), ["_label"], "left",
                   rows_per_task)
    return found.withColumn("resolved_key", F.coalesce("component", "_label", "_root")).select(
        *records.columns, "resolved_key")


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame, meet: Callable[..., DataFrame]) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour or itself."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("lo").alias("lo"), F.col("lo").alias("near")),
        F.struct(F.col("hi").alias("lo"), F.col("lo").alias("near")))).alias("end"))
    nearest = ends.groupBy("end.lo").agg(F.min("end.near").alias("least"))
    moved = meet(edges, nearest, "lo")
    return moved.select("hi", F.col("least").alias("lo")).distinct()


def _small_star(edges: DataFrame, meet: Callable[..., DataFrame]) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to its smallest neighbour."""
    nearest = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    moved = meet(edges, nearest, "hi")
    pairs = moved.select(F.explode(F.array(
        F.struct(F.col("hi"), F.col("least").alias("lo")),
        F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo")))).alias("edge"))
    return pairs.select("edge.*").filter("hi <> lo").distinct()
