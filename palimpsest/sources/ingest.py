"""Batches that land once: calendars, guards, manifests, replays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.content import line_weight
from palimpsest.functions.identifiers import has_automatic_alias, split_aliases
from palimpsest.operators.ordered import order_rows
from palimpsest.scratch import materialise
from palimpsest.sources.files import read_optional

# Fixed values.
PAGE_LIMIT = 20_000
BATCH_SIZE = 100
CONTROL_SAMPLE = 1000
SELECTION_SEED = 7


def month_calendar(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Months from ``first`` to ``last`` of a one-row frame, both included.

    A month is the half-open window from its first day to the first day of the next.
    """
    month = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"),
                       F.expr("interval 1 month"))
    return (bounds.select(F.explode(month).alias("starts"))
            .select(F.date_format("starts", "yyyy-MM").alias("period"),
                    F.year("starts").alias("year"), F.month("starts").alias("month"),
                    "starts", F.add_months("starts", 1).alias("ends_before")))


def pending(expected: DataFrame, manifest: DataFrame, batch: str = "period") -> DataFrame:
    return expected.join(manifest.select(batch), batch, "left_anti")


def truncated_batches(landed: DataFrame, limit: int = PAGE_LIMIT,
                      batch: str = "period") -> DataFrame:
    """Batches as large as the page limit: their end was probably cut."""
    return (landed.groupBy(batch).agg(F.count(F.lit(1)).alias("events"))
            .filter(F.col("events") >= limit))


def describe(lines: DataFrame, batch: str, value: str = "value") -> DataFrame:
    """Per batch: events, bytes (a line end each) and a digest free of line order."""
    text = F.col(value)
    return lines.groupBy(batch).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.octet_length(text) + 1).alias("bytes"),
        F.sum(line_weight(text)).cast("string").alias("digest"))


LANDED, MARKED, REJECTED, MISMATCH = "landed", "already marked", "rejected", "mismatch"


class BatchesRefused(RuntimeError):
    pass


class BatchLanding:
    """Landed batches under ``root/data/<batch>=…`` with a manifest written after them.

    With a ``limit`` batches as large as it are refused, for their end was probably cut. Without
    one every batch lands, whatever its size.
    """

    def __init__(self, spark: SparkSession, root: str, batch: str = "period",
                 limit: int | None = None) -> None:
        self.spark, self.root, self.batch, self.limit = spark, root.rstrip("/"), batch, limit

    def manifest(self) -> DataFrame:
        """One row per marked batch: the latest, where a batch was landed again."""
        names = ("events", "bytes", "digest", "ingested_at")
        found = read_optional(self.spark, f"{self.root}/manifest")
        if found is None:
            return self.spark.createDataFrame([], (
                f"{self.batch} string, events bigint, bytes bigint, digest string, "
                "ingested_at timestamp"))
        latest = found.groupBy(self.batch).agg(
            F.max_by(F.struct(*names), "ingested_at").alias("_last"))
        return latest.select(self.batch, *[F.col(f"_last.{name}").alias(name) for name in names])

    def landed(self) -> DataFrame:
        """Lines of batches that have a manifest row, and only those."""
        if self.manifest().isEmpty():
            return self.spark.createDataFrame([], f"{self.batch} string, value string")
        return self._files().join(self.manifest().select(self.batch), self.batch, "left_semi")

    def ingest(self, lines: DataFrame, force: bool = False) -> DataFrame:
        """Write the batches of ``lines`` that are not marked, check what was written against
        what was read, then mark the batches that agree. ``force`` lands marked batches again.

        Returns a row per batch: events, bytes, digest and outcome (landed, already marked,
        rejected, mismatch); ``require_landed`` raises on the last two. A replay finds its
        batches marked: it reads their names only. A run that was interrupted left files
        without a mark, which the next run replaces.
        """
        batch, same = self.batch, [self.batch, "events", "bytes", "digest"]
        marked = self.manifest()
        known = lines.select(batch).distinct().join(marked, batch).select(*same)
        if force:
            known = known.limit(0)
        else:
            lines = lines.join(marked.select(batch), batch, "left_anti")
        described = materialise(describe(lines, batch), "described")
        fits = F.lit(True) if self.limit is None else F.col("events") < self.limit
        todo = described.filter(fits)
        # One name per batch, as many as the manifest gains rows: literals, so that the check
        # reads the folders of these batches only.
        names = [row[0] for row in todo.select(batch).collect()]
        if names:
            fresh = lines.filter(F.col(batch).isin(names))
            # Rebalancing by batch keeps files few; AQE splits a batch too large for a task.
            (fresh.select(batch, "value").hint("rebalance", batch)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(batch).text(f"{self.root}/data"))
            agreed = materialise(
                self.written(names).join(todo.select(*same), same, "left_semi"), "agreed")
            (agreed.withColumn("ingested_at", F.current_timestamp())
             .write.mode("append").parquet(f"{self.root}/manifest"))
        else:
            agreed = todo.limit(0)
        outcome = (known.withColumn("outcome", F.lit(MARKED))
                   .unionByName(agreed.withColumn("outcome", F.lit(LANDED)))
                   .unionByName(described.filter(~fits).withColumn("outcome", F.lit(REJECTED)))
                   .unionByName(todo.join(agreed.select(batch), batch, "left_anti")
                                .withColumn("outcome", F.lit(MISMATCH))))
        return materialise(outcome.select(*same, "outcome"), "outcome")

    def written(self, batches: Sequence[str]) -> DataFrame:
        """What the files of some batches hold."""
        return describe(self._files().filter(F.col(self.batch).isin(list(batches))), self.batch)

    def _files(self) -> DataFrame:
        # The batch is text whatever it looks like: no type is guessed from folder names.
        return self.spark.read.schema(f"value string, {self.batch} string").text(
            f"{self.root}/data")


def require_landed(outcome: DataFrame) -> DataFrame:
    """The outcome of an ingestion, if no batch was refused; raises with the first of them."""
    refused = outcome.filter(F.col("outcome").isin(REJECTED, MISMATCH))
    some = refused.orderBy(outcome.columns[0]).limit(10).collect()
    if some:
        raise BatchesRefused(", ".join(f"{row[0]}: {row['outcome']} ({row['events']} events)"
                                       for row in some))
    return outcome


def select_cohorts(features: DataFrame, identifier: str, aliases: str,
                   control: int = CONTROL_SAMPLE, seed: int = SELECTION_SEED) -> DataFrame:
    """All records with an automatic alias, and a seeded sample of exactly ``control`` others.
    An identifier with rows of both kinds is traced, and no candidate for the sample.

    The sample is the smallest hashes of identifier and seed: stable under any partitioning,
    and a distributed top-k.
    """
    marked = (features.filter(F.col(identifier).isNotNull() & (F.col(identifier) != ""))
              .select(F.col(identifier).alias("event_id"),
                      has_automatic_alias(split_aliases(F.col(aliases))).alias("_traced")))
    traced = marked.filter("_traced").select("event_id").distinct()
    draw = F.sha2(F.concat_ws("|", "event_id", F.lit(str(seed))), 256)
    others = marked.filter(~F.col("_traced")).select("event_id").distinct().join(
        traced, "event_id", "left_anti")
    sample = others.orderBy(draw, "event_id").limit(control)
    return (traced.withColumn("cohort", F.lit("traced"))
            .unionByName(sample.withColumn("cohort", F.lit("control"))))


def assign_batches(members: DataFrame, order: Sequence[Column],
                   size: int = BATCH_SIZE) -> DataFrame:
    """Number members in a global order and cut them into batches of ``size``.

    The order is made by ranges, with offsets per range: no single task sees all members.
    """
    numbered = order_rows(members, [], order, rank="_at")
    return numbered.withColumn(
        "batch", F.floor((F.col("_at") - 1) / F.lit(size)).cast("long")).drop("_at")


def batch_manifest(requested: DataFrame, answers: DataFrame, value: str = "value") -> DataFrame:
    """Per batch: members requested, answered, failed, and what their lines weigh.

    ``answers`` holds event_id and one line of text; a member without a line failed.
    """
    joined = requested.join(answers, "event_id", "left")
    text = F.col(value)
    return joined.groupBy("batch").agg(
        F.count(F.lit(1)).alias("requested"), F.count(text).alias("events"),
        F.count_if(text.isNull()).alias("failures"),
        F.coalesce(F.sum(F.octet_length(text) + 1), F.lit(0)).alias("bytes"),
        F.sum(line_weight(text)).cast("string").alias("digest"))


class EmptyCheck(RuntimeError):
    pass


def replay_state(landing: BatchLanding) -> DataFrame:
    """One row that must not change under a replay; nothing landed is no proof and raises."""
    state = describe(landing.landed(), landing.batch).agg(
        F.count(F.lit(1)).alias("batches"), F.sum("events").alias("events"),
        F.sum("bytes").alias("bytes"),
        F.sum(F.col("digest").cast("decimal(38,0)")).cast("string").alias("digest"))
    if state.first()["batches"] == 0:
        raise EmptyCheck("no batch landed: a replay of nothing proves nothing")
    return state
