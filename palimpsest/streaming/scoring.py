"""Verdicts on live messages while they stream in."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.learning.features import missing_indicators
from palimpsest.learning.models import score_live
from palimpsest.operators.live import TRAINING_MINIMUM, live_features, parse_messages
from palimpsest.operators.skew import MAX_HOT

FAMILY = "first_family"


def domain_bounds(train: DataFrame, magnitude: str = "first_magnitude") -> DataFrame:
    """The smallest magnitude that training has of each family of scales."""
    return train.where(F.col(magnitude).isNotNull()).groupBy(FAMILY).agg(F.min(magnitude).alias("minimum"))


def score_messages(messages: DataFrame, envelope_schema, model: PipelineModel, bounds: DataFrame, now: Column,
                   default: float = TRAINING_MINIMUM) -> DataFrame:
    """Flat live records with suspicion and domain state, from a batch or a stream.

    The model's stages see one row at a time, so the stream needs no state. ``bounds`` has a row a
    family: the static side of the join, read again in each micro-batch, so new bounds are taken up
    while the stream runs. A family without a bound has ``default``.
    """
    if bounds.limit(MAX_HOT + 1).count() > MAX_HOT:
        raise ValueError("bounds by family are to be broadcast, these are too many")
    records = missing_indicators(live_features(parse_messages(messages, envelope_schema), now))
    known = F.broadcast(bounds.select(F.col(FAMILY).alias("_family"), F.col("minimum").alias("_minimum")))
    bounded = records.join(known, F.col(FAMILY) == F.col("_family"), "left").withColumn(
        "_minimum", F.coalesce("_minimum", F.lit(default))).drop("_family")
    return score_live(model, bounded, F.col("_minimum")).drop("_minimum")
