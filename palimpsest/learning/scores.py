"""Measures of predictions and of the trivial answers they must beat. One row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.learning.features import LABEL, TARGET
from palimpsest.operators.quantiles import approximate, exact_quantiles

MOVEMENT_THRESHOLD = 0.05


def share_pct(part: Column, whole: Column) -> Column:
    """Null only when there is nothing to divide by; a true zero stays zero."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), 1)


def _errors(error: Column, prefix: str) -> list[Column]:
    return [F.avg(F.abs(error)).alias(f"{prefix}mae"),
            F.sqrt(F.avg(error * error)).alias(f"{prefix}rmse")]


def error_scores(predictions: DataFrame, prediction: str = "prediction") -> DataFrame:
    return predictions.agg(*_errors(F.col(TARGET) - F.col(prediction), ""))


def gain_over_zero(predictions: DataFrame, prediction: str = "prediction") -> DataFrame:
    """How much smaller the absolute error is than that of always answering zero."""
    zero, own = F.col("zero_mae"), F.col("mae")
    return (predictions.agg(F.avg(F.abs(TARGET)).alias("zero_mae"),
                            F.avg(F.abs(F.col(TARGET) - F.col(prediction))).alias("mae"))
            .select(F.round(F.try_divide(100.0 * (zero - own), zero), 1)
                    .alias("gain_sur_reference_pct"), (own < zero).alias("bat_la_reference")))


def baseline_scores(train: DataFrame, test: DataFrame) -> DataFrame:
    """Always zero, and always the mean of the training rows."""
    mean = train.agg(F.avg(TARGET).alias("mean")).first()["mean"] or 0.0
    return (test.agg(*_errors(F.col(TARGET), "zero_"),
                     *_errors(F.col(TARGET) - F.lit(float(mean)), "moyenne_"))
            .withColumn("moyenne_valeur", F.round(F.lit(float(mean)), 4)))


def sign_agreement(predictions: DataFrame, prediction: str = "prediction") -> DataFrame:
    moved = predictions.filter(F.abs(TARGET) >= MOVEMENT_THRESHOLD)
    agree = F.signum(prediction) == F.signum(TARGET)
    return (moved.agg(F.count(F.lit(1)).alias("seismes_deplaces"),
                      F.count_if(agree).alias("accords"))
            .withColumn("signe_correct_pct", share_pct(F.col("accords"),
                                                       F.col("seismes_deplaces"))))


def residual_band(predictions: DataFrame, prediction: str = "prediction",
                  exact: bool = False) -> DataFrame:
    shares = {"p50": 0.5, "p80": 0.8, "p90": 0.9}
    residual = predictions.select(F.abs(F.col(TARGET) - F.col(prediction)).alias("residual"))
    band = (exact_quantiles(residual, [], "residual", shares) if exact
            else residual.agg(*[approximate(F.col("residual"), share).alias(name)
                                for name, share in shares.items()]))
    return band.select(*[F.round(name, 3).alias(name) for name in shares])


def confusion(predictions: DataFrame, prediction: str = "prediction") -> DataFrame:
    truth, answer = F.col(LABEL) == 1.0, F.col(prediction) == 1.0
    tp, fp, fn = F.col("vrais_positifs"), F.col("faux_positifs"), F.col("faux_negatifs")
    return predictions.agg(
        F.count_if(truth & answer).alias("vrais_positifs"),
        F.count_if(~truth & answer).alias("faux_positifs"),
        F.count_if(truth & ~answer).alias("faux_negatifs"),
        F.count_if(~truth & ~answer).alias("vrais_negatifs")).withColumns({
            "precision_pct": share_pct(tp, tp + fp), "rappel_pct": share_pct(tp, tp + fn),
            "f1_pct": share_pct(2 * tp, 2 * tp + fp + fn)})


def majority_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """What always answering "stable" would score."""
    positive = F.count_if(F.col(LABEL) == 1.0)
    known = train.agg(F.count(F.lit(1)).alias("n"), positive.alias("p")).first()
    share = known["p"] / known["n"] if known["n"] else 0.0
    return test.agg(F.count(F.lit(1)).alias("n"), positive.alias("p")).select(
        F.lit("stable" if share < 0.5 else "sous-estime").alias("classe_majoritaire"),
        F.round(F.lit(100.0 * share), 1).alias("part_positive_apprentissage_pct"),
        share_pct(F.col("p"), F.col("n")).alias("part_positive_test_pct"),
        share_pct(F.col("n") - F.col("p"), F.col("n"))
        .alias("exactitude_si_toujours_stable_pct"))
