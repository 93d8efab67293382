"""From revision pairs to stored models and their report."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.learning import forest, models, scores
from palimpsest.learning.features import FeatureSet, add_label, missing_indicators, split_by_time
from palimpsest.scratch import materialise
from palimpsest.sources.files import write_table


def report_rows(section: str, row: DataFrame) -> DataFrame:
    """A one-row frame as (section, measure, value) rows."""
    entries = F.array(*[F.struct(F.lit(name).alias("mesure"),
                                 F.col(name).cast("string").alias("valeur"))
                        for name in row.columns])
    return row.select(F.lit(section).alias("section"), F.explode(entries).alias("e")).select(
        "section", "e.*")


def untrained_rows(train: DataFrame, test: DataFrame) -> list[DataFrame]:
    """Rows of the report that no model is needed for: the trivial answers and the size of the test."""
    return [report_rows("references", scores.baseline_scores(train, test)),
            report_rows("classification", test.agg(F.count(F.lit(1)).alias("taille_test")))]


def model_report(train: DataFrame, test: DataFrame, shift: models.Fitted,
                 flag: models.Fitted | None) -> DataFrame:
    """Measures of both models and of the trivial answers, one row each. Without a classifier
    its sections are left out."""
    predicted = shift.model.transform(test)
    parts = {"regression": scores.error_scores(predicted),
             "gain": scores.gain_over_zero(predicted),
             "accord_de_signe": scores.sign_agreement(predicted),
             "bande_de_residus": scores.residual_band(predicted)}
    if flag is not None:
        flagged = flag.model.transform(test)
        area = round(models.area_under_roc(flagged), 4)
        parts |= {"matrice": scores.confusion(flagged),
                  "reference": scores.majority_baseline(train, test),
                  "classification": train.sparkSession.range(1).select(F.lit(area).alias("aire_sous_roc"))}
    references, size = untrained_rows(train, test)
    frames = [report_rows(name, frame) for name, frame in parts.items()]
    frames += [references] if flag is None else [references, size]
    report = frames[0]
    for frame in frames[1:]:
        report = report.unionByName(frame)
    return report


@dataclass(frozen=True)
class Run:
    """Folders of a training run. A labelled run, such as an ablation, has its own and never
    replaces the reference run."""

    root: str
    label: str = ""

    def folder(self, name: str) -> str:
        return f"{name}_{self.label}" if self.label else name


def train_and_store(dataset: DataFrame, run: Run, excluded: Iterable[str] = (),
                    seed: int = models.SEED, boosting: dict | None = None) -> DataFrame:
    """Fit both models on the earlier rows, judge them on the later ones, store models, report
    and the classifier's nodes; returns the stored report."""
    spark = dataset.sparkSession
    features = FeatureSet().without(excluded)
    # Every boosting round reads the rows again.
    prepared = materialise(add_label(missing_indicators(dataset, features)), "prepared")
    train, test, _ = split_by_time(prepared)
    models.check_test_size(test)
    shift = models.fit_shift(train, features, seed, boosting)
    shift.model.write().overwrite().save(f"{run.root}/{run.folder('models')}/revision_shift")
    try:
        flag = models.fit_flag(train, features, seed, boosting)
    except models.TooFewRows:
        flag = None
    if flag is not None:
        path = f"{run.root}/{run.folder('models')}/revision_flag"
        flag.model.write().overwrite().save(path)
        write_table(forest.forest_table(spark, forest.last_stage(path, flag.model)), run.root,
                    run.folder("model_export"))
    return spark.read.parquet(write_table(model_report(train, test, shift, flag), run.root,
                                          run.folder("model_report")))
