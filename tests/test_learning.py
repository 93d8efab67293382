import pytest
from row_text import rows
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from palimpsest.learning import forest, models, scores
from palimpsest.plans import training
from palimpsest.learning.features import (CATEGORICAL, NUMERIC, FeatureSet, NotKnownYet,
                                          add_label, missing_indicators, split_by_time)

SMALL = {"maxIter": 4, "maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.8}


@pytest.fixture(scope="module")
def dataset(spark):
    numbers = {name: F.lit(None).cast("double") for name in NUMERIC}
    words = {name: F.lit("w") for name in CATEGORICAL}
    frame = spark.range(400).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("event_time"),
        *[value.alias(name) for name, value in {**numbers, **words}.items()])
    frame = frame.withColumns({
        "first_magnitude": (F.col("event_id") % 10).cast("double"),
        "first_station_count": F.when(F.col("event_id") % 9 != 0, F.col("event_id") % 50),
        "first_magnitude_type": F.element_at(F.array(*map(F.lit, ("mb", "ml", "mww"))),
                                             (F.col("event_id") % 3 + 1).cast("int"))})
    frame = frame.withColumn("shift", F.when(F.col("first_magnitude") > 6, 0.4).when(
        F.col("first_magnitude_type") == "ml", -0.2).otherwise(0.0))
    return add_label(missing_indicators(frame)).cache()


def test_leakage_is_refused():
    with pytest.raises(NotKnownYet):
        FeatureSet(numeric=("first_magnitude", "final_magnitude"))
    reduced = FeatureSet().without(["first_latitude", "first_family"])
    assert "first_latitude" not in reduced.numeric and "first_family" not in reduced.categorical
    assert "first_latitude_absent" not in reduced.indicators


def test_split_is_by_time_and_whole(dataset):
    for exact in (True, False):
        train, test, boundary = split_by_time(dataset, exact=exact)
        assert train.count() == 280 and test.count() == 120
        assert boundary == 1_700_000_000 + 279 * 60


def test_empty_columns_are_not_used(dataset):
    usable = FeatureSet().usable(dataset)
    assert usable.numeric == ("first_magnitude", "first_station_count")


def test_scores(spark):
    frame = spark.createDataFrame(
        [(1.0, 0.0, 0.4, 0.1), (1.0, 0.0, 0.3, -0.1), (0.0, 0.0, -0.2, -0.2)],
        "sous_estime double, answer double, shift double, prediction double")
    matrix = scores.confusion(frame, "answer").first()
    assert (matrix.vrais_positifs, matrix.faux_negatifs, matrix.precision_pct,
            matrix.rappel_pct, matrix.f1_pct) == (0, 2, None, 0.0, 0.0)
    assert scores.sign_agreement(frame).first() == (3, 2, 66.7)
    assert scores.sign_agreement(frame.filter("shift > 9")).first() == (0, 0, None)
    assert scores.residual_band(frame, exact=True).first() == (0.3, 0.4, 0.4)
    base = scores.baseline_scores(frame, frame).first()
    assert round(base.zero_mae, 6) == 0.3 and base.moyenne_valeur == 0.1667
    assert scores.majority_baseline(frame, frame).first() == ("sous-estime", 66.7, 66.7, 33.3)
    assert round(scores.error_scores(frame).first().mae, 6) == round((0.3 + 0.4) / 3, 6)


@pytest.fixture(scope="module")
def flag(dataset):
    return models.fit_flag(dataset, boosting=SMALL)


def test_guards(dataset):
    with pytest.raises(models.TooFewRows):
        models.fit_flag(dataset.filter("shift <= 0"), boosting=SMALL)
    with pytest.raises(models.TooFewRows):
        models.check_test_size(dataset.limit(29))


def test_table_and_model_agree(spark, dataset, flag, tmp_path):
    flag.model.write().overwrite().save(str(tmp_path))
    stage = flag.model.stages[-1]
    table = forest.forest_table(
        spark, f"{tmp_path}/stages/{len(flag.model.stages) - 1}_{stage.uid}")
    assert table.select("tree").distinct().count() == SMALL["maxIter"]
    predictions = flag.model.transform(dataset)
    assert forest.disagreements(predictions, table).count() == 0
    broken = table.withColumn("value", -F.col("value"))
    assert forest.disagreements(predictions, broken).count() > 0
    loaded = PipelineModel.load(str(tmp_path)).transform(dataset)
    assert rows(loaded.select("event_id", "prediction")) == rows(
        predictions.select("event_id", "prediction"))
    assert models.area_under_roc(predictions) > 0.9


def test_importances_name_their_columns(dataset, flag):
    weights = {r.variable: r.poids for r in models.importances(flag, dataset).collect()}
    assert max(weights, key=weights.get) == "first_magnitude"
    assert set(weights) <= {*NUMERIC, *CATEGORICAL, *FeatureSet().indicators}
    schema = PipelineModel(flag.model.stages[:-1]).transform(dataset).schema
    names = models.slot_names(schema, flag.model.stages[-2].getInputCols())
    assert len(names) == flag.model.stages[-1].numFeatures
    # Three words and one slot for words not seen.
    assert names.count("first_magnitude_type") == 4


def test_unseen_word_is_scored(dataset, flag):
    strange = dataset.withColumns({"first_magnitude_type": F.lit("never seen"),
                                   "magnitude": F.col("first_magnitude")})
    scored = models.score_live(flag.model, strange, 4.0)
    assert scored.filter("suspicion IS NULL").count() == 0
    assert {r.etat for r in scored.select("etat").distinct().collect()} >= {"hors_domaine",
                                                                          "suspect"}


def test_regression_scores_better_than_nothing(dataset):
    fitted = models.fit_shift(dataset, boosting=SMALL)
    errors = scores.error_scores(fitted.model.transform(dataset)).first()
    zero = scores.baseline_scores(dataset, dataset).first()
    assert errors.mae <= zero.zero_mae


def test_a_labelled_run_has_its_own_folders(spark, dataset, tmp_path):
    pairs = dataset.drop(*[name for name in dataset.columns if name.endswith("_absent")])
    root = str(tmp_path)
    full = training.train_and_store(pairs, training.Run(root), boosting=SMALL)
    before = rows(full)
    less = training.train_and_store(pairs, training.Run(root, "ablation"),
                                    excluded=["first_magnitude"], boosting=SMALL)
    assert rows(spark.read.parquet(f"{root}/model_report")) == before
    area = {name: float(frame.filter("mesure = 'aire_sous_roc'").first().valeur)
            for name, frame in (("full", full), ("less", less))}
    assert area["full"] > area["less"]
    assert spark.read.parquet(f"{root}/model_export").filter("threshold IS NOT NULL").count() > 0
    PipelineModel.load(f"{root}/models_ablation/revision_shift")


def test_vectors_are_dealt_by_their_number(dataset, monkeypatch):
    class Trees:
        def fit(self, vectors):
            self.partitions, self.rows = vectors.rdd.getNumPartitions(), vectors.count()
            self.columns = vectors.columns
            return PipelineModel(stages=[])

    monkeypatch.setattr(models, "ROWS_PER_PARTITION", 10)
    trees = Trees()
    models.fit_trees(trees, "shift", dataset, FeatureSet().usable(dataset))
    assert (trees.partitions, trees.rows, trees.columns) == (40, 400, ["features", "shift"])


@pytest.mark.parametrize("name", ["feature_vectors", "model_report_facts"])
def test_no_trees_are_fitted_where_none_are_needed(spark, sf, monkeypatch, name):
    from catalogue import QUERIES
    from catalogue import models as queries

    def refuse(*_):
        raise AssertionError("fitted")

    monkeypatch.setattr(queries, "_CHAINS", {})
    monkeypatch.setattr(models, "fit_trees", refuse, raising=False)
    monkeypatch.setattr(models, "fit_flag", refuse)
    monkeypatch.setattr(models, "fit_shift", refuse)
    assert QUERIES[name](spark, sf).count()
