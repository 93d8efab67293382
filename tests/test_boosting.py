import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from palimpsest.learning import boosting, models
from palimpsest.learning.boosting import BoostedTrees, Unfit
from palimpsest.learning.features import CATEGORICAL, NUMERIC, FeatureSet, add_label, missing_indicators

WHOLE = {"maxIter": 6, "maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 1.0, "seed": 5, "minInstancesPerNode": 10}


@pytest.fixture(scope="module")
def vectors(spark):
    """Prepared vectors of rows with gaps, many values and four columns of words."""
    drawn = np.random.default_rng(3)
    n = 3000
    numbers = {name: drawn.normal(size=n).round(3) for name in NUMERIC}
    numbers["first_phase_count"] = drawn.integers(0, 5, n).astype(float)
    words = {name: drawn.integers(0, 12, n) for name in CATEGORICAL}
    shift = (np.where(numbers["first_magnitude"] > 0.4, 0.5, 0) + 0.1 * numbers["first_depth_km"]
             + np.where(words["first_contributor"] == 3, -0.7, 0) + 0.05 * drawn.normal(size=n))
    rows = [(i, float(shift[i]), *[None if (i + 7 * j) % 11 == 0 else float(numbers[name][i]) for j, name in enumerate(NUMERIC)],
             *[f"w{words[name][i]}" for name in CATEGORICAL]) for i in range(n)]
    frame = spark.createDataFrame(rows, ", ".join(
        ["event_id long", "shift double", *[f"{name} double" for name in NUMERIC], *[f"{name} string" for name in CATEGORICAL]]))
    kept = {}

    class Keep:
        def fit(self, given):
            kept["vectors"] = given
            return models.PipelineModel(stages=[])

    models.fit_trees(Keep(), "shift", add_label(missing_indicators(frame)), FeatureSet())
    labelled = kept["vectors"].withColumn("sous_estime", (F.col("shift") >= 0.2).cast("double")).coalesce(2).cache()
    assert labelled.count() == n
    return labelled


def nodes(model):
    found = []
    for number, tree in enumerate(model.trees):
        def walk(node, place):
            if node.numDescendants() == 0:
                found.append((number, place, round(node.prediction(), 9), round(node.impurity(), 9)))
                return
            split = node.split()
            cut = (round(split.threshold(), 9) if "Continuous" in split.getClass().getSimpleName()
                   else tuple(split.leftCategories()))
            found.append((number, place, split.featureIndex(), cut, round(node.gain(), 9), round(node.prediction(), 9)))
            walk(node.leftChild(), place + "l")
            walk(node.rightChild(), place + "r")

        walk(tree._call_java("rootNode"), "")
    return found


@pytest.mark.parametrize("trees", [
    lambda: GBTClassifier(labelCol="sous_estime", **WHOLE), lambda: GBTRegressor(labelCol="shift", lossType="absolute", **WHOLE),
    lambda: GBTRegressor(labelCol="shift", lossType="squared", **WHOLE)], ids=["logistic", "absolute", "squared"])
def test_trees_are_those_of_spark(vectors, monkeypatch, trees):
    trees = trees()
    monkeypatch.setattr(boosting, "PENDING", 2)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 700)
    monkeypatch.setattr(boosting, "CHUNK", 300)
    own, theirs = BoostedTrees(trees).fit(vectors), trees.fit(vectors)
    assert nodes(own) == nodes(theirs)
    assert own.treeWeights == theirs.treeWeights and own.numFeatures == theirs.numFeatures
    assert np.allclose(own.featureImportances.toArray(), theirs.featureImportances.toArray())
    both = [[row["prediction"] for row in model.transform(vectors).select("prediction").collect()] for model in (own, theirs)]
    assert np.allclose(*both)
    assert own.extractParamMap().keys() == theirs.extractParamMap().keys()
    assert {p.name: v for p, v in own.extractParamMap().items()} == {p.name: v for p, v in theirs.extractParamMap().items()}


def test_reads_are_few_and_small(vectors, monkeypatch):
    """A tree takes one read of the packed rows a level, each row a few bytes."""
    read, sizes = [], []
    count = boosting.Blocks.count

    def counted(self, level):
        read.append(level.nodes)
        sizes.append(self.frame.agg(F.sum(F.length("codes"))).first()[0])
        return count(self, level)

    monkeypatch.setattr(boosting.Blocks, "count", counted)
    BoostedTrees(GBTRegressor(labelCol="shift", lossType="absolute", **WHOLE)).fit(vectors)
    assert len(read) == WHOLE["maxIter"] * WHOLE["maxDepth"]
    # Of two children only one is counted.
    assert max(read) == 2
    assert max(sizes) / vectors.count() <= 2 * 18


def test_rows_are_drawn_anew_for_each_tree(vectors):
    trees = GBTRegressor(labelCol="shift", lossType="squared", **{**WHOLE, "subsamplingRate": 0.5})
    made = BoostedTrees(trees).fit(vectors)
    rows = [tree._call_java("rootNode").impurityStats().count() for tree in made.trees]
    assert len(set(rows)) > 1 and all(1300 < n < 1700 for n in rows)


@pytest.mark.parametrize("change", ["null label", "label of a class", "two words", "not finite"])
def test_rows_that_cannot_be_learned_from_are_refused(spark, vectors, change):
    trees = GBTClassifier(labelCol="sous_estime", **{**WHOLE, "maxIter": 1})
    if change == "null label":
        vectors = vectors.withColumn("sous_estime", F.lit(None).cast("double"))
    elif change == "label of a class":
        vectors = vectors.withColumn("sous_estime", F.lit(2.0))
    else:
        row = vectors.first()["features"].toArray()
        row[-12:] = 1.0
        if change == "not finite":
            row[:] = np.nan
        broken = spark.createDataFrame([(Vectors.dense(row), 1.0)], ["features", "sous_estime"])
        metadata = vectors.schema["features"].metadata
        vectors = broken.withColumn("features", F.col("features").alias("features", metadata=metadata))
    with pytest.raises(Exception, match="null|0 and 1|two words|not finite"):
        BoostedTrees(trees).fit(vectors)


def test_thresholds_and_trees_of_few_values(spark):
    assert list(boosting.find_thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 32)) == [1.5, 2.5]
    assert list(boosting.find_thresholds(np.full(5, 4.0), 32)) == []
    assert len(boosting.find_thresholds(np.arange(1000.0), 32)) == 31
    same = spark.createDataFrame([(Vectors.dense([1.0, 1.0]), 2.0)] * 4, ["features", "shift"])
    made = BoostedTrees(GBTRegressor(labelCol="shift", lossType="squared", **WHOLE)).fit(same)
    assert all(tree.numNodes == 1 for tree in made.trees)
    assert made.transform(same).first()["prediction"] == 2.0
