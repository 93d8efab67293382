"""A boosted forest as a table of nodes, and that table as one expression."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def last_stage(pipeline_path: str, pipeline: PipelineModel) -> str:
    """Folder of the last stage of a saved pipeline."""
    last = len(pipeline.stages) - 1
    digits = len(str(len(pipeline.stages)))
    return f"{pipeline_path}/stages/{last:0{digits}d}_{pipeline.stages[-1].uid}"


def forest_table(spark: SparkSession, model_path: str) -> DataFrame:
    """Nodes of a saved forest: tree, node, split, children, value, tree weight.

    Saving writes nodes as Parquet, so the table is a plain scan. A model has at most
    maxIter * 2^(maxDepth + 1) nodes.
    """
    nodes = spark.read.parquet(f"{model_path}/data")
    trees = spark.read.parquet(f"{model_path}/treesMetadata").toDF("tree", "about", "weight")
    split = F.col("nodeData.split")
    inner = F.col("nodeData.leftChild") >= 0
    continuous = split["numCategories"] < 0
    table = nodes.select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & continuous, F.get(split["leftCategoriesOrThreshold"], F.lit(0)))
        .alias("threshold"),
        F.when(inner & ~continuous, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, F.col("nodeData.leftChild")).alias("left"),
        F.when(inner, F.col("nodeData.rightChild")).alias("right"),
        F.col("nodeData.prediction").alias("value"))
    return table.join(trees.select("tree", "weight"), "tree")


def votes(forest: DataFrame, features: str = "features") -> Column:
    """Weighted vote of every tree on the assembled vector, as an array."""
    trees: dict[int, dict[int, object]] = {}
    weights: dict[int, float] = {}
    for row in forest.collect():
        trees.setdefault(row["tree"], {})[row["node"]] = row
        weights[row["tree"]] = row["weight"]
    slots = vector_to_array(features)

    def walk(nodes, at: int) -> Column:
        node = nodes[at]
        if node["left"] is None:
            return F.lit(node["value"])
        slot = F.get(slots, F.lit(node["feature"]))
        goes_left = (slot <= F.lit(node["threshold"]) if node["threshold"] is not None
                     else slot.isin([float(c) for c in node["categories"]]))
        return F.when(goes_left, walk(nodes, node["left"])).otherwise(walk(nodes, node["right"]))

    return F.array(*[walk(trees[tree], 0) * F.lit(weights[tree]) for tree in sorted(trees)])


def rescored(predictions: DataFrame, forest: DataFrame) -> DataFrame:
    """Raw sum, probability and class from the table, beside the model's own columns."""
    total = F.aggregate("votes", F.lit(0.0), lambda whole, vote: whole + vote)
    return (predictions.withColumn("votes", votes(forest)).withColumn("raw", total)
            .withColumns({"table_probability": 1 / (1 + F.exp(-2 * F.col("raw"))),
                          "table_class": F.when(F.col("raw") > 0, 1.0).otherwise(0.0)}))


def disagreements(predictions: DataFrame, forest: DataFrame,
                  tolerance: float = 1e-9) -> DataFrame:
    """Rows on which the table and the model differ; none is expected."""
    probability = F.get(vector_to_array("probability"), F.lit(1))
    return rescored(predictions, forest).filter(
        (F.col("table_class") != F.col("prediction"))
        | (F.abs(F.col("table_probability") - probability) > tolerance))


def parity(predictions: DataFrame, forest: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """One row: predictions compared, and those on which the table and the model differ."""
    probability = F.get(vector_to_array("probability"), F.lit(1))
    differs = (F.col("table_class") != F.col("prediction")) | (
        F.abs(F.col("table_probability") - probability) > tolerance)
    return rescored(predictions, forest).agg(
        F.count(F.lit(1)).alias("compared"), F.count_if(F.coalesce(differs, F.lit(True))).alias("different"))
