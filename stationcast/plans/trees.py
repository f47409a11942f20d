"""Predictions of saved boosted trees as joins with their stored nodes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.session import evenly, stage

# Where a saved pipeline keeps its boosted regression trees.
TREES = "stages/*_GBTRegressor_*"


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of the boosted trees in a saved pipeline, one row each.

    ``tree``, ``node``, the ``weight`` of the tree, the ``prediction`` of the node, its children
    ``left`` and ``right`` (-1 for a leaf), and how it parts: ``feature`` is the place in the
    vector, ``categories`` the number of categories or -1, ``values`` the threshold or the
    categories that go left.
    """
    weights = spark.read.parquet(f"{path}/{TREES}/treesMetadata").toDF("tree", "about", "weight")
    nodes = spark.read.parquet(f"{path}/{TREES}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.numCategories").alias("categories"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("values"),
    )
    return nodes.join(weights.select("tree", "weight"), "tree")


def tree_depth(spark: SparkSession, path: str) -> int:
    """How deep the trees may be, as the saved parameters say."""
    about = json.loads(spark.read.text(f"{path}/{TREES}/metadata").first()[0])
    return int({**about["defaultParamMap"], **about["paramMap"]}["maxDepth"])


def score_by_joins(vectors: DataFrame, trees: DataFrame, depth: int, vector: str = "features") -> DataFrame:
    """``vectors`` with ``prediction``, from an array column of features.

    Every row starts at the root of every tree; at each level it meets its node and goes on to a
    child, or stays if that is a leaf. The weighted predictions of the leaves are added up. Stored
    nodes have a known size: below Spark's threshold they are broadcast and the rows stay where
    they are, so the sum of a row is complete before it is shuffled. All columns of ``vectors``
    but the features come back; a row number of its own tells equal rows apart. The rows are stored
    with it, evenly dealt. Only number and features walk, and the sums are joined with the rest: with
    other columns among the sums, Spark would sort all rows of all trees.
    """
    numbered = evenly(vectors).withColumn("_row", F.monotonically_increasing_id())
    numbered = stage(numbered, "numbered")
    # One number: trees are as many as the model was given.
    last = trees.agg(F.max("tree")).first()[0]
    names = [f"_{name}" for name in trees.columns]
    nodes = trees.toDF(*names)
    walking = numbered.select("_row", F.col(f"`{vector}`"))
    at = walking.withColumns({"_at_tree": F.explode(F.sequence(F.lit(0), F.lit(last))), "_at_node": F.lit(0)})
    here = (F.col("_at_tree") == F.col("_tree")) & (F.col("_at_node") == F.col("_node"))
    value = F.get(F.col(vector), F.col("_feature"))
    goes_left = F.when(F.col("_categories") < 0, value <= F.get("_values", F.lit(0))).otherwise(
        F.array_contains("_values", value)
    )
    child = F.when(goes_left, F.col("_left")).otherwise(F.col("_right"))
    step = F.when(F.col("_left") < 0, F.col("_at_node")).otherwise(child)
    for _ in range(depth):
        at = at.join(nodes, here).withColumn("_at_node", step).drop(*names)
    leaves = at.join(nodes, here)
    total = F.sum(F.col("_weight") * F.col("_prediction")).alias("prediction")
    sums = leaves.groupBy("_row").agg(total)
    return numbered.drop(vector).join(sums, "_row").drop("_row")
