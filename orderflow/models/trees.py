"""Fitted trees as tables: one row for each node, with its place, split and value."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.models.forest import feature_table
from orderflow.session import staged_path

ROOT = "T"


def tree_nodes(model: PipelineModel) -> DataFrame:
    """(tree, place, feature, threshold, left_value, rows, gain, prediction) of every node.

    ``place`` is the way from the root, such as ``TLR``. A row goes left if a numeric feature
    is at most ``threshold``, or if a one-hot feature equals ``left_value``; leaves have
    neither. The nodes are read from the model as Spark stores it, so they never pass the driver.
    """
    spark = SparkSession.active()
    path = staged_path(spark, "forest")
    forest = model.stages[-1]
    forest.write().save(path)
    stored = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    split, values = F.col("split"), F.col("split.leftCategoriesOrThreshold")
    numeric = F.col("split.numCategories") == -1
    is_split = F.col("leftChild") >= 0
    nodes = stored.select(
        "tree",
        "id",
        "leftChild",
        "rightChild",
        F.when(is_split, split.featureIndex).alias("index"),
        F.when(is_split & numeric, values[0]).alias("threshold"),
        F.when(is_split & ~numeric, values[0]).alias("left_value"),
        F.col("rawCount").alias("rows"),
        F.when(is_split, F.col("gain")).alias("gain"),
        "prediction",
    )
    return (
        _placed(nodes, forest.getOrDefault("maxDepth"))
        .join(feature_table(model), "index", "left")
        .select("tree", "place", "feature", "threshold", "left_value", "rows", "gain", "prediction")
    )


def _placed(nodes: DataFrame, depth: int) -> DataFrame:
    """``nodes`` with their place, level by level from the roots."""
    level = nodes.where("id = 0").withColumn("place", F.lit(ROOT))
    placed = level
    for _ in range(depth):
        children = level.select(
            "tree",
            F.explode(
                F.array(
                    F.struct(F.col("leftChild").alias("id"), F.concat("place", F.lit("L")).alias("place")),
                    F.struct(F.col("rightChild").alias("id"), F.concat("place", F.lit("R")).alias("place")),
                )
            ).alias("child"),
        ).select("tree", "child.*")
        level = nodes.join(children, ["tree", "id"]).select(*nodes.columns, "place")
        placed = placed.unionByName(level)
    return placed


def node_importance(nodes: DataFrame, names: DataFrame) -> DataFrame:
    """(feature, importance) of all ``names`` from a table of nodes, largest first.

    A split counts with its gain times its rows; each tree's weights add up to 1, and so
    do the weights of all trees.
    """
    weights = nodes.where("feature IS NOT NULL").groupBy("tree", "feature").agg(
        F.sum(F.col("gain") * F.col("rows")).alias("weight")
    )
    sums = weights.groupBy("tree").agg(F.sum("weight").alias("whole"))
    shares = weights.join(sums, "tree").groupBy("feature").agg(
        F.sum(F.col("weight") / F.col("whole")).alias("share")
    )
    all_trees = shares.agg(F.sum("share")).scalar()
    return (
        names.select("feature")
        .join(shares, "feature", "left")
        .select("feature", F.coalesce(F.try_divide("share", all_trees), F.lit(0.0)).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )
