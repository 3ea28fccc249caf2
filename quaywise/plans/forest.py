"""A forest as a table of nodes, applied by joins.

Every node of every tree is one row; a row of features goes from the root of a
tree to its child node by node, which is one join for each level. So a stored
model can be read, explained and applied by any engine that joins tables, and
the predictions of the model can be recomputed from its nodes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.session import scratch_path

NODES = (
    "tree int, node int, feature int, threshold double, left_node int, right_node int, value double"
)


def read_nodes(spark: SparkSession, model_path: str) -> DataFrame:
    """The nodes of a saved pipeline whose second stage is a forest; leaves have no feature.

    Features are numeric, so a node sends values up to its threshold to the left.
    """
    saved = spark.read.parquet(f"{model_path}/stages/1_*/data")
    node = F.col("nodeData")
    inner = node["leftChild"] >= 0
    threshold = node["split"]["leftCategoriesOrThreshold"][0]
    return saved.select(
        F.col("treeID").cast("int").alias("tree"),
        node["id"].cast("int").alias("node"),
        F.when(inner, node["split"]["featureIndex"]).cast("int").alias("feature"),
        F.when(inner, threshold).alias("threshold"),
        F.when(inner, node["leftChild"]).cast("int").alias("left_node"),
        F.when(inner, node["rightChild"]).cast("int").alias("right_node"),
        node["prediction"].cast("double").alias("value"),
    )


def predictions(
    nodes: DataFrame, rows: DataFrame, key: str, features: Sequence[str], depth: int
) -> DataFrame:
    """``key`` and ``prediction``, the mean over all trees, for rows with different keys.

    ``depth`` is the most that a tree may have; there are as many joins, and one
    for the values. ``nodes`` are stored once and read for each of them. A row
    travels once for each tree.
    """
    spark = nodes.sparkSession
    folder = scratch_path(spark, "nodes")
    nodes.write.parquet(folder)
    nodes = spark.read.schema(NODES).parquet(folder)
    trees = nodes.agg(F.max("tree").alias("last")).first()["last"]
    if trees is None:
        raise ValueError("a forest without trees")
    values = F.array(*(F.col(c).cast("double") for c in features))
    now = rows.select(
        key, values.alias("x"), F.explode(F.sequence(F.lit(0), F.lit(trees))).alias("tree"), F.lit(0).alias("node")
    )
    for _ in range(depth):
        at = now.join(nodes, ["tree", "node"])
        goes_left = F.element_at("x", F.col("feature") + 1) <= F.col("threshold")
        child = F.when(goes_left, F.col("left_node")).otherwise(F.col("right_node"))
        now = at.select(key, "x", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(child).alias("node"))
    ends = now.join(nodes.select("tree", "node", "value"), ["tree", "node"])
    return ends.groupBy(key).agg(F.avg("value").alias("prediction"))
