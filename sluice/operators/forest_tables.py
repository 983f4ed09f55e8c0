"""A fitted forest or boosted model as tables: its nodes, its scores, its importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import quoted
from sluice.sources.scratch import fresh_path, materialise


def tree_nodes(model: Model, spark) -> DataFrame:
    """A row per node: ``tree, node, left, right, feature, threshold, categories, gain, weight, prediction, stats``.

    They are read from the files a model is saved as, so the forest never
    passes through the driver's Python.  ``feature`` is null for a leaf, whose
    children are -1.  A node on an indexed column sends ``categories`` to the
    left and has no threshold.  ``weight`` is the impurity-weighted number of
    rows, ``stats`` the rows per class.
    """
    path = fresh_path(spark, "forest")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    split = F.col("split")
    inner = F.col("leftChild") >= 0
    ordered = split["numCategories"] == -1
    return data.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"), F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & ordered, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & ~ordered, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, F.col("gain")).alias("gain"),
        F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x).alias("weight"),
        "prediction", F.col("impurityStats").alias("stats"))


def importance_by_gain(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """``feature, importance`` from the node table alone.

    A tree's importance is gain times rows, summed per feature and brought to
    one; the forest's is the mean of its trees', brought to one again.
    """
    per_tree = nodes.where("feature IS NOT NULL").groupBy("tree", "feature").agg(
        F.sum(F.col("gain") * F.col("weight")).alias("worth"))
    whole = per_tree.groupBy("tree").agg(F.sum("worth").alias("whole")).where("whole > 0")
    shares = per_tree.join(whole, "tree").groupBy("feature").agg(F.sum(F.col("worth") / F.col("whole")).alias("share"))
    total = shares.agg(F.sum("share").alias("total"))
    named = nodes.sparkSession.createDataFrame([(i, n) for i, n in enumerate(names)], "slot int, feature string")
    found = shares.crossJoin(total).select(F.col("feature").alias("slot"), (F.col("share") / F.col("total")).alias("importance"))
    return named.join(found, "slot", "left").select(  # the total is one row
        "feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))


def _goes_left(value: Column) -> Column:
    return F.when(F.col("categories").isNotNull(), F.array_contains("categories", value)).otherwise(
        value <= F.col("threshold"))


def descend(rows: DataFrame, nodes: DataFrame, key: str, features: str) -> DataFrame:
    """``key, tree, prediction, stats``: the leaf that each row ends in, in every tree.

    Level by level, all rows and trees at once: a join of where a row is with
    the nodes, and a step to a child.  Rows that have arrived wait.
    """
    held = materialise(nodes, "nodes")
    roots = held.where("node = 0").select("tree", F.lit(0).alias("node"))
    start = rows.select(quoted(key).alias("key"), vector_to_array(quoted(features)).alias("x"))
    # As many roots as trees.
    going, arrived = start.crossJoin(F.broadcast(roots)), None
    while True:
        at = materialise(going.join(held, ["tree", "node"]), "descent")
        done = at.where("feature IS NULL").select("key", "tree", "prediction", "stats")
        arrived = done if arrived is None else arrived.unionByName(done)
        on = at.where("feature IS NOT NULL")
        if on.isEmpty():
            return arrived
        value = F.element_at("x", F.col("feature") + 1)
        going = on.select("key", "x", "tree", F.when(_goes_left(value), F.col("left")).otherwise(
            F.col("right")).alias("node"))


def forest_probability(leaves: DataFrame) -> DataFrame:
    """``key, probability``: the mean over trees of class 1's share in the leaf."""
    share = F.col("stats")[1] / F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    return leaves.groupBy("key").agg(F.avg(share).alias("probability"))
