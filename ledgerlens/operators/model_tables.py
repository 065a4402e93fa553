"""Trained classifiers as tables: scores and optimality that plain joins and aggregates can state again.

A tree model is a table of nodes, and scoring walks rows down it level by level. A logistic regression is a
coefficient per slot, and its optimum is where the gradient of its loss vanishes.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_path
from .models import VECTOR, _slot_names


def tree_nodes(model: PipelineModel, like: DataFrame) -> DataFrame:
    """``(tree, weight, node, prediction, votes, slot, threshold, categories, low, high)``, a row per node.

    Read from the stored form of the model. ``slot`` is null for a leaf; ``votes`` holds a node's training weight per
    class; a row goes to the child ``low`` if its slot is at most ``threshold``, or among ``categories``.
    """
    spark = like.sparkSession
    path = new_path(spark, "tree-model")
    model.stages[-1].write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weight")
    nodes = spark.read.parquet(f"{path}/data").join(weights.select("treeID", "weight"), "treeID")
    split = F.col("nodeData.split")
    inner = F.col("nodeData.leftChild") >= 0
    number = inner & (split["numCategories"] < 0)
    return nodes.select(
        F.col("treeID").alias("tree"), "weight", F.col("nodeData.id").alias("node"), "nodeData.prediction",
        F.col("nodeData.impurityStats").alias("votes"), F.when(inner, split["featureIndex"]).alias("slot"),
        F.when(number, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & ~number, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.col("nodeData.leftChild").alias("low"), F.col("nodeData.rightChild").alias("high"),
    )


def walk(rows: DataFrame, nodes: DataFrame, depth: int, key: str) -> DataFrame:
    """``(key, tree, weight, prediction, votes)``: the leaf of every tree that each row of ``(key, x)`` ends in.

    One join with the nodes per level. The node table is as large as the model, and it is the side that is sent: the
    planner sees neither how many trees a row is walked down nor how long its vector is, and would send the rows.
    """
    trees = nodes.filter("node = 0").agg(F.collect_set("tree").alias("trees")).scalar()
    walkers = rows.select(key, "x", trees.alias("trees")).select(key, "x", F.explode("trees").alias("tree"), F.lit(0).alias("at"))
    steps = F.broadcast(nodes.select("tree", F.col("node").alias("at"), "slot", "threshold", "categories", "low", "high"))
    for _ in range(depth):
        met = walkers.join(steps, ["tree", "at"])
        value = F.get("x", "slot")
        goes_low = F.when(F.col("categories").isNotNull(), F.array_contains("categories", value)).otherwise(value <= F.col("threshold"))
        onward = F.when(F.col("slot").isNull(), F.col("at")).when(goes_low, F.col("low")).otherwise(F.col("high"))
        walkers = met.select(key, "x", "tree", onward.alias("at"))
    leaves = F.broadcast(nodes.select("tree", F.col("node").alias("at"), "weight", "prediction", "votes"))
    return walkers.select(key, "tree", "at").join(leaves, ["tree", "at"]).select(key, "tree", "weight", "prediction", "votes")


def _features(model: PipelineModel, rows: DataFrame, key: str) -> DataFrame:
    prepared = PipelineModel(model.stages[:-1]).transform(rows)
    return prepared.select(key, vector_to_array(VECTOR).alias("x"))


def forest_probabilities(model: PipelineModel, rows: DataFrame, key: str) -> DataFrame:
    """``(key, probability_1)``: the mean, over the trees, of the share of class 1 in the leaf."""
    leaves = walk(_features(model, rows, key), tree_nodes(model, rows), model.stages[-1].getMaxDepth(), key)
    total = F.aggregate("votes", F.lit(0.0), lambda s, v: s + v)
    return leaves.groupBy(key).agg(F.avg(F.col("votes")[1] / total).alias("probability_1"))


def boosted_probabilities(model: PipelineModel, rows: DataFrame, key: str) -> DataFrame:
    """``(key, probability_1)``: the logistic curve at twice the weighted sum of the leaves' predictions."""
    leaves = walk(_features(model, rows, key), tree_nodes(model, rows), model.stages[-1].getMaxDepth(), key)
    margin = F.sum(F.col("weight") * F.col("prediction"))
    return leaves.groupBy(key).agg((1 / (1 + F.exp(-2 * margin))).alias("probability_1"))


def coefficients(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``(slot, feature, coefficient)`` of a logistic regression; the intercept is slot -1."""
    fitted = model.stages[-1]
    named = list(enumerate(zip(_slot_names(model, rows), fitted.coefficients.toArray().tolist(), strict=True)))
    listed = [(-1, "(intercept)", float(fitted.intercept)), *[(i, name, c) for i, (name, c) in named]]
    return rows.sparkSession.createDataFrame(listed, "slot int, feature string, coefficient double")


def _margins(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows with ``margin``: intercept plus products of slots and coefficients, which are one array, as long as the vector."""
    one = table.agg(F.map_from_entries(F.collect_list(F.struct("slot", "coefficient"))).alias("c")).scalar()
    products = F.transform("x", lambda v, i: v * F.element_at("_c", i))
    margin = F.aggregate(products, F.element_at("_c", F.lit(-1)), lambda s, v: s + v)
    return rows.withColumn("_c", one).withColumn("margin", margin).drop("_c")


def logistic_probabilities(table: DataFrame, model: PipelineModel, rows: DataFrame, key: str) -> DataFrame:
    """``(key, probability_1)`` from the table of coefficients alone."""
    return _margins(table, _features(model, rows, key)).select(key, (1 / (1 + F.exp(-F.col("margin")))).alias("probability_1"))


def optimality(model: PipelineModel, train: DataFrame, label: str = "label") -> DataFrame:
    """``(slot, feature, coefficient, gradient)``: the gradient of the regularised mean loss on the training rows.

    One aggregate over rows and slots. All gradients vanish at the optimum, which is unique, as the penalty is
    strictly convex. The penalty is on coefficients of slots with unit deviation and leaves out the intercept.
    """
    table = coefficients(model, train)
    prepared = PipelineModel(model.stages[:-1]).transform(train).select(F.col(label).alias("y"), vector_to_array(VECTOR).alias("x"))
    residual = 1 / (1 + F.exp(-F.col("margin"))) - F.col("y")
    long = _margins(table, prepared).select(residual.alias("r"), F.posexplode(F.concat(F.array(F.lit(1.0)), "x")).alias("i", "v"))
    slopes = long.groupBy((F.col("i") - 1).alias("slot")).agg(F.avg(F.col("r") * F.col("v")).alias("slope"), F.var_samp("v").alias("variance"))
    penalty = F.when(F.col("slot") >= 0, F.lit(model.stages[-1].getRegParam()) * F.col("variance") * F.col("coefficient")).otherwise(0.0)
    return table.join(slopes, "slot").select("slot", "feature", "coefficient", (F.col("slope") + penalty).alias("gradient"))
