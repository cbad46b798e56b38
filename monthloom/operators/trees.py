"""Tree ensembles as node tables, and what can be told from such a table.

A node table ``(tree, node, feature, threshold, gain, cover, value, left, right)`` has a row per node. Nodes
of a tree are numbered from 0, the root. A row goes left where its feature, counted from 0, is at most
``threshold``; leaves have a ``value`` and nothing to split on. A table has at most two rows per leaf of
the model, whatever the data it was trained on.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthloom.operators.gather import union_all
from monthloom.sources.scratch import materialise

NODE = "tree int, node int, feature int, threshold double, gain double, cover double, value double, left int, right int"
# A tree for walking: nodes by their number. Features a sparse row lacks are 0.
WALKED = "array<struct<feature:int,threshold:double,left:int,right:int,value:double>>"


def read_saved(spark: SparkSession, path: str) -> DataFrame:
    """Node table of a boosted or random forest that Spark ML has saved under ``path``; values carry the tree's weight."""
    nodes = spark.read.parquet(f"{path}/data")
    trees = spark.read.parquet(f"{path}/treesMetadata")
    weights = trees.toDF(*["treeID", "about", "weight"][: len(trees.columns)]).select("treeID", "weight")
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0
    return nodes.join(weights, "treeID").select(
        F.col("treeID").alias("tree"),
        n["id"].alias("node"),
        F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        F.when(inner, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner, n["gain"]).alias("gain"),
        n["rawCount"].cast("double").alias("cover"),
        F.when(~inner, n["prediction"] * F.col("weight")).alias("value"),
        F.when(inner, n["leftChild"]).alias("left"),
        F.when(inner, n["rightChild"]).alias("right"),
    )


def importances(nodes: DataFrame) -> DataFrame:
    """``(feature_idx, splits, gain)`` of the features that are split on, indices from 1."""
    used = nodes.filter("feature is not null").groupBy((F.col("feature") + 1).alias("feature_idx"))
    return used.agg(F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain"))


def split_counts(nodes: DataFrame) -> DataFrame:
    """``(feature_idx, score)``: how often each feature is split on, as an importance list."""
    return importances(nodes).select("feature_idx", F.col("splits").cast("double").alias("score"))


def paths(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``path``, the conditions ``(feature, threshold, is_left)`` from the root to each node.

    One join per level of the deepest tree.
    """
    inner = nodes.filter("feature is not null").select("tree", "node", "feature", "threshold", "left", "right")
    step = "struct<feature:int,threshold:double,is_left:boolean>"
    front = nodes.filter("node = 0").select("tree", "node", F.array().cast(f"array<{step}>").alias("path"))
    reached = []
    while True:
        reached.append(front)
        sides = [F.struct(F.col(side).alias("node"), F.lit(side == "left").alias("is_left")) for side in ("left", "right")]
        below = front.join(inner, ["tree", "node"]).select("tree", "path", "feature", "threshold", F.explode(F.array(*sides)).alias("to"))
        grown = F.concat("path", F.array(F.struct("feature", "threshold", F.col("to.is_left").alias("is_left")).cast(step)))
        front = materialise(below.select("tree", F.col("to.node").alias("node"), grown.alias("path")))
        if front.isEmpty():
            break
    return nodes.join(union_all(reached), ["tree", "node"])


def turns(path: Column) -> Column:
    """A path as text: L and R from the root on."""
    return F.array_join(F.transform(path, lambda s: F.when(s["is_left"], "L").otherwise("R")), "")


def boxes(node_paths: DataFrame) -> DataFrame:
    """``(tree, node, feature, above, upto)``: a leaf holds the rows with every feature in ``(above, upto]``; null is unbounded."""
    steps = node_paths.filter("feature is null").select("tree", "node", F.inline("path"))
    return steps.groupBy("tree", "node", "feature").agg(
        F.max(F.when(~F.col("is_left"), F.col("threshold"))).alias("above"), F.min(F.when(F.col("is_left"), F.col("threshold"))).alias("upto")
    )


def literal(trees: list[list[dict]]) -> Column:
    """Trees on the driver as one constant that :func:`leaf_of` can walk."""
    return F.from_json(F.lit(json.dumps(trees)), f"array<{WALKED}>")


def walked(nodes: DataFrame) -> DataFrame:
    """All trees in one row, in order; as large as the model."""
    row = F.struct("feature", "threshold", "left", "right", "value")
    by_tree = nodes.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct("node", row.alias("row")))).alias("rows"))
    each = by_tree.select("tree", F.transform("rows", lambda r: r["row"]).cast(WALKED).alias("rows"))
    return each.agg(F.sort_array(F.collect_list(F.struct("tree", "rows"))).alias("trees")).select(F.transform("trees", lambda t: t["rows"]).alias("trees"))


def leaf_of(tree: Column, values: Column, steps: Column) -> Column:
    """The number of the node a row ends in after at most ``steps`` steps; ``values`` maps features to numbers."""

    def step(at: Column, _: Column) -> Column:
        node = F.get(tree, at)
        value = F.coalesce(F.try_element_at(values, node["feature"]), F.lit(0.0))
        return F.when(node["left"].isNull(), at).when(value <= node["threshold"], node["left"]).otherwise(node["right"])

    return F.aggregate(F.sequence(F.lit(0), steps), F.lit(0), step)


def margin(trees: Column, values: Column, steps: Column) -> Column:
    """Sum of the values of the leaves a row ends in."""
    return F.aggregate(trees, F.lit(0.0), lambda total, tree: total + F.get(tree, leaf_of(tree, values, steps))["value"])


def staged(trees: Column, values: Column, steps: Column) -> Column:
    """The margins after each tree."""
    start = F.struct(F.lit(0.0).alias("total"), F.array().cast("array<double>").alias("all"))

    def add(so_far: Column, tree: Column) -> Column:
        total = so_far["total"] + F.get(tree, leaf_of(tree, values, steps))["value"]
        return F.struct(total.alias("total"), F.concat(so_far["all"], F.array(total)).alias("all"))

    return F.aggregate(trees, start, add, lambda end: end["all"])


def _ready(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows with ``values``, and beside them all ``trees`` and ``steps`` enough for the deepest."""
    one = materialise(walked(nodes))
    tokens = F.map_from_entries(F.transform("tokens", lambda t: F.struct((t["idx"] - 1).alias("f"), t["value"].alias("v"))))
    depth = paths(nodes).agg(F.coalesce(F.max(F.size("path")), F.lit(0))).scalar()
    return rows.select("*", tokens.alias("values"), one.select("trees").scalar().alias("trees"), depth.alias("steps"))


def score(nodes: DataFrame, rows: DataFrame, factor: float = 1.0) -> DataFrame:
    """``(user_id, ovd_rate)`` of encoded rows; a margin is multiplied by ``factor`` (2 for Spark ML's trees) before it becomes a rate."""
    rate = 1 / (1 + F.exp(-F.lit(factor) * margin(F.col("trees"), F.col("values"), F.col("steps"))))
    return _ready(nodes, rows).select(F.col("user").alias("user_id"), rate.alias("ovd_rate"))


def round_errors(nodes: DataFrame, rows: DataFrame, factor: float = 1.0) -> DataFrame:
    """``(round, log_loss)`` over encoded rows with labels, after every tree; reports, and stops nothing."""
    margins = staged(F.col("trees"), F.col("values"), F.col("steps"))
    after = _ready(nodes, rows).select("label", F.posexplode(margins).alias("round", "margin"))
    signed = F.lit(factor) * F.col("margin") * F.when(F.col("label") > 0, -1).otherwise(1)
    loss = F.greatest(signed, F.lit(0.0)) + F.log1p(F.exp(-F.abs(signed)))
    return after.groupBy((F.col("round") + 1).alias("round")).agg(F.avg(loss).alias("log_loss"))

