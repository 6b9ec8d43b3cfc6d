"""Tree ensembles as relations: their nodes as a table, a scorer over it, and ensembles cut to their first trees."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from fleetlens.operators.running import default_parts
from fleetlens.session import scratch_path

Ensemble = GBTClassificationModel | RandomForestClassificationModel
# Nodes up to which the table is sent to every executor; beyond, the walk shuffles.
BROADCAST_NODES = 1_000_000

# What a task runs is sent along, so that it needs no package on the executors' path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def first_trees(model: GBTClassificationModel, trees: int) -> GBTClassificationModel:
    """The ensemble of the first ``trees`` trees of a boosted one.

    Boosting adds a tree to what the trees before it say and never changes those, and with a fixed seed the rows and
    features a tree sees depend on its number alone. So this is the model that boosting with fewer rounds fits.
    """
    ours = model._java_obj
    if trees >= model.getNumTrees:
        return model
    context = SparkSession.active().sparkContext
    jvm, gateway = context._jvm, context._gateway
    kept = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, trees)
    weights = gateway.new_array(jvm.double, trees)
    all_trees, all_weights = ours.trees(), ours.treeWeights()
    for k in range(trees):
        kept[k], weights[k] = all_trees[k], all_weights[k]
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        ours.uid(), kept, weights, ours.numFeatures(), ours.numClasses())
    return GBTClassificationModel(ours.copyValues(cut, ours.extractParamMap()))


def node_table(model: Ensemble) -> DataFrame:
    """(tree, node, feature, threshold, categories, left, right, value, share, rows, gain, weight), one row per node.

    A row goes left where its feature is at most the threshold, or among the categories where the feature has some
    (``threshold`` is null then); leaves have feature -1. ``value`` is the prediction of
    a regression tree, ``share`` the weighted share of class 1 among the training rows of the node. The table is read
    from what saving the model writes, so its size is that of the model and never that of the data.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "ensemble")
    model.write().save(path)
    # Both are written by position: a tree's number comes first, its weight last.
    nodes = spark.read.parquet(f"{path}/data").toDF("treeID", "nodeData")
    trees = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weights")
    node, split = "nodeData", "nodeData.split"
    stats = F.col(f"{node}.impurityStats")
    leaf, nominal = F.col(f"{node}.leftChild") < 0, F.col(f"{split}.numCategories") >= 0
    return nodes.join(F.broadcast(trees.select("treeID", F.col("weights").alias("weight"))), "treeID").select(
        F.col("treeID").cast("int").alias("tree"), F.col(f"{node}.id").alias("node"),
        F.when(leaf, -1).otherwise(F.col(f"{split}.featureIndex")).alias("feature"),
        F.when(~leaf & ~nominal, F.col(f"{split}.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(~leaf & nominal, F.col(f"{split}.leftCategoriesOrThreshold")).alias("categories"),
        F.col(f"{node}.leftChild").alias("left"), F.col(f"{node}.rightChild").alias("right"),
        F.col(f"{node}.prediction").alias("value"),
        F.when(F.size(stats) == 2, stats[1] / (stats[0] + stats[1])).alias("share"),
        F.col(f"{node}.rawCount").alias("rows"), F.when(leaf, 0.0).otherwise(F.col(f"{node}.gain")).alias("gain"), "weight")


def _dealt(rows: DataFrame, key: str, features: str) -> DataFrame:
    """(_key, _cells) over all shuffle partitions: a row becomes one per tree, and a few written files would be a few tasks."""
    dealt = rows.select(F.col(key).alias("_key"), F.col(features).alias("_vector")).repartition(default_parts(rows))
    return dealt.select("_key", vector_to_array("_vector").alias("_cells"))


def _tree_arrays(nodes: DataFrame) -> dict[int, dict[str, np.ndarray]]:
    """The arrays of every tree, indexed by node number; a row that has come to a leaf stays there on either side."""
    table = nodes.orderBy("tree", "node").toArrow()
    columns = {c: table[c].to_numpy() for c in ("tree", "node", "feature", "left", "right")}
    columns |= {c: table[c].cast("double").to_numpy().astype(float) for c in ("threshold", "value", "share", "weight")}
    nominal = np.flatnonzero(table["categories"].is_valid().to_numpy())
    listed = [table["categories"][int(k)].as_py() for k in nominal]
    known = np.zeros((len(nominal), 1 + int(max((max(c, default=0) for c in listed), default=0))), bool)
    for k, categories in enumerate(listed):
        known[k, [int(c) for c in categories]] = True
    columns["nominal"] = np.full(table.num_rows, -1)
    columns["nominal"][nominal] = np.arange(len(nominal))
    leaf = columns["feature"] < 0
    for side in ("left", "right"):
        columns[side] = np.where(leaf, columns["node"], columns[side])
    columns["feature"] = np.where(leaf, 0, columns["feature"])
    trees, starts = np.unique(columns["tree"], return_index=True)
    found = {}
    for tree, start, end in zip(trees.tolist(), starts, [*starts[1:], table.num_rows]):
        found[tree] = {c: v[start:end] for c, v in columns.items() if c not in ("tree", "node")}
        own = found[tree]["nominal"]
        found[tree]["known"] = known[own[own >= 0]]
        found[tree]["nominal"] = np.where(own >= 0, np.cumsum(own >= 0) - 1, -1)
    return found


def _leaves(cells: np.ndarray, tree: dict[str, np.ndarray], depth: int) -> np.ndarray:
    """The leaf that each row of ``cells`` comes to."""
    flat, starts, at = cells.reshape(-1), np.arange(len(cells)) * cells.shape[1], np.zeros(len(cells), np.int64)
    for _ in range(depth):
        cell = flat[starts + tree["feature"][at]]
        goes_left = cell <= tree["threshold"][at]
        if len(tree["known"]):
            kind = tree["nominal"][at]
            rows = np.flatnonzero(kind >= 0)
            asked, width = cell[rows], tree["known"].shape[1]
            whole = (asked >= 0) & (asked < width) & (asked == np.floor(asked))
            goes_left[rows] = whole & tree["known"][kind[rows], np.where(whole, asked, 0).astype(np.int64)]
        at = np.where(goes_left, tree["left"][at], tree["right"][at])
    return at


def _walked(state: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """(_key, tree, _value, _share, _weight) with every tree sent around as arrays, indexed by node number.

    Numbers of a tree's nodes are those of its nodes in preorder, without gaps, so a step down of a batch of rows is a few
    look-ups in arrays.
    """
    trees = state.sparkSession.sparkContext.broadcast(_tree_arrays(nodes))
    key = state.schema["_key"]
    schema = StructType([key, StructField("tree", IntegerType()), *[StructField(c, DoubleType()) for c in ("_value", "_share", "_weight")]])

    def run(batches):
        for batch in (b for b in batches if b.num_rows):
            # Vectors of one model are alike long; a row without one is refused before.
            cells = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for number, tree in trees.value.items():
                at = _leaves(cells, tree, depth)
                outputs = [pa.array(tree[c][at], from_pandas=True) for c in ("value", "share", "weight")]
                numbers = pa.array(np.full(batch.num_rows, number, np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0), numbers, *outputs], ["_key", "tree", "_value", "_share", "_weight"])

    return state.select("_key", "_cells").mapInArrow(run, schema)


def _joined_down(state: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """What ``_walked`` gives, by one join with the node table per level, for ensembles too large to be sent around."""
    table = nodes.select(*[F.col(c).alias(f"_{c}") for c in nodes.columns])
    trees = nodes.select("tree").distinct()
    state = state.crossJoin(F.broadcast(trees)).withColumn("node", F.lit(0))
    for level in range(depth + 1):
        found = state.join(table, (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_node")))
        if level == depth:
            return found.select("_key", "tree", "_value", "_share", "_weight")
        cell = F.col("_cells")[F.col("_feature")]
        goes_left = F.coalesce(cell <= F.col("_threshold"), F.array_contains("_categories", cell))
        below = F.when(goes_left, F.col("_left")).otherwise(F.col("_right"))
        state = found.select("_key", "_cells", "tree", F.when(F.col("_feature") < 0, F.col("node")).otherwise(below).alias("node"))
    raise AssertionError


def tree_outputs(rows: DataFrame, nodes: DataFrame, depth: int, key: str, features: str = "features") -> DataFrame:
    """(key, tree, value, share, weight): the leaf of every row in every tree.

    All trees are walked side by side; a row that has come to a leaf stays. The trees are sent to the executors up to
    BROADCAST_NODES nodes, beyond which every level is a join.
    """
    walk = _walked if nodes.count() <= BROADCAST_NODES else _joined_down
    found = walk(_dealt(rows, key, features), nodes, depth)
    return found.select(F.col("_key").alias(key), "tree", F.col("_value").alias("value"),
                        F.col("_share").alias("share"), F.col("_weight").alias("weight"))


def score_by_nodes(rows: DataFrame, model: Ensemble, key: str, features: str = "features") -> DataFrame:
    """(key, probability) of class 1, from the node table alone.

    A forest averages the shares of its leaves; a boosted ensemble sums the weighted values of its leaves to a margin.
    """
    depth = max((t.depth for t in model.trees), default=0)
    outputs = tree_outputs(rows, node_table(model), depth, key, features)
    if isinstance(model, GBTClassificationModel):
        margin = F.sum(F.col("weight") * F.col("value"))
        return outputs.groupBy(key).agg((1.0 / (1.0 + F.exp(-2.0 * margin))).alias("probability"))
    return outputs.groupBy(key).agg(F.avg("share").alias("probability"))


def split_counts(nodes: DataFrame) -> DataFrame:
    """(feature, splits) by the number of nodes that ask for a feature; features that no node asks for are absent."""
    return nodes.where("feature >= 0").groupBy("feature").agg(F.count(F.lit(1)).alias("splits"))
