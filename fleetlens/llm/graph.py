"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.text import stored


def _followed(labels: DataFrame) -> DataFrame:
    """(id, label) with the smallest id that the pointers of ``labels`` lead to.

    Pointers to smallest neighbours run in no cycle but between two nodes; the smaller of these is where they end.
    """
    changed = True
    while changed:
        ahead = labels.select(F.col("id").alias("label"), F.col("label").alias("next"))
        least = F.least("id", "label", "next")
        labels = stored(labels.join(ahead, "label").select(
            "id", least.alias("label"), (least != F.col("label")).alias("changed")), "labels")
        changed = not labels.where("changed").isEmpty()
        labels = labels.drop("changed")
    return labels


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for the ids of ``edges`` (a, b); the component is its smallest id.

    Every round points each node at the smallest other id around it, follows the pointers to their ends and contracts
    the edges; as no node is left alone, at least half of the nodes that still have edges go, and pointers double their
    reach with each join, so a long chain takes few rounds. The minima are combined before the shuffle, so a node with
    very many edges is no burden. Rounds are written to the shared folder; edges never reach the driver.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                   "edges")
    result = None
    while not edges.isEmpty():
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        labels = _followed(stored(around.groupBy("a").agg(F.min("b").alias("label")).withColumnRenamed("a", "id"), "labels"))
        if result is None:
            result = labels.withColumnRenamed("label", "component")
        else:
            step = labels.select(F.col("id").alias("component"), "label")
            result = stored(result.join(step, "component", "left").select(
                "id", F.coalesce("label", "component").alias("component")), "components")
        first = labels.select(F.col("id").alias("a"), F.col("label").alias("la"))
        second = labels.select(F.col("id").alias("b"), F.col("label").alias("lb"))
        edges = stored(
            edges.join(first, "a").join(second, "b").where("la <> lb")
            .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(), "edges")
    if result is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return result
