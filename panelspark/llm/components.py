"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the stored ``edges`` (a, b); a component's id is one of its nodes.

    Edges may repeat: they meet in an aggregation only, so no round shuffles
    them to tell them apart. Each round maps a node to the least of itself and its neighbours and
    replaces the edges by those between the images, until none is left; the
    maps are then composed. Stars take one or two rounds, chains a number of
    rounds in the logarithm of their length. All steps are joins and
    aggregations over edges.
    """
    edges = edges.filter("a != b")
    labels: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = scratch(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")).withColumnRenamed("a", "node"), "cc-step")
        left = step.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = scratch(edges.join(left, "a").join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b")).filter("a != b"), "cc-edges")
        if labels is None:
            labels = step.withColumnRenamed("to", "component")
        else:
            to = step.select(F.col("node").alias("component"), "to")
            labels = scratch(labels.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "cc-labels")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
