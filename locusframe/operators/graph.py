"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .lineage import written_once


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Rows (node, component) for every node with an edge; the component is its least node.

    Each round takes the least label among the neighbours and then the label of
    that label, so chains shrink fast. The labels of a round are written once, and
    the loop ends when nothing changes. Labels are as many as nodes, so no join sends them through the driver.
    """
    both = edges.select(F.col(src).alias("node"), F.col(dst).alias("other"))
    both = written_once(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
    labels = written_once(both.groupBy("node").agg(F.min("other").alias("_m")).select("node", F.least("node", "_m").alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "other").hint("merge"), "other").groupBy("node").agg(F.min("component").alias("_near"))
        step = labels.join(near.hint("merge"), "node").select("node", "component", F.least("component", "_near").alias("_low"))
        jump = labels.select(F.col("node").alias("_low"), F.col("component").alias("_jump"))
        moved = step.join(jump.hint("merge"), "_low").select("node", F.least("_low", "_jump").alias("component"), (F.least("_low", "_jump") != F.col("component")).alias("_moved"))
        moved = written_once(moved)
        labels = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return labels
