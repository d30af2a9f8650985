"""Connected components of a link table, in distributed rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its smallest node.

    Each round gives a node the smallest label among itself, its neighbours and the node that its label names
    (pointer jumping), so that the rounds grow with the logarithm of a chain's length. Aggregation is map-side
    first, so that a node with very many links sends one row per task. Rows with nulls and self links are ignored.
    """
    kept = links.select("a", "b").where("a <> b")
    both = materialize(kept.unionByName(kept.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        .select("node", F.least("node", "low").alias("component"))
    )
    while True:
        near = both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), "component")
        jump = labels.alias("x").join(
            labels.select(F.col("node").alias("component"), F.col("component").alias("further")), "component"
        ).select("node", F.col("further").alias("component"))
        found = near.unionByName(jump).groupBy("node").agg(F.min("component").alias("found"))
        moved = materialize(
            labels.join(found, "node").select(
                "node", F.least("component", "found").alias("component"), (F.col("found") < F.col("component")).alias("moved")
            )
        )
        labels = moved.select("node", "component")
        if moved.where("moved").isEmpty():
            return labels
