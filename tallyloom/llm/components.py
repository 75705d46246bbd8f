"""Connected components of a link table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import freeze


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Each round takes the smallest label among the neighbours and then the label of that label,
    so a chain of n links needs about log n rounds. Rounds are written to the shared folder.
    The minimum combines before the shuffle, and a node with many links is a hot key only on
    the side that a skew join splits. An empty table has no nodes.
    """
    edges = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = freeze(edges.where("a != b").distinct(), "edges")
    labels = freeze(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    while True:
        near = (
            edges.join(labels, edges["b"] == labels["node"])
            .groupBy(edges["a"].alias("node"))
            .agg(F.min("component").alias("near"))
        )
        step = labels.join(near, "node").select("node", F.least("component", "near").alias("component"), F.col("component").alias("old"))
        above = labels.select(F.col("node").alias("component"), F.col("component").alias("above"))
        step = freeze(
            step.join(above, "component").select("node", F.least("component", "above").alias("component"), "old"), "labels"
        )
        labels = step.select("node", "component")
        if step.where("component != old").isEmpty():
            return labels
