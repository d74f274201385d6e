"""Connected components of an undirected graph of links, kept distributed throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import checkpointed


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (least node reachable) of every node of ``links`` (columns a, b).

    Each round takes the least label among neighbours, then the label's own label, so that long chains
    shrink fast; labels are written out every round.
    """
    edges = checkpointed(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("component")))
    while True:
        near = edges.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("low"))
        nearer = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "low").alias("at"))
        target = labels.select(F.col("node").alias("at"), F.col("component").alias("beyond"))
        step = checkpointed(nearer.join(target, "at").select("node", "old", F.least("at", "beyond").alias("component")))
        labels = step.select("node", "component")
        if step.filter("old <> component").isEmpty():
            return labels
