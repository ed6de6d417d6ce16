"""Connected components by smallest-label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest
    node reachable.  Each round a node takes the smallest label around it,
    then the label of its label; rounds are written to the shared folder.
    The number of rounds grows with the logarithm of the longest path."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct()
    both = written(both, "links")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        near = labels.join(around, "node").select("node", "component", F.least("component", "near").alias("next"))
        hop = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        stepped = written(near.join(hop, "next").select("node", F.col("component").alias("old"), F.least("next", "far").alias("component")), "labels")
        moved = stepped.filter("component != old").limit(1).count()
        labels = stepped.select("node", "component")
        if not moved:
            return labels
