"""Connected sets of nodes, by labels that spread over edges and are followed to their own labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.settings import parked, released


def connected(edges: DataFrame) -> DataFrame:
    """node -> root, the smallest node it is connected with, for every node of the edges (a, b); a frame as `parked` returns it.

    A round takes the smallest label around each node and then that label's own label, so the distance a
    label has come about doubles. Every step is an aggregation or a join on the node, so a hub costs
    partial minima and a split join, no group.
    """
    both = parked(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = parked(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")))
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        spread = labels.join(seen, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        # The label's label: roots are nodes themselves.
        own = spread.select(F.col("node").alias("root"), F.col("root").alias("further"))
        named = spread.join(own, "root").select("node", F.least("root", "further").alias("root"), F.expr("least(root, further) <> old AS moved"))
        nearer = parked(named)
        released(labels)
        labels = nearer
        if labels.where("moved").isEmpty():
            released(both)
            return labels
