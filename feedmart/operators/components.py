"""Connected components of an undirected graph given as edges, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmart.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node of its component) of every node of ``edges`` (columns ``a, b``).

    Each round a node takes the smallest label among its neighbours' and its own, then that label's label, so long chains
    shrink by half. A node with many neighbours is pre-aggregated by the minimum. Labels are written after each round."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = materialise(both, "component-edges")
    labels = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "component-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        hooked = labels.withColumnRenamed("component", "old").join(near, "node").withColumn("component", F.least("old", "near"))
        higher = labels.select(F.col("node").alias("component"), F.col("component").alias("higher"))
        new = hooked.join(higher, "component", "left").select("node", "old", F.coalesce("higher", "component").alias("component"))
        new = materialise(new, "component-labels")
        labels = new.select("node", "component")
        if new.where("old <> component").isEmpty():
            return labels


__all__ = ["components"]
