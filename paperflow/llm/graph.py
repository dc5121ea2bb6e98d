"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over edges (a, b), for every node that has an edge.

    Each round lowers every label to the lowest of the neighbours' labels and
    then to the label of that label, so chains shorten by half and stars end in
    two rounds. Labels stay in tables; only a count of changes reaches the
    driver. A hub's edges are reduced to a minimum before they are shuffled.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node")).agg(F.min("component").alias("lower"))
        lowered = stored(labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "lower").alias("component")), "labels")
        # only labels in use that are themselves labelled lower: few, so that a component of very many nodes need not be shuffled to them
        above = lowered.select("component").distinct().join(lowered.select(F.col("node").alias("component"), F.col("component").alias("jump")), "component").where("jump < component")
        new = stored(lowered.join(above, "component", "left").select("node", "old", F.coalesce("jump", "component").alias("component")), "labels")
        if new.where("old <> component").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")
