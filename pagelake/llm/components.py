"""Connected components of written edges, by labels that shrink along links and jump."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.stage import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge (a, b); the label is the smallest node of its component.

    Each round takes the smallest label next to a node, then the label of that label, so stars end
    after two rounds and chains after about the logarithm of their length.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lowered = labels.join(near, "node").select("node", F.least("label", "near").alias("low"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("beyond"))
        # A label is a node of the component, and so has a label itself.
        moved = lowered.join(jump, "low").select("node", "old", F.least("low", "beyond").alias("label"))
        moved = written(moved, "labels")
        changed = moved.where("label <> old").limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels
