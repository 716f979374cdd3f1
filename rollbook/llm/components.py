"""Connected components of a graph whose edges are rows, however large or uneven."""

from pyspark.sql import functions as F

from .tables import written


def components(edges, known=None):
    """(node, component) for each node of ``edges`` (columns a, b: numbers), component being the
    smallest node reachable. ``known`` may hold such rows for a part of the edges.

    Every round takes the smallest label among the neighbours and then the label's own label, so
    chains halve; a star or a clique is done in two rounds. It ends once no label changes: labels only fall. Each round is a written table. A hub is
    a hot key of joins and of combined aggregates only.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other")
    start = both.groupBy("node").agg(F.min("other").alias("component"))
    start = start.select("node", F.least("node", "component").alias("component"))
    if known is not None:
        old = known.withColumnRenamed("component", "before")
        start = start.join(old, "node", "full_outer").select(
            "node", F.least("component", "before").alias("component")
        )
    labels = written(start, "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "other"), "other")
            .groupBy("node")
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node", "left").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("label")
        )
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = lower.join(up, "label", "left").select(
            "node", F.least("label", "above").alias("component"), "before"
        )
        step = written(jumped, "labels")
        labels = step.select("node", "component")
        if step.filter(F.col("before") != F.col("component")).isEmpty():
            return labels
