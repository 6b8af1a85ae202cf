"""Connected components of a table of links, as Spark joins. No link or label reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b); the label is the least node of its component.

    Every node points at a smaller or equal one. A round gives each node, and the node it points at, the least label
    seen at a neighbour, and then the label of that label. So whole trees are hooked together, not single
    nodes: chains settle in a number of rounds that follows the logarithm of their length (2,000 links in 13). There
    is no other end than that nothing changes, which must come, as labels only fall. Rounds are written tables.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "edges")
    first = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("up")), "labels")
    labels = materialize(_jump(first).withColumn("moved", F.lit(True)), "labels")
    while not labels.filter("moved").isEmpty():
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = materialize(labels.join(near, "node").select("node", "up", "label", "near"), "labels")
        # What any node sees goes to the node it points at as well.
        hooks = step.groupBy(F.col("up").alias("node")).agg(F.min("near").alias("hook"))
        after = step.join(hooks, "node", "left").select("node", F.col("up").alias("old_up"), F.col("label").alias("old"), F.least("label", "near", "hook").alias("up"))
        after = materialize(after, "labels")
        moved = (F.col("old_up") != F.col("up")) | (F.col("old") != F.col("label"))
        labels = materialize(_jump(after).select("node", "up", "label", moved.alias("moved")), "labels")
    return labels.select("node", "label")


def _jump(table: DataFrame) -> DataFrame:
    """``table`` (node, up, ...) with ``label``: what the node above points at."""
    above = table.select(F.col("node").alias("up"), F.col("up").alias("label"))
    return table.join(above, "up")
