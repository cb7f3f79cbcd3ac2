"""Connected components of a table of links, by Spark joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .exchange import staged


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of whole numbers, undirected, to (node, label): the smallest node that each can reach.

    Every round each node takes the smallest label among its neighbours' and its
    own, then the label that its label has (pointer jumping), so that the number
    of rounds follows the logarithm of the longest chain rather than its length.
    Each round is a written table; nothing is gathered on the driver but one flag.
    """
    both = staged(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct(), "links")
    labels = staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = staged(step.join(jump, "label").select("node", "old", F.least("label", "further").alias("label")), "labels")
        labels = step.select("node", "label")
        if step.where("old != label").isEmpty():
            return labels
