"""Connected components of links, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.storage import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links` (a, b): the least node that it is connected to.

    Each round takes the least label among a node's neighbours and then that label's own label, so
    labels run along chains in doubling steps. Nothing but the number of changes reaches the driver.
    Both sides of every join are written tables, so that adaptive execution can split a hot node.
    """
    edges = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = stored(
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label")),
        "labels",
    )
    while True:
        near = stored(
            edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("label").alias("near")), "near-labels"
        )
        moved = stored(
            labels.join(near, labels.node == near.a).select("node", F.least("label", "near").alias("label"), F.col("label").alias("was")),
            "moved-labels",
        )
        target = moved.select(F.col("node").alias("of"), F.col("label").alias("further"))
        labels = stored(
            moved.join(target, F.col("label") == F.col("of"), "left").select(
                "node", F.least("label", F.coalesce("further", "label")).alias("label"), "was"
            ),
            "labels",
        )
        if labels.filter("label <> was").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
