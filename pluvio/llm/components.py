"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pluvio.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of (a, b) links: the smallest node it is connected with.

    Each turn a node takes the smallest label among its neighbours and then that label's own label, so the
    distance covered doubles. Turns end when no label changes; each is written to the shared folder.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("next"))
        nearer = stored(nearer, "labels")
        own = nearer.select(F.col("node").alias("_node"), F.col("next").alias("_label"))
        jumped = nearer.join(own, nearer["next"] == own["_node"], "left")
        turn = stored(jumped.select("node", "label", F.least("next", F.coalesce("_label", "next")).alias("next")), "labels")
        labels = turn.select("node", F.col("next").alias("label"))
        if turn.filter("label <> next").isEmpty():
            return labels
