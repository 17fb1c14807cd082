"""Connected components of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def connected_components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``); ``label`` is the least
    node it reaches.

    Each round gives a node the least label among its neighbours' and its own, and
    then the label of that label, so long chains halve.  A node with very many
    links is pre-aggregated by the partial aggregate, and its join can be split.
    """
    both = saved(links.select("a", "b").union(links.select("b", "a")).distinct(), "cc-links")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "cc-labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near")))
        lower = (labels.join(near, labels.node == near.a)
                 .select("node", F.least("label", "near").alias("label"), F.col("label").alias("was")))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        stepped = (lower.join(jump, lower.label == jump.via, "left")
                   .select("node", F.least("label", F.coalesce("far", "label")).alias("label"), "was"))
        got = saved(stepped, "cc-round")
        labels = got.select("node", "label")
        if not got.filter("label <> was").limit(1).count():
            return labels
