"""Connected components of a link table, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.materialize import settle


def connected_components(links: DataFrame, size: int | None = None) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label is its component's smallest node.

    Rounds of taking the smallest label among the neighbours and then the label of that label
    (pointer jumping), until no label changes; the number of rounds follows the logarithm of
    the longest shortest path. Minima are combined within tasks before they are shuffled, and
    every round is written to the checkpoint folder, so a lost executor costs one round at most.
    ``size`` is about how many links there are, if known; few links are written as few files.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settle(links.select(F.explode(ways).alias("way")).select("way.a", "way.b"), rows=size)
    size = both.count()  # nodes are no more
    first = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label"))
    labels = settle(first, rows=size)
    while True:
        near = both.join(labels, both["b"] == labels["node"]).select("a", "label")
        lower = (
            near.unionAll(labels.select(F.col("node").alias("a"), "label"))
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("low"))
        )
        lower = settle(lower.join(labels.withColumnRenamed("label", "old"), "node"), rows=size)
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("next"))
        jumped = settle(
            lower.join(jump, "low").select("node", F.col("next").alias("label"), "old"), rows=size
        )
        labels = jumped.select("node", "label")
        if not jumped.filter(F.col("label") != F.col("old")).head(1):
            return labels
