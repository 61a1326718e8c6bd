"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.session import Staging

#: More rounds than any graph needs whose labels move at least two steps a round.
MOST_ROUNDS = 200


def components(staging: Staging, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b bigint); root is the smallest node it reaches.

    Each round a node takes the smallest label among itself and its neighbours, and then the
    label of that label; labels are written to the shared folder after each round. Minima are
    combined before they are shuffled, so a node with very many edges is no bottleneck.
    No edges: no rows.
    """
    both = staging.keep(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = staging.keep(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    for _ in range(MOST_ROUNDS):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near"))
        old = labels.select(F.col("node").alias("a"), F.col("root").alias("own"))
        lower = old.join(near, "a").select("a", "own", F.least("own", "near").alias("low"))
        jump = labels.select(F.col("node").alias("via"), F.col("root").alias("far"))
        moved = lower.join(jump, lower["low"] == jump["via"], "left").select(
            F.col("a").alias("node"), F.least("low", F.coalesce("far", "low")).alias("root"), "own"
        )
        moved = staging.keep(moved, "labels")
        labels = moved.select("node", "root")
        if moved.filter("root < own").isEmpty():
            return labels
    raise RuntimeError("labels still move")
