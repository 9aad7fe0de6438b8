"""Connected components of an edge table by label spreading and jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(a, b) -> (node, component): the smallest node of each component.

    Each round takes the smallest label among a node and its neighbours, then
    the label of that label, so chains shrink by half and long paths need few
    rounds.  Labels are cut with ``checkpoint()``; nothing reaches the driver
    but the number of changed labels.
    """
    both = (edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            .filter("a <> b").distinct().checkpoint())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    labels = labels.select("node", F.least("node", "m").alias("component")).checkpoint()
    for _ in range(max_rounds):
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a")
                .agg(F.min("component").alias("m")))
        step = (labels.join(near, labels["node"] == near["a"])
                .select("node", F.col("component").alias("old"), F.least("component", "m").alias("c")))
        target = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        step = (step.join(target, step["c"] == target["_n"], "left")
                .select("node", "old", F.least("c", F.coalesce("_c", "c")).alias("component"))).checkpoint()
        labels = step.select("node", "component")
        if not step.filter("old <> component").limit(1).count():
            return labels
    raise RuntimeError(f"labels still change after {max_rounds} rounds")
