"""Connected components of an edge table, by spreading minima and jumping along them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.llm.tables import dropped, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); the component is its smallest node.

    Every round takes the smallest label among a node's neighbours (a partial aggregate, so
    a node with very many edges is no hot spot) and then the label of that label, which halves
    the way to the minimum. Labels are written each round; nothing but a flag reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct()
    both = written(both, "cc-edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = written(
        labels.select("node", F.least("node", "label").alias("label"), F.lit(True).alias("moved")),
        "cc-labels",
    )
    while labels.filter("moved").take(1):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b")
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        stepped = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        target = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = stepped.join(target, "label")
        best = F.least("label", "further")
        before = labels
        labels = written(
            jumped.select("node", best.alias("label"), (best < F.col("old")).alias("moved")),
            "cc-labels",
        )
        dropped(before)
    dropped(both)
    return labels.select("node", F.col("label").alias("component"))
