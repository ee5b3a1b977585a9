"""Connected components of an undirected graph by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatflow.llm.common import checkpoint


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b) to (node, root): root is the smallest node that can be reached; nodes without edges don't appear.

    Each round takes the smallest label of the neighbours and then the label of the label, so a
    chain's length at least halves; every round ends in a reliable checkpoint. Loops are ignored,
    repeated edges do no harm, and an empty frame gives an empty one.
    """
    both = edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct()
    both = checkpoint(both)
    labels = checkpoint(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("far"))
        lower = checkpoint(lower.join(jump, "root").select("node", "old", F.col("far").alias("root")))
        if lower.where("old <> root").isEmpty():
            return lower.select("node", "root")
        labels = lower.select("node", "root")
