"""Connected components for key merges."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def checkpointed(frame: DataFrame) -> DataFrame:
    """A reliable checkpoint in the cluster's shared folder, as spark.checkpoint.dir names it.

    Only in local mode, where one process does all, a folder of our own takes its place if it is unset.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = frame.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="seatflow-"))
    return frame.checkpoint()


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) to (node, root): the smallest node that each node reaches, by labels and labels' labels."""
    both = checkpointed(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root"))
    labels = checkpointed(labels)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        far = lower.select(F.col("node").alias("root"), F.col("root").alias("far"))
        lower = checkpointed(lower.join(far, "root").select("node", "old", F.col("far").alias("root")))
        if lower.where("old <> root").isEmpty():
            return lower.select("node", "root")
        labels = lower.select("node", "root")
