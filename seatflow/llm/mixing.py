"""Mixing sources to target weights by systematic sampling, with DataFrame operations only.

A source's documents are put in an order by size; each adds its expected copies to a running sum that
starts at one random offset, and is emitted once for each integer that the sum crosses. In this order
neighbours are alike in size, so the words taken come near the target. The running sum is made
from counts: documents are dealt to buckets (source, size class, hash of the id), the buckets' counts
give each bucket's start, and only rows of one bucket are ranked together; a hot source spreads over
all its buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORDS = r"[^\x20\x09-\x0D]+"
#: Buckets by hash of the id within a size class.
SUBS = 256


def sizes(texts: str = "text"):  # noqa: ANN201
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(texts), F.lit(WORDS)), F.lit(0)).cast("long")


def targets(totals: DataFrame, most: float = 3.0) -> DataFrame:
    """(source, source_size) to the same with ``weight`` and ``target``.

    Sources by code point, null last, weigh 1, 2, 3, repeating. They share all words by weight; no
    target exceeds `most` times its source's size, and what is over is shared again by weight until
    none exceeds. That ends at one level, target = min(most * size, level * weight): with sources in
    the order of most * size / weight, those before some place are full and the rest share what is
    left. These windows hold one row a source in one task: the list of sources must be one that a task
    can sort, not the documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    t = totals.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))
    full = Window.orderBy("filled_at", F.col("source").asc_nulls_last())
    t = t.withColumn("ceiling", F.col("source_size") * F.lit(float(most))).withColumn("filled_at", F.col("ceiling") / F.col("weight"))
    every = Window.partitionBy()
    t = t.withColumns({
        "left": F.sum("source_size").over(every) - F.coalesce(F.sum("ceiling").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "weights": F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing)),
    })
    # the level if all before this place are full; it holds at the first place that it doesn't overfill
    t = t.withColumn("level", F.col("left") / F.col("weights"))
    t = t.withColumn("level", F.min(F.when(F.col("level") <= F.col("filled_at"), F.struct("filled_at", "level"))).over(every)["level"])
    return t.select(*totals.columns, "weight", F.coalesce(F.least("ceiling", F.col("level") * F.col("weight")), F.col("ceiling")).alias("target"))


def mixed_copies(documents: DataFrame, size_col: str = "size", id_col: str = "doc_id", source_col: str = "source", seed: int = 42, most: float = 3.0) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``copies`` to rows that have a size in words.

    copies is 0 to `most`; a source's copies times sizes come near its target. The same rows give
    the same copies whatever their order or partitions: rows are ranked by size, id and nothing
    else, so rows alike in both may swap. A null id hashes as empty, a null source is a source of its
    own, and a source without words takes nothing. All other columns are kept.
    """
    sub = F.conv(F.substring(F.md5(F.coalesce(F.col("_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long") % SUBS
    rows = documents.withColumns({
        "_size": F.coalesce(F.col(size_col), F.lit(0)).cast("long"), "_id": F.col(id_col),
        "_source": F.coalesce(F.col(source_col), F.lit("")), "_none": F.col(source_col).isNull(),
    })
    # a size class: the number of bits and the upper four of them
    rows = rows.withColumns({"_class": F.expr("length(bin(_size)) * 16L + shiftright(_size, greatest(length(bin(_size)) - 4, 0))"), "_sub": sub})
    bucket = ["_source", "_none", "_class", "_sub"]
    counts = rows.groupBy(*bucket).agg(F.count("*").alias("_n"), F.sum("_size").alias("_words"))
    totals = counts.groupBy("_source", "_none").agg(F.sum("_words").alias("source_size"))
    plan = targets(totals.select("*", F.when(~F.col("_none"), F.col("_source")).alias("source")), most)
    before = Window.partitionBy("_source", "_none").orderBy("_class", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n", "_words")
    starts = starts.join(plan.select("_source", "_none", F.col("source_size").alias("_total"), F.col("target").alias("_target")), ["_source", "_none"])
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*bucket).orderBy("_size", "_id")))
    out = ranked.join(starts, bucket)
    offset = F.conv(F.substring(F.md5(F.concat("_source", F.lit(f"/{seed}"))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    each = F.when(F.col("_total") > 0, F.col("_target") / F.col("_total")).otherwise(F.lit(0.0))
    at = F.col("_before") + F.col("_rank")
    crossed = F.floor(at * each + offset) - F.floor((at - 1) * each + offset)
    out = out.withColumn("_copies", F.greatest(F.lit(0), F.least(F.lit(int(most)), crossed)).cast("int"))
    added = {"source_size": "_total", "target": "_target", "copies": "_copies"}
    kept = [x for x in documents.columns if x not in added]  # these three are always the operator's own
    return out.select(*kept, *[F.col(v).alias(k) for k, v in added.items()])
