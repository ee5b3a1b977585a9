"""Media of a posting: which to take, what they are by their first bytes, and where posters go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatflow.functions.urls import worth_fetching

MOST = 4
RECEIPTS = ["mail.receipts.example", "t.example.net"]
# First bytes in hex.
MAGIC = [("image/jpeg", "^FFD8FF"), ("image/png", "^89504E470D0A1A0A"), ("image/gif", "^47494638"), ("image/webp", "^52494646.{8}57454250"), ("application/pdf", "^25504446")]


def wanted(images: Column, attachments: Column, receipts: list[str] = RECEIPTS, most: int = MOST) -> Column:
    """At most four addresses, each once: inline images, then attached images, then documents."""
    named = lambda ends: F.transform(F.filter(attachments, lambda a: F.lower(a["name"]).rlike(ends)), lambda a: a["url"])
    every = F.concat(images, named(r"\.(jpe?g|png|gif|webp|bmp)$"), named(r"\.pdf$"))
    return F.slice(F.array_distinct(F.filter(every, lambda u: worth_fetching(u, receipts))), 1, most)


def sniffed(data: Column) -> Column:
    head, out = F.hex(F.substring(data, 1, 16)), F.lit(None).cast("string")
    for kind, pattern in MAGIC:
        out = F.when(head.rlike(pattern), kind).otherwise(out)
    return out


def poster_path(source_key: Column, row_id: Column, index: Column, extension: Column) -> Column:
    return F.concat_ws("/", source_key, row_id, F.concat_ws(".", index.cast("string"), extension))


def within_budget(media: DataFrame, most: int = 15_000_000) -> DataFrame:
    """media(id, pos, n_bytes): those of a row, in order, whose running sum stays within the budget."""
    total = F.sum("n_bytes").over(Window.partitionBy("id").orderBy("pos"))
    return media.withColumn("_total", total).where(F.col("_total") <= most).drop("_total")
