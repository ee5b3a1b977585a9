"""The ledger and the health of boards over streams.

New postings come through a bounded key state with a watermark, or batch by batch against the whole
ledger; the batch operators are the measure of both.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from seatflow.operators import ledger


def new_postings(stream: DataFrame, seen_at: str = "fetched_at", lateness: str = "7 days") -> DataFrame:
    """Each key once, by state that ends `lateness` after it was seen: the daily look-back of at most seven days."""
    return stream.withWatermark(seen_at, lateness).dropDuplicatesWithinWatermark(ledger.KEY)


#: Parts of the ledger by the hash of the key.
SHARDS = 64


def start_ledger(stream: DataFrame, ledger_path: str, checkpoint: str, **options: str) -> StreamingQuery:
    """Appends each batch's new keys to the ledger, which lies in SHARDS parts by the hash of the key.

    A batch reads only the parts that its keys fall in (at most SHARDS numbers come to the driver). A batch
    that is run again finds its own rows by their batch number and replaces them.
    """
    shard = F.pmod(F.xxhash64(*ledger.KEY), F.lit(SHARDS)).cast("int")

    def append(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("shard", shard)
        path = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
        known = batch.select(*ledger.KEY).limit(0)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            met = [r["shard"] for r in batch.select("shard").distinct().collect()]
            schema = batch.schema.add("batch", "long")
            known = spark.read.schema(schema).parquet(ledger_path).where((F.col("batch") != number) & F.col("shard").isin(met))
        ledger.new_postings(batch, known).write.mode("overwrite").partitionBy("shard").parquet(f"{ledger_path.rstrip('/')}/batch={number}")

    writer = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    for key, value in options.items():
        writer = writer.option(key, value)
    return writer.trigger(availableNow=True).start()


def arrivals(stream: DataFrame, window: str = "1 day", lateness: str = "7 days") -> DataFrame:
    """Rows by board and day of posting; a day closes once it is past the lateness."""
    return stream.withWatermark("posted_at", lateness).groupBy("source_key", F.window("posted_at", window)).agg(F.count("*").alias("n")).select("source_key", F.col("window.start").alias("day"), "n")


SEEN = "runs long, status string, n_rows long, new_count long, cutoff date, newest date, last_success date, failures long, empty_runs long"


def health(stream: DataFrame) -> DataFrame:
    """The fold of operators.health over a stream of (source_key, run_at, status, n_rows, new_count, cutoff, newest), one state a board."""

    def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        runs, status, n_rows, fresh, cutoff, newest, last, failures, empties = state.get if state.exists else (0, None, None, None, None, None, None, 0, 0)
        rows = pd.concat(list(parts)).sort_values(["run_at", "status"])  # of one board in one batch
        for at, status, n, many, since, new in rows[["run_at", "status", "n_rows", "new_count", "cutoff", "newest"]].itertuples(index=False):
            runs += 1
            failures = failures + 1 if status == "FAIL" else 0
            empties = 0 if status == "OK" else empties + (status == "EMPTY")
            if status != "FAIL":
                n_rows, fresh = int(n), int(many)
                cutoff = cutoff if pd.isna(since) else since
            newest = newest if pd.isna(new) else new
            last = at if status == "OK" else last
        told = (runs, status, n_rows, fresh, cutoff, newest, last, failures, empties)
        state.update(told)
        yield pd.DataFrame([(key[0], *told)], columns=["source_key", *[x.split()[0] for x in SEEN.split(", ")]])

    return stream.groupBy("source_key").applyInPandasWithState(fold, f"source_key string, {SEEN}", SEEN, "update", GroupStateTimeout.NoTimeout)
