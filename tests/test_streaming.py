"""Streams against the batch operators."""

import datetime

from pyspark.sql import functions as F

from seatflow.operators import health
from seatflow.streaming import ledger as streams

T = datetime.datetime


def written(spark, tmp_path, parts, schema):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{i}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))


def test_ledger_stream(spark, tmp_path):
    schema = "source_key string, external_id string, title string"
    stream = written(spark, tmp_path, [[("A", "1", "x"), ("A", "1", "y"), ("A", "2", "x")], [("A", "2", "z"), ("B", "2", "x")], [("B", "2", "q")]], schema)
    for _ in range(2):  # a second start finds nothing new
        q = streams.start_ledger(stream, str(tmp_path / "ledger"), str(tmp_path / "cp"))
        q.awaitTermination(120)
        assert q.exception() is None
    got = sorted((r["source_key"], r["external_id"]) for r in spark.read.parquet(str(tmp_path / "ledger")).collect())
    assert got == [("A", "1"), ("A", "2"), ("B", "2")]


def test_health_stream_is_the_batch_fold(spark, tmp_path):
    schema = "source_key string, run_at date, status string, n_rows long, new_count long, cutoff date, newest date"
    d = datetime.date
    rows = [(k, d(2026, 1, i), s, i, 2 * i, d(2025, 11, i) if i % 3 else None, d(2025, 12, i) if i % 2 else None) for k in "ab" for i, s in enumerate(["OK", "FAIL", "FAIL", "EMPTY", "EMPTY", "OK", "EMPTY", "FAIL"], 1)]
    stream = written(spark, tmp_path, [rows[:3], rows[3:8], rows[8:]], schema)
    q = streams.health(stream).writeStream.outputMode("update").format("memory").queryName("health_now").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert q.exception() is None
    last = spark.table("health_now").groupBy("source_key").agg(F.max_by(F.struct("status", "n_rows", "new_count", "cutoff", "newest", "last_success", "failures", "empty_runs"), "runs").alias("r")).collect()
    want = {r["source_key"]: tuple(r[c] for c in ("status", "n_rows", "new_count", "cutoff", "newest", "last_success", "failures", "empty_runs")) for r in health.fold(spark.createDataFrame(rows, schema)).collect()}
    assert {r["source_key"]: tuple(r["r"]) for r in last} == want


def test_watermarked_streams(spark, tmp_path):
    schema = "source_key string, external_id string, fetched_at timestamp, posted_at timestamp"
    rows = [("A", "1", T(2026, 1, 1, 8), T(2026, 1, 1, 7)), ("A", "1", T(2026, 1, 1, 9), T(2026, 1, 1, 7)), ("A", "2", T(2026, 1, 1, 9), T(2026, 1, 1, 7)), ("B", "1", T(2026, 1, 20), T(2026, 1, 20))]
    stream = written(spark, tmp_path, [rows], schema)
    for name, frame, mode in (("fresh", streams.new_postings(stream), "append"), ("days", streams.arrivals(stream), "append")):
        q = frame.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(180)
        assert q.exception() is None
    assert {(r["source_key"], r["external_id"]) for r in spark.table("fresh").collect()} == {("A", "1"), ("A", "2"), ("B", "1")}
    assert [(r["source_key"], r["n"]) for r in spark.table("days").collect()] == [("A", 3)]
