"""Health of boards: an ordered fold over their runs, and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAILURES, EMPTIES, QUIET_DAYS = 2, 2, 60


def status(n_rows: Column, failed: Column) -> Column:
    return F.when(failed, "FAIL").when(n_rows > 0, "OK").otherwise("EMPTY")


def fold(observations: DataFrame) -> DataFrame:
    """observations(source_key, run_at, status, n_rows, new_count, cutoff, newest) to one row a board.

    Failures in a row end at any success; empty runs end at OK and are held over failures. What the last
    run that wasn't a failure saw (rows, new ones) carries on over failures, and so do the last known
    cutoff and newest posting; last_success is the last OK. Runs of one time are ordered by status.
    """
    order = Window.partitionBy("source_key").orderBy("run_at", "status")
    obs = observations.withColumn("_n", F.row_number().over(order))
    fail, ok, empty = (F.col("status") == s for s in ("FAIL", "OK", "EMPTY"))
    good = F.when(~fail, F.col("_n"))
    out = obs.groupBy("source_key").agg(
        F.count("*").alias("runs"), F.max("_n").alias("_last"), F.max(good).alias("_good"), F.max(F.when(ok, F.col("_n"))).alias("_ok"),
        F.max_by("status", "_n").alias("status"), F.max_by("n_rows", good).alias("n_rows"), F.max_by("new_count", good).alias("new_count"),
        F.max_by("cutoff", F.when(F.col("cutoff").isNotNull(), good)).alias("cutoff"),
        F.max_by("newest", F.when(F.col("newest").isNotNull(), F.col("_n"))).alias("newest"), F.max(F.when(ok, F.col("run_at"))).alias("last_success"),
    )
    since = obs.join(out.select("source_key", F.coalesce("_ok", F.lit(0)).alias("_ok")), "source_key").where(F.col("_n") > F.col("_ok"))
    since = since.groupBy("source_key").agg(F.count_if(F.col("status") == "EMPTY").alias("empty_runs"))
    out = out.join(since, "source_key", "left")
    return out.select("source_key", "runs", "status", "n_rows", "new_count", "cutoff", "newest", "last_success", (F.col("_last") - F.coalesce("_good", F.lit(0))).cast("long").alias("failures"), F.coalesce("empty_runs", F.lit(0)).cast("long").alias("empty_runs"))


def alerts(boards: DataFrame, today: Column) -> DataFrame:
    """Adds ``alerts``: failing, empty, quiet.

    Quiet is a board whose list was read but whose newest posting is 60 days old. Where no date is known it
    is quiet only if a cutoff was applied, else the board gives no dates; with no rows read it never is.
    """
    aged = F.datediff(today, F.col("newest")) >= QUIET_DAYS
    quiet = (F.coalesce("n_rows", F.lit(0)) > 0) & F.coalesce(aged, F.col("cutoff").isNotNull())
    said = F.array(F.when(F.col("failures") >= FAILURES, "failing"), F.when(F.col("empty_runs") >= EMPTIES, "empty"), F.when(quiet, "quiet"))
    return boards.withColumn("alerts", F.filter(said, lambda x: x.isNotNull()))


def still_crawled(boards: DataFrame, config: DataFrame) -> DataFrame:
    """Boards without those that the configuration disables; a board that it doesn't know stays."""
    return boards.join(config.where(~F.col("enabled")).select("source_key").distinct(), "source_key", "left_anti")


def daily_window(runs: DataFrame, today: Column, most: int = 7) -> DataFrame:
    """One row: days to read back, from the last run that finished without a failure: elapsed + 1, from 1 to `most`."""
    good = runs.where("finished_at is not null and sources_failed = 0").agg(F.max("started_at").alias("last"))
    elapsed = F.datediff(today, F.col("last").cast("date"))
    days = F.when(F.col("last").isNull(), most).otherwise(F.greatest(F.lit(1), F.least(F.lit(most), elapsed + 1)))
    return good.select("last", days.cast("int").alias("days"), F.coalesce(elapsed + 1 > most, F.lit(False)).alias("gap"))


def pending_work(rows: DataFrame, drafts: DataFrame, most: int = 3) -> DataFrame:
    """One row of counts: to structure, given up, to review, approved but not published."""
    a = rows.agg(F.count_if(F.col("structured_at").isNull() & (F.col("structure_attempts") < most)).alias("unstructured"),
                 F.count_if(F.col("structured_at").isNull() & (F.col("structure_attempts") >= most)).alias("given_up"))
    b = drafts.agg(F.count_if(F.col("review_status") == "PENDING").alias("to_review"), F.count_if((F.col("review_status") == "APPROVED") & F.col("published_job_id").isNull()).alias("unpublished"))
    return a.join(F.broadcast(b))  # one row each
