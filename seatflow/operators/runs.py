"""Runs: opened, closed, summed up, and whether a person is needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEAD_HOURS = 3
ABORTED = "_aborted"


def current(events: DataFrame) -> DataFrame:
    """events(run_id, at, kind open|close, mode, sources_ok, sources_failed, new_count) to one row a run; a close without an open is an error row."""
    opened, closed = F.col("kind") == "open", F.col("kind") == "close"
    last = lambda c: F.max_by(c, F.when(closed, F.col("at"))).alias(c)
    out = events.groupBy("run_id").agg(F.min(F.when(opened, F.col("at"))).alias("started_at"), F.max(F.when(closed, F.col("at"))).alias("finished_at"), F.max("mode").alias("mode"), last("sources_ok"), last("sources_failed"), last("new_count"))
    return out.withColumn("error", F.when(F.col("started_at").isNull(), "closed but never opened").when(F.col("finished_at") < F.col("started_at"), "finished before it started"))


def recent(runs: DataFrame, n: int) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)


def is_dead(started_at: Column, finished_at: Column, now: Column) -> Column:
    return finished_at.isNull() & (started_at < now - F.expr(f"interval {DEAD_HOURS} hours"))


def summary(boards: DataFrame) -> DataFrame:
    """boards(run_id, source_key, saved, error) to a run's counts and its errors by board; an aborted run's own entry is no board."""
    own = F.col("source_key") == ABORTED
    return boards.groupBy("run_id").agg(
        F.count_if(F.col("error").isNull() & ~own).alias("sources_ok"), F.count_if(F.col("error").isNotNull() & ~own).alias("sources_failed"),
        F.coalesce(F.sum(F.when(F.col("error").isNull(), F.col("saved"))), F.lit(0)).alias("new_count"),
        F.map_from_entries(F.array_sort(F.collect_set(F.when(F.col("error").isNotNull(), F.struct("source_key", "error"))))).alias("error_detail"),
    )


def needs_a_person(runs: DataFrame, boards: DataFrame, pending: DataFrame, now: Column) -> DataFrame:
    """One row: a dead run, a board with an alert, rows given up, or approved rows left unpublished."""
    a = runs.agg(F.count_if(is_dead(F.col("started_at"), F.col("finished_at"), now)).alias("dead_runs"))
    b = boards.agg(F.count_if(F.size("alerts") > 0).alias("alerted_boards"))
    out = a.join(F.broadcast(b)).join(F.broadcast(pending.select("given_up", "unpublished")))  # one row each
    return out.withColumn("needed", (F.col("dead_runs") > 0) | (F.col("alerted_boards") > 0) | (F.col("given_up") > 0) | (F.col("unpublished") > 0))
