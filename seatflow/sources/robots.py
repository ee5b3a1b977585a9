"""Crawl delays from robots texts, as SQL functions: a line is a row, groups come from running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def crawl_delays(robots: DataFrame, user_agent: str) -> DataFrame:
    """robots(host, body) to (host, delay): the greatest delay of groups that name us, else of those for all.

    A group begins at a user-agent line after any other line; blank lines end it. Windows are by host.
    """
    lines = robots.select("host", F.posexplode(F.split(F.coalesce("body", F.lit("")), r"\r?\n")).alias("n", "line"))
    lines = lines.withColumn("line", F.trim(F.regexp_replace("line", "#.*$", "")))
    lines = lines.withColumns({"key": F.lower(F.trim(F.substring_index("line", ":", 1))), "value": F.trim(F.regexp_replace("line", r"^[^:]*:?", ""))})
    order = Window.partitionBy("host").orderBy("n")
    agent = F.col("key") == "user-agent"
    opens = (agent & ~F.coalesce(F.lag(F.col("key") == "user-agent").over(order), F.lit(False))) | (F.col("line") == "")
    grouped = lines.withColumn("group", F.sum(F.when(opens, 1).otherwise(0)).over(order))
    groups = grouped.groupBy("host", "group").agg(
        F.collect_set(F.when(agent, F.lower("value"))).alias("agents"), F.max(F.when(F.col("key") == "crawl-delay", F.col("value").try_cast("double"))).alias("delay"))
    named = F.exists("agents", lambda a: (a != "*") & (a != "") & F.contains(F.lit(user_agent.lower()), a))
    out = groups.where("delay is not null").groupBy("host").agg(F.max(F.when(named, F.col("delay"))).alias("own"), F.max(F.when(F.array_contains("agents", "*"), F.col("delay"))).alias("all"))
    return out.select("host", F.coalesce("own", "all").alias("delay")).where("delay is not null")
