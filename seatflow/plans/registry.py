"""Registration of queries with their DuckDB SQL, and views that both engines derive from the given tables.

A view's SQL is of the dialect that both share and names its inputs in braces. Spark gets them as
frames; the oracle as common table expressions in front of the query.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

VIEWS = {
    # postings as read from boards
    "raw": """
        SELECT o_orderkey AS id, concat(replace(substr(o_orderpriority, 3), ' ', '_'), '_', CAST(o_custkey % 97 AS STRING)) AS source_key,
            CAST(o_orderkey AS STRING) AS external_id, CAST(o_orderdate AS DATE) AS posted_on,
            concat(CASE WHEN o_orderkey % 7 = 0 THEN '(끌어올림) ' ELSE '' END, 'posting ', CAST(o_orderkey AS STRING)) AS title,
            CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) + 1 END AS structured_at, CAST(o_orderkey % 4 AS INT) AS structure_attempts,
            o_custkey, o_orderstatus
        FROM {orders}""",
    # what the ledger held before; a thirteenth of the titles and half of those dates have changed since
    "ledger": """
        SELECT source_key, external_id, CASE WHEN id % 13 = 0 THEN concat(title, ' old') ELSE title END AS title,
            CASE WHEN id % 26 = 0 THEN posted_on + 1 ELSE posted_on END AS posted_on
        FROM {raw} WHERE posted_on < DATE '1999-01-01'""",
    # list pages of 20 rows, newest first; every 31st row shows up again on the next page
    "listing": """
        SELECT source_key, external_id, title, posted_on, id, CAST(floor((n - 1) / 20) AS INT) + 1 AS page, CAST((n - 1) % 20 AS INT) AS pos FROM
            (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY posted_on DESC, id) AS n FROM {raw}) t
        UNION ALL
        SELECT source_key, external_id, title, posted_on, id, CAST(floor((n - 1) / 20) AS INT) + 2 AS page, CAST((n - 1) % 20 AS INT) + 20 AS pos FROM
            (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY posted_on DESC, id) AS n FROM {raw}) t WHERE id % 31 = 0""",
    # drafts of openings: one row an order, churches by customer, regions by nation
    "draft": """
        SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS posted_on,
            concat(c_mktsegment, ' [x] ', CAST(c_custkey % 60 AS STRING), CASE WHEN c_custkey % 13 = 0 THEN ' annex' ELSE '' END) AS church_name,
            CASE WHEN o_orderkey % 50 <> 0 THEN n_name END AS region,
            CASE o_orderstatus WHEN 'P' THEN 'ETC' WHEN 'F' THEN 'ASSOCIATE_PASTOR' ELSE 'ASSOCIATE_PASTOR+EVANGELIST' END AS role_key,
            CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'YOUTH' ELSE 'CHILDREN' END AS department,
            CASE WHEN o_orderkey % 11 <> 0 THEN concat('m', CAST(c_custkey % 400 AS STRING), '@x.org') END AS mailbox,
            n_name AS city, CASE WHEN o_orderkey % 6 <> 0 THEN concat('road ', CAST(c_custkey % 90 AS STRING)) END AS address,
            CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS DATE) + 30 END AS deadline,
            CASE WHEN o_orderkey % 4 > 0 THEN 'high' ELSE 'medium' END AS confidence, o_orderkey % 97 = 0 AS is_owned,
            CASE WHEN o_orderkey % 40 = 0 THEN 'HERESY' WHEN o_orderkey % 41 = 0 THEN 'DUPLICATE' END AS reject_reason,
            CASE WHEN o_orderkey % 43 = 0 THEN CAST(o_orderdate AS DATE) + 60 END AS gone_at,
            CASE WHEN o_orderkey % 8 = 1 THEN o_orderkey + 1000000000 END AS published_job_id, o_custkey, o_totalprice, o_orderstatus
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
    "job": """
        SELECT o_orderkey + 1000000000 AS job_id, CAST(o_orderdate AS DATE) AS posted_at, CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS DATE) + 30 END AS deadline,
            CASE WHEN o_orderkey % 10 = 0 THEN 'CLOSED' ELSE 'OPEN' END AS status, CASE WHEN o_orderkey % 20 = 1 THEN o_custkey END AS church_id
        FROM {orders} WHERE o_orderkey % 17 <> 1""",
    # runs of a board (a user) a day
    "observation": """
        SELECT user_id AS source_key, CAST(ts AS DATE) AS run_at, count(*) FILTER (WHERE event_type IN ('click', 'view')) AS n_rows, count(*) FILTER (WHERE event_type = 'error') > 0 AS failed,
            count(*) FILTER (WHERE event_type = 'click') AS new_count, CASE WHEN user_id % 3 <> 0 THEN CAST(ts AS DATE) - 14 END AS cutoff,
            max(CASE WHEN event_type IN ('click', 'view') AND user_id % 5 <> 0 THEN CAST(ts AS DATE) - 3 END) AS newest
        FROM {events} GROUP BY user_id, CAST(ts AS DATE)""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a view derived from them."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    inputs = {n: table(spark, sf_dir, n) for n in sorted(set(re.findall(r"\{(\w+)\}", VIEWS[name])))}
    return spark.sql(VIEWS[name], **inputs)


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def oracle(sql: str) -> str:
    """The query with the views that it names in front."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\{(\w+)\}", text):
            if name in VIEWS and name not in order:
                need(VIEWS[name])
                order.append(name)

    need(sql)
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", text)
    views = ", ".join(f"{n} AS ({plain(VIEWS[n])})" for n in order)
    body = plain(sql).strip()
    if not views:
        return body
    return f"WITH RECURSIVE {views}, {body[len('WITH RECURSIVE '):] if body.startswith('WITH RECURSIVE ') else body[len('WITH '):]}" if body.startswith("WITH ") else f"WITH {views} {body}"


def query(sql: str | None = None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = oracle(sql)
        return f

    return register
