"""Queries on queues, budgets, targets and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.functions import dates as D
from seatflow.operators import dedup, drafts, health, ledger, publish
from seatflow.plans.collecting import FOLD, folded
from seatflow.plans.registry import VIEWS, day, query, table
from seatflow.plans.seats import SEATED
from seatflow.plans.seats import drafts as seat_drafts

VIEWS["judged_draft"] = """
    SELECT id, posted_on, church_name, region, mailbox, address, confidence, reject_reason, published_job_id, gone_at, CASE WHEN reject_reason IS NOT NULL THEN 'REJECTED' WHEN confidence = 'high' THEN 'APPROVED' ELSE 'PENDING' END AS review_status,
        CASE WHEN id % 5 <> 2 THEN 'ALONE' END AS dedup_state FROM {draft}"""
VIEWS["board_date"] = """
    SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS on_day, CASE o_orderkey % 6 WHEN 0 THEN concat(replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '.'), '.') WHEN 1 THEN replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '')
            WHEN 2 THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 10:20:30') WHEN 3 THEN replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '/') WHEN 4 THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS text,
        CASE WHEN o_orderkey % 3 = 0 THEN 'https://h/files/poster.png' ELSE concat('https://h/files/', replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', ''), '_7.png') END AS path FROM {orders}"""


@query("""SELECT id, CASE WHEN id % 6 <> 4 THEN on_day END AS written, CASE WHEN id % 3 <> 0 THEN on_day END AS uploaded FROM {board_date}""")
def board_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "board_date").select("id", D.board_date(F.col("text")).alias("written"), D.date_in_path(F.col("path")).alias("uploaded"))


@query("""SELECT id, posted_on FROM {judged_draft} WHERE review_status = 'PENDING' ORDER BY posted_on, id""")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drafts.review_queue(table(spark, sf_dir, "judged_draft")).select("id", "posted_on")


@query("""WITH v AS (SELECT id, posted_on, CASE id % 5 WHEN 0 THEN 'EMPTY' WHEN 1 THEN 'DEFERRED' WHEN 2 THEN 'FAILED' ELSE 'DRAFTED' END AS verdict FROM {raw}),
    paid AS (SELECT * FROM v WHERE verdict NOT IN ('EMPTY', 'DEFERRED') ORDER BY posted_on, id LIMIT 100) SELECT id, verdict FROM v WHERE verdict IN ('EMPTY', 'DEFERRED') UNION ALL SELECT id, verdict FROM paid""")
def judged_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("id") % 5
    rows = table(spark, sf_dir, "raw").withColumn("verdict", F.when(n == 0, "EMPTY").when(n == 1, "DEFERRED").when(n == 2, "FAILED").otherwise("DRAFTED"))
    return drafts.within_budget(rows, 100).select("id", "verdict")


@query("""SELECT 'review_status' AS what, review_status AS value, count(*) AS n FROM {judged_draft} GROUP BY ALL UNION ALL SELECT 'confidence', confidence, count(*) FROM {judged_draft} GROUP BY ALL
    UNION ALL SELECT 'reject_reason', reject_reason, count(*) FROM {judged_draft} WHERE reject_reason IS NOT NULL GROUP BY ALL""")
def draft_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drafts.report(table(spark, sf_dir, "judged_draft"))


@query(f"""WITH {SEATED}, s AS (SELECT church IS NOT NULL AND region IS NOT NULL AS seat, coalesce(reject_reason, '') = 'HERESY' OR gone_at IS NOT NULL AS done FROM seated)
    SELECT count(*) FILTER (WHERE seat AND NOT done) AS judged, count(*) FILTER (WHERE NOT seat AND NOT done) AS unjudged, count(*) FILTER (WHERE done) AS settled FROM s""")
def dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.counts(seat_drafts(spark, sf_dir))


@query("""WITH w AS (SELECT *, region IS NOT NULL AND coalesce(mailbox, address) IS NOT NULL AS whole FROM {judged_draft} WHERE review_status = 'APPROVED' AND published_job_id IS NULL)
    SELECT count(*) FILTER (WHERE dedup_state IS NOT NULL AND whole) AS publishable, count(*) FILTER (WHERE dedup_state IS NOT NULL AND NOT whole) AS incomplete, count(*) FILTER (WHERE dedup_state IS NULL) AS unjudged FROM w""")
def publish_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    rows = table(spark, sf_dir, "judged_draft").withColumns({"title": F.col("church_name"), "contact_email": F.col("mailbox"), "contact_phone": none, "contact_link": none, "contact_post": F.col("address")})
    return publish.counts(rows)


@query("""SELECT r.id, r.source_key, r.external_id, r.posted_on FROM {raw} r JOIN {judged_draft} d ON r.id = d.id WHERE r.posted_on >= DATE '1998-01-01' AND d.gone_at IS NULL AND (d.published_job_id IS NOT NULL OR d.review_status = 'PENDING')""")
def gone_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.gone_targets(table(spark, sf_dir, "raw"), table(spark, sf_dir, "judged_draft"), day("1998-01-01"))


@query("""SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN 'gone' WHEN 1 THEN 'alive' ELSE 'unknown' END AS probe, event_id % 5 <> 0 AND event_id % 3 <> 0 AS alive FROM {events}""")
def gone_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    code = F.when(n % 4 == 0, "42004").when(n % 4 == 1, "10000").otherwise("1")
    body = F.when(n % 4 == 3, F.lit("<html>")).otherwise(F.concat(F.lit('{"code": '), code, F.lit("}")))
    none = F.array().cast("array<string>")
    text, images = F.when(n % 3 == 1, F.col("event_type")).otherwise(F.lit(" ")), F.when(n % 3 == 2, F.array("event_type")).otherwise(none)
    return table(spark, sf_dir, "events").select(n.alias("id"), publish.probed(body).alias("probe"), publish.detail_alive(text, images, none, F.when(n % 5 == 0, F.lit("timeout"))).alias("alive"))


@query(f"WITH {FOLD} SELECT source_key, status FROM folded WHERE source_key % 4 <> 1")
def boards_still_crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boards that a configuration disables are left out; those that it doesn't list stay."""
    config = table(spark, sf_dir, "observation").select("source_key").distinct().where("source_key % 4 < 3").withColumn("enabled", F.col("source_key") % 4 != 1)
    return health.still_crawled(folded(spark, sf_dir), config).select("source_key", "status")


@query("""WITH n AS (SELECT source_key, row_number() OVER (PARTITION BY source_key, external_id ORDER BY page, pos) AS n FROM {listing}) SELECT source_key, count(*) FILTER (WHERE n > 1) AS shifted FROM n GROUP BY source_key""")
def collect_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.shifted(table(spark, sf_dir, "listing"))


@query("""SELECT id, CAST(least(CASE WHEN id % 2 = 0 THEN 40 END, CASE WHEN id % 3 <> 0 THEN id % 150 END, 100) AS BIGINT) AS pages, CASE WHEN id % 4 <> 0 THEN CAST(posted_on - INTERVAL 2 MONTH AS DATE) END AS cutoff, posted_on - 14 AS fortnight FROM {raw}""")
def reading_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, on = F.col("id"), F.col("posted_on")
    pages = ledger.page_limit(F.when(n % 2 == 0, F.lit(40)), F.when(n % 3 != 0, n % 150))
    return table(spark, sf_dir, "raw").select("id", pages.cast("long").alias("pages"), D.cutoff(on, months=2, has_dates=n % 4 != 0).alias("cutoff"), D.cutoff(on, days=14).alias("fortnight"))
