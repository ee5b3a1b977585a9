"""Queries on publication and disappearance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.operators import publish
from seatflow.plans.registry import day, query, table

TODAY = "2001-06-01"
OURS = "ours AS (SELECT DISTINCT published_job_id AS job_id FROM {draft} WHERE published_job_id IS NOT NULL)"


def _ours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "draft").where("published_job_id is not null").select(F.col("published_job_id").alias("job_id"))


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drafts whose group is their church and region; the newest of a group is its master."""
    out = table(spark, sf_dir, "draft").withColumn("dedup_key", F.concat_ws(":", "church_name", "region"))
    return out.withColumn("dedup_state", F.when(F.col("id") % 3 == 0, "ALONE").otherwise("MASTER"))


@query(f"""WITH {OURS} SELECT job_id, posted_at, deadline FROM {{job}} WHERE status = 'OPEN' AND CASE WHEN deadline IS NOT NULL THEN deadline >= DATE '2001-06-01' ELSE posted_at + 90 >= DATE '2001-06-01' END
    AND job_id NOT IN (SELECT job_id FROM ours)""")
def anchor_visibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.anchors(table(spark, sf_dir, "job"), _ours(spark, sf_dir), day(TODAY)).select("job_id", "posted_at", "deadline")


@query("""SELECT id, concat_ws(',', CASE WHEN region IS NULL THEN 'region' END, CASE WHEN mailbox IS NULL AND address IS NULL THEN 'contact' END) AS lacks
    FROM {draft} WHERE confidence = 'high' AND published_job_id IS NULL AND id % 5 <> 2""")
def publish_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    rows = table(spark, sf_dir, "draft").withColumns({
        "review_status": F.when(F.col("confidence") == "high", "APPROVED").otherwise("PENDING"), "dedup_state": F.when(F.col("id") % 5 != 2, "ALONE"), "title": F.col("church_name"),
        "contact_email": F.col("mailbox"), "contact_phone": none, "contact_link": none, "contact_post": F.col("address"),
    })
    return publish.candidates(rows).select("id", F.array_join("lacks", ",").alias("lacks"))


@query("""WITH linked AS (SELECT *, concat_ws(':', church_name, region) AS dedup_key FROM {draft}), newest AS (SELECT dedup_key, max(posted_on) AS newest FROM linked GROUP BY dedup_key)
    SELECT j.job_id, n.newest AS posted_at FROM linked l JOIN newest n USING (dedup_key) JOIN {job} j ON j.job_id = l.published_job_id WHERE l.id % 3 <> 0 AND j.church_id IS NULL AND n.newest > j.posted_at""")
def publish_bump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.bumps(_linked(spark, sf_dir), table(spark, sf_dir, "job"))


@query("""SELECT id, published_job_id FROM {draft} WHERE published_job_id IS NOT NULL AND published_job_id NOT IN (SELECT job_id FROM {job})""")
def publish_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.releases(_linked(spark, sf_dir), table(spark, sf_dir, "job"))


@query(f"""WITH {OURS} SELECT job_id FROM {{job}} WHERE status = 'OPEN' AND church_id IS NULL AND deadline < DATE '2001-06-01' AND job_id IN (SELECT job_id FROM ours)""")
def expired_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.expired(table(spark, sf_dir, "job"), _ours(spark, sf_dir), day(TODAY))


_NEXT = """linked AS (SELECT *, concat_ws(':', church_name, region) AS dedup_key FROM {draft}), newest AS (SELECT dedup_key, max(posted_on) AS newest FROM linked GROUP BY dedup_key),
    ready AS (SELECT id, id + 3000000000 AS job_id, posted_on AS posted_at, deadline FROM {draft} WHERE confidence = 'high' AND published_job_id IS NULL AND id % 5 <> 2 AND region IS NOT NULL AND coalesce(mailbox, address) IS NOT NULL),
    ours AS (SELECT published_job_id AS job_id, max(gone_at) AS gone_at FROM {draft} WHERE published_job_id IS NOT NULL GROUP BY published_job_id),
    later AS (SELECT j.job_id, max(n.newest) AS newest FROM linked l JOIN newest n USING (dedup_key) JOIN {job} j ON j.job_id = l.published_job_id WHERE l.id % 3 <> 0 AND j.church_id IS NULL AND n.newest > j.posted_at GROUP BY j.job_id)"""


def _published(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    none = F.lit(None).cast("string")
    rows = _linked(spark, sf_dir).withColumns({
        "review_status": F.when(F.col("confidence") == "high", "APPROVED").otherwise("PENDING"), "dedup_state": F.when(F.col("id") % 5 != 2, F.col("dedup_state")), "title": F.col("church_name"), "posted_at": F.col("posted_on"),
        "contact_email": F.col("mailbox"), "contact_phone": none, "contact_link": none, "contact_post": F.col("address"),
    })
    # of published drafts the pass judged all
    rows = rows.withColumn("dedup_state", F.when(F.col("published_job_id").isNotNull(), F.when(F.col("id") % 3 == 0, "ALONE").otherwise("MASTER")).otherwise(F.col("dedup_state")))
    return publish.applied(rows, table(spark, sf_dir, "job"), day("1996-01-01"), F.col("id") + 3_000_000_000)


@query(f"""WITH {_NEXT} SELECT j.job_id, coalesce(newest, j.posted_at) AS posted_at, j.deadline, church_id, CASE WHEN j.status = 'OPEN' AND church_id IS NULL AND ours.job_id IS NOT NULL AND (ours.gone_at IS NOT NULL OR j.deadline < DATE '1996-01-01')
        THEN 'CLOSED' ELSE j.status END AS status FROM {{job}} j LEFT JOIN later ON later.job_id = j.job_id LEFT JOIN ours ON ours.job_id = j.job_id
    UNION ALL SELECT job_id, posted_at, deadline, NULL, 'OPEN' FROM ready""")
def publication_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jobs after a pass: bumped, closed and new ones together."""
    return _published(spark, sf_dir)[1].select("job_id", "posted_at", "deadline", "church_id", "status")


@query(f"""WITH {_NEXT} SELECT d.id, CASE WHEN d.published_job_id IS NULL THEN ready.job_id WHEN d.published_job_id IN (SELECT job_id FROM {{job}}) THEN d.published_job_id END AS published_job_id FROM {{draft}} d LEFT JOIN ready ON ready.id = d.id""")
def publication_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All drafts' links after the same pass: made and taken back."""
    return _published(spark, sf_dir)[0].select("id", "published_job_id")


# targets of a sweep, what its list pages show, boards by how a posting can be asked after, and the answers of postings' own pages
_SWEEP = """targets AS (SELECT id, source_key, external_id FROM {raw} WHERE posted_on >= DATE '1998-01-01'),
    shown AS (SELECT source_key, external_id, page, pos FROM {listing} WHERE id % 25 <> 0 AND NOT (source_key LIKE 'LOW%' AND id % 2 = 0) AND source_key NOT LIKE '%_7'),
    listed AS (SELECT DISTINCT source_key, external_id FROM shown),
    boards AS (SELECT DISTINCT source_key, CASE WHEN source_key LIKE '%_13' THEN NULL WHEN source_key LIKE '%5' THEN 'interface' ELSE 'page' END AS check_by FROM {raw}),
    t AS (SELECT targets.*, l.source_key IS NOT NULL AS listed FROM targets LEFT JOIN listed l ON targets.source_key = l.source_key AND targets.external_id = l.external_id),
    b AS (SELECT source_key, count(*) AS n, count(*) FILTER (WHERE NOT listed) AS lost FROM t GROUP BY source_key),
    guards AS (SELECT b.source_key, check_by, lost, CASE WHEN check_by IS NULL THEN 'no second check' WHEN lost > 3 AND lost > 0.3 * n THEN 'bulk'
        WHEN b.source_key NOT IN (SELECT source_key FROM listed) THEN 'nothing listed' END AS guard FROM b JOIN boards ON b.source_key = boards.source_key)"""
_ANSWERS = """SELECT source_key, external_id, CASE WHEN id % 50 < 25 THEN '' WHEN id % 4 = 0 THEN ' ' ELSE title END AS text,
    CASE WHEN id % 100 = 25 OR id % 50 <> 0 AND id % 3 > 0 THEN array('a.png') ELSE array() END AS images, CASE WHEN id % 200 = 50 THEN array('a.pdf') END AS attachments,
    CASE WHEN id % 250 = 75 THEN 'timeout' END AS error, CASE WHEN id % 100 = 75 THEN concat(chr(123), '"code": 42004', chr(125)) WHEN id % 400 = 0 THEN 'not json' ELSE concat(chr(123), '"code": "10000"', chr(125)) END AS body FROM {raw} WHERE id % 1000 <> 500"""


def _sweep(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    raw = table(spark, sf_dir, "raw")
    listing = table(spark, sf_dir, "listing").where("id % 25 <> 0 and not (source_key like 'LOW%' and id % 2 = 0) and source_key not like '%_7'")
    check = F.when(F.col("source_key").like("%_13"), None).when(F.col("source_key").like("%5"), "interface").otherwise("page")
    return raw.where("posted_on >= date '1998-01-01'").select("id", "source_key", "external_id"), listing, raw.select("source_key").distinct().withColumn("check", check)


@query(f"""WITH {_SWEEP} SELECT id, listed, guard FROM t JOIN guards ON t.source_key = guards.source_key""")
def gone_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.missing(*_sweep(spark, sf_dir)).select("id", "listed", "guard")


@query(f"""WITH {_SWEEP}, answers AS (SELECT source_key, external_id, text, len(images) AS images, coalesce(len(attachments), 0) AS attachments, error, body FROM
        ({_ANSWERS.replace("array('a.png')", "['a.png']").replace("array('a.pdf')", "['a.pdf']").replace("array()", "[]")}) a),
    told AS (SELECT answers.source_key, external_id, CASE WHEN check_by = 'page' THEN CASE WHEN error IS NULL AND (trim(text) <> '' OR images > 0 OR attachments > 0) THEN 'alive' ELSE 'gone' END
        WHEN error IS NOT NULL THEN 'unknown' WHEN body LIKE '%42004%' THEN 'gone' WHEN body LIKE '%10000%' THEN 'alive' ELSE 'unknown' END AS said FROM answers JOIN boards ON answers.source_key = boards.source_key),
    nth AS (SELECT source_key, external_id, row_number() OVER (PARTITION BY source_key ORDER BY pos, external_id) AS n FROM shown WHERE page = 1),
    seen AS (SELECT nth.source_key, count(*) FILTER (WHERE coalesce(said, 'unknown') <> 'alive') AS dead FROM (SELECT DISTINCT source_key, external_id FROM nth WHERE n <= 2) nth
        LEFT JOIN told ON nth.source_key = told.source_key AND nth.external_id = told.external_id GROUP BY nth.source_key),
    held AS (SELECT guards.source_key, CASE WHEN guard = 'no second check' THEN guard WHEN lost = 0 THEN NULL WHEN guard IS NOT NULL THEN guard WHEN dead IS NULL THEN 'no control' WHEN dead > 0 THEN 'a control isn''t alive' END AS guard
        FROM guards LEFT JOIN seen ON guards.source_key = seen.source_key)
    SELECT id, guard, CASE WHEN listed THEN 'listed' WHEN guard IS NOT NULL THEN 'held' ELSE coalesce(said, 'unknown') END AS verdict
    FROM t JOIN held ON t.source_key = held.source_key LEFT JOIN told ON t.source_key = told.source_key AND t.external_id = told.external_id""")
def gone_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets, listing, boards = _sweep(spark, sf_dir)
    pages = spark.sql(_ANSWERS, raw=table(spark, sf_dir, "raw"))
    return publish.gone_sweep(targets, listing, boards, pages).select("id", "guard", "verdict")
