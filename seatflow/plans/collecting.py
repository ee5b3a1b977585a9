"""Queries on listings, the ledger, runs and boards' health."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.operators import health, ledger
from seatflow.plans.registry import VIEWS, day, query, table

CUTOFF = "2000-06-01"


@query("""SELECT source_key, external_id, title, posted_on FROM {raw} r
    WHERE NOT EXISTS (SELECT 1 FROM {ledger} l WHERE l.source_key = r.source_key AND l.external_id = r.external_id)""")
def ledger_new_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "raw").select("source_key", "external_id", "title", "posted_on")
    return ledger.new_postings(rows, table(spark, sf_dir, "ledger"))


def _planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.page_plan(ledger.first_seen(table(spark, sf_dir, "listing")), table(spark, sf_dir, "ledger"), day(CUTOFF))


PLANNED = """
    seen_first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_key, external_id ORDER BY page, pos) AS n FROM {listing}) WHERE n = 1),
    planned AS (SELECT f.source_key, f.external_id, f.title, f.page, f.pos, f.posted_on,
        CASE WHEN f.posted_on < DATE '2000-06-01' THEN 'stale' WHEN l.source_key IS NULL THEN 'fresh'
            WHEN replace(f.title, ' ', '') <> replace(l.title, ' ', '') AND f.posted_on <> l.posted_on THEN 'conflict' ELSE 'seen' END AS verdict
        FROM seen_first f LEFT JOIN {ledger} l ON f.source_key = l.source_key AND f.external_id = l.external_id)"""


@query(f"WITH {PLANNED} SELECT source_key, external_id, page, pos, verdict FROM planned")
def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _planned(spark, sf_dir).select("source_key", "external_id", "page", "pos", "verdict")


@query("""WITH seen AS (SELECT *, row_number() OVER (PARTITION BY source_key, external_id ORDER BY page, pos) = 1 AS new FROM {listing}),
    p AS (SELECT source_key, page, count(*) AS n, count(*) FILTER (WHERE new) AS fresh, count(*) FILTER (WHERE posted_on IS NULL OR posted_on >= DATE '1997-06-01') AS inside FROM seen GROUP BY source_key, page),
    t AS (SELECT source_key, count(*) AS targets FROM {raw} WHERE posted_on >= DATE '1997-06-01' GROUP BY source_key),
    b AS (SELECT p.*, greatest(1, CAST(ceil(coalesce(targets, 0) / CAST(first.n AS DOUBLE)) AS BIGINT)) AS floor_page FROM p JOIN p first ON first.source_key = p.source_key AND first.page = 1 LEFT JOIN t ON t.source_key = p.source_key),
    s AS (SELECT source_key, any_value(floor_page) AS floor_page, min(page) FILTER (WHERE fresh = 0 OR (inside = 0 AND page >= floor_page)) AS stop_page, max(page) AS last_page FROM b GROUP BY source_key)
    SELECT source_key, floor_page, coalesce(stop_page, last_page) AS stop_page FROM s""")
def gone_scan_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each board's list is read when looking for what has vanished."""
    targets = table(spark, sf_dir, "raw").where("posted_on >= date '1997-06-01'").select("source_key")
    return ledger.gone_stop_pages(table(spark, sf_dir, "listing"), targets, day("1997-06-01"))


@query(f"""WITH {PLANNED}, pages AS (SELECT source_key, page, count(*) FILTER (WHERE verdict <> 'stale') AS live FROM planned GROUP BY source_key, page)
    SELECT source_key, coalesce(min(page) FILTER (WHERE live = 0), max(page)) AS stop_page, max(page) AS last_page FROM pages GROUP BY source_key""")
def page_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.stop_pages(_planned(spark, sf_dir))


@query("""SELECT r.source_key, r.external_id, r.title, l.title AS known_title, r.posted_on, l.posted_on AS known_on FROM {raw} r
    JOIN {ledger} l ON r.source_key = l.source_key AND r.external_id = l.external_id WHERE replace(r.title, ' ', '') <> replace(l.title, ' ', '') AND r.posted_on <> l.posted_on""")
def ledger_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "ledger").select("source_key", "external_id", F.col("title").alias("known_title"), F.col("posted_on").alias("known_on"))
    both = table(spark, sf_dir, "raw").join(known, ledger.KEY)
    differs = (ledger.squeeze(F.col("title")) != ledger.squeeze(F.col("known_title"))) & (F.col("posted_on") != F.col("known_on"))
    return both.where(differs).select("source_key", "external_id", "title", "known_title", "posted_on", "known_on")


@query(f"""WITH {PLANNED}, t AS (SELECT source_key, count(DISTINCT page) AS pages, count(*) AS n_rows, count(*) FILTER (WHERE verdict = 'fresh') AS fresh,
        count(*) FILTER (WHERE verdict = 'seen') AS seen, count(*) FILTER (WHERE verdict = 'stale') AS stale, count(*) FILTER (WHERE verdict = 'conflict') AS conflicts,
        min(posted_on) AS oldest, max(posted_on) AS newest FROM planned GROUP BY source_key)
    SELECT *, stale = n_rows AS nothing_live, pages >= 2 AND stale = 0 AS short_of_cutoff FROM t""")
def collect_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.tally(_planned(spark, sf_dir), limit=2)


@query("""SELECT id, posted_on, CAST(posted_on - INTERVAL 2 MONTH AS DATE) AS months_back, posted_on - 14 AS days_back FROM {raw}""")
def cutoff_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seatflow.functions.dates import months_before

    return table(spark, sf_dir, "raw").select("id", "posted_on", months_before(F.col("posted_on"), 2).alias("months_back"), F.date_sub("posted_on", 14).alias("days_back"))


@query("""WITH runs AS (SELECT user_id % 50 AS board_group, CAST(ts AS DATE) AS d, max(ts) AS started_at, count(*) FILTER (WHERE event_type = 'error') AS sources_failed FROM {events} GROUP BY 1, 2),
    good AS (SELECT max(started_at) FILTER (WHERE sources_failed = 0) AS last FROM runs)
    SELECT last, CAST(CASE WHEN last IS NULL THEN 7 ELSE greatest(1, least(7, date_diff('day', CAST(last AS DATE), DATE '2024-02-03') + 1)) END AS INTEGER) AS days,
        coalesce(date_diff('day', CAST(last AS DATE), DATE '2024-02-03') + 1 > 7, false) AS gap FROM good""")
def daily_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    runs = events.groupBy((F.col("user_id") % 50).alias("board_group"), F.col("ts").cast("date").alias("d")).agg(
        F.max("ts").alias("started_at"), F.max("ts").alias("finished_at"), F.count_if(F.col("event_type") == "error").alias("sources_failed"))
    return health.daily_window(runs, day("2024-02-03"))


FOLD = """
    obs AS (SELECT source_key, run_at, CASE WHEN failed THEN 'FAIL' WHEN n_rows > 0 THEN 'OK' ELSE 'EMPTY' END AS status, n_rows, new_count, cutoff, newest FROM {observation}),
    o AS (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY run_at, status) AS n FROM obs),
    f AS (SELECT source_key, count(*) AS runs, arg_max(status, n) AS status, arg_max(n_rows, n) FILTER (WHERE status <> 'FAIL') AS n_rows, arg_max(new_count, n) FILTER (WHERE status <> 'FAIL') AS new_count,
        arg_max(cutoff, n) FILTER (WHERE status <> 'FAIL' AND cutoff IS NOT NULL) AS cutoff, arg_max(newest, n) FILTER (WHERE newest IS NOT NULL) AS newest,
        max(run_at) FILTER (WHERE status = 'OK') AS last_success, CAST(max(n) - coalesce(max(n) FILTER (WHERE status <> 'FAIL'), 0) AS BIGINT) AS failures,
        coalesce(max(n) FILTER (WHERE status = 'OK'), 0) AS ok FROM o GROUP BY source_key),
    folded AS (SELECT source_key, runs, status, n_rows, new_count, cutoff, newest, last_success, failures,
        (SELECT count(*) FROM o WHERE o.source_key = f.source_key AND o.n > f.ok AND o.status = 'EMPTY') AS empty_runs FROM f)"""
QUIET = "(coalesce(n_rows, 0) > 0 AND CASE WHEN newest IS NULL THEN cutoff IS NOT NULL ELSE date_diff('day', newest, DATE '2024-03-24') >= 60 END)"


def folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = table(spark, sf_dir, "observation")
    return health.fold(obs.select("source_key", "run_at", health.status(F.col("n_rows"), F.col("failed")).alias("status"), "n_rows", "new_count", "cutoff", "newest"))


@query(f"WITH {FOLD} SELECT * FROM folded")
def health_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folded(spark, sf_dir)


@query(f"""WITH {FOLD} SELECT source_key, concat_ws(',', CASE WHEN failures >= 2 THEN 'failing' END, CASE WHEN empty_runs >= 2 THEN 'empty' END,
        CASE WHEN {QUIET} THEN 'quiet' END) AS alerts FROM folded""")
def health_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.alerts(folded(spark, sf_dir), day("2024-03-24")).select("source_key", F.array_join("alerts", ",").alias("alerts"))


@query("""SELECT (SELECT count(*) FROM {raw} WHERE structured_at IS NULL AND structure_attempts < 3) AS unstructured, (SELECT count(*) FROM {raw} WHERE structured_at IS NULL AND structure_attempts >= 3) AS given_up,
        count(*) FILTER (WHERE confidence <> 'high') AS to_review, count(*) FILTER (WHERE confidence = 'high' AND published_job_id IS NULL) AS unpublished FROM {draft}""")
def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    drafts = table(spark, sf_dir, "draft").withColumn("review_status", F.when(F.col("confidence") == "high", "APPROVED").otherwise("PENDING"))
    return health.pending_work(table(spark, sf_dir, "raw"), drafts)


@query("""WITH protected AS (SELECT id FROM {draft} WHERE is_owned)
    SELECT id, structured_at IS NOT NULL AND id NOT IN (SELECT id FROM protected) AS requeued,
        CASE WHEN id IN (SELECT id FROM protected) THEN structured_at END AS structured_at,
        CASE WHEN structured_at IS NOT NULL AND id NOT IN (SELECT id FROM protected) THEN 0 ELSE structure_attempts END AS structure_attempts FROM {raw}""")
def requeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    drafts = table(spark, sf_dir, "draft").select(F.col("id").alias("source_data_id"), F.col("is_owned").alias("protected"))
    rows, _ = ledger.requeue(table(spark, sf_dir, "raw").select("id", "structured_at", "structure_attempts"), drafts)
    return rows.select("id", "requeued", "structured_at", "structure_attempts")




# what was read of each fresh posting: some boards fail whole, some details fail or are empty
VIEWS["detail"] = """
    SELECT source_key, external_id, id % 6 <> 1 AS inserted, CASE WHEN source_key LIKE '%_11' OR id % 8 = 3 THEN ' ' ELSE title END AS text, CASE WHEN id % 16 = 3 AND source_key NOT LIKE '%_11' THEN 1 ELSE 0 END AS n_images,
        CASE WHEN source_key LIKE '%_12' OR id % 9 = 4 THEN concat('timeout ', CAST(id % 5 AS STRING)) END AS error FROM {raw}"""


@query(f"""WITH {PLANNED}, p AS (SELECT * FROM planned),
    t AS (SELECT source_key, count(DISTINCT page) AS pages, count(*) FILTER (WHERE verdict = 'fresh') AS fresh, count(*) FILTER (WHERE verdict = 'seen') AS seen, count(*) FILTER (WHERE verdict = 'stale') AS stale,
        count(*) FILTER (WHERE verdict = 'conflict') AS conflicts, min(posted_on) FILTER (WHERE verdict IN ('fresh', 'seen')) AS oldest, max(posted_on) FILTER (WHERE verdict IN ('fresh', 'seen')) AS newest FROM p GROUP BY source_key),
    blank AS (SELECT DISTINCT source_key FROM (SELECT source_key, page FROM p GROUP BY source_key, page HAVING count(posted_on) = 0) x),
    r AS (SELECT p.source_key, p.external_id, page, pos, inserted, error, trim(text) = '' AND n_images = 0 AS hollow FROM p JOIN {{detail}} d ON p.source_key = d.source_key AND p.external_id = d.external_id WHERE verdict = 'fresh'),
    s AS (SELECT source_key, count(*) FILTER (WHERE error IS NULL) AS details, count(*) FILTER (WHERE error IS NULL AND inserted) AS saved, count(*) FILTER (WHERE error IS NULL AND inserted AND hollow) AS empty, count(*) FILTER (WHERE error IS NOT NULL) AS failed
        FROM r GROUP BY source_key),
    a AS (SELECT source_key, string_agg(title, '|' ORDER BY page, pos, external_id) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY page, pos, external_id) AS k FROM p WHERE verdict = 'fresh') x WHERE k <= 3 GROUP BY source_key),
    f AS (SELECT source_key, string_agg(external_id || ': ' || error, '|' ORDER BY page, pos, external_id) AS failures FROM (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY page, pos, external_id) AS k FROM r WHERE error IS NOT NULL) x
        WHERE k <= 3 GROUP BY source_key)
    SELECT t.*, coalesce(details, 0) AS details, coalesce(saved, 0) AS saved, coalesce(empty, 0) AS empty, coalesce(failed, 0) AS failed, samples, failures,
        CASE WHEN conflicts > 0 THEN 'conflicts' WHEN blank.source_key IS NOT NULL THEN 'no dates for the cutoff' WHEN failed > 0 AND saved = 0 THEN 'nothing was saved' WHEN saved > 0 AND empty = saved THEN 'all that was saved is empty' END AS fault
    FROM t LEFT JOIN blank ON blank.source_key = t.source_key LEFT JOIN s ON s.source_key = t.source_key LEFT JOIN a ON a.source_key = t.source_key LEFT JOIN f ON f.source_key = t.source_key""")
def collect_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each board's report of a run, with what fails it."""
    detail = table(spark, sf_dir, "detail").withColumns({"images": F.when(F.col("n_images") > 0, F.array(F.lit("a.png"))), "attachments": F.lit(None).cast("array<string>")})
    out = ledger.accounts(_planned(spark, sf_dir), detail, F.lit(True))
    return out.withColumns({"samples": F.array_join("samples", "|"), "failures": F.array_join("failures", "|")})
