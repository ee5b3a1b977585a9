"""Queries on state: verdicts, links, runs, queues, budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.operators import drafts, health, ledger, media, runs, store
from seatflow.plans.collecting import FOLD, QUIET, folded, pending_work
from seatflow.plans.registry import day, query, table


@query("""WITH u AS (SELECT id, CASE WHEN id % 4 <> 0 THEN DATE '2001-07-01' END AS s, CAST(id % 5 AS INT) AS n, CASE WHEN id % 4 = 0 THEN 'timeout' END AS e FROM {raw} WHERE id % 3 = 0),
    j AS (SELECT r.id, r.structured_at, r.structure_attempts, u.id IS NOT NULL AS hit, s, n, e, CASE WHEN u.id IS NULL THEN NULL WHEN r.structured_at IS NOT NULL AND s IS NULL THEN 'the verdict would be lost' WHEN n < r.structure_attempts THEN 'attempts would fall' END AS refused
        FROM {raw} r LEFT JOIN u ON r.id = u.id)
    SELECT id, CASE WHEN hit AND refused IS NULL THEN s ELSE structured_at END AS structured_at, CASE WHEN hit AND refused IS NULL THEN n ELSE structure_attempts END AS structure_attempts,
        CASE WHEN hit AND refused IS NULL THEN e END AS structure_error, refused FROM j""")
def state_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "raw").select("id", "structured_at", "structure_attempts", F.lit(None).cast("string").alias("structure_error"))
    new = raw.where("id % 3 = 0").select("id", F.when(F.col("id") % 4 != 0, day("2001-07-01")).alias("structured_at"), (F.col("id") % 5).cast("int").alias("structure_attempts"), F.when(F.col("id") % 4 == 0, "timeout").alias("structure_error"))
    return store.state_updated(raw, new)


@query("""SELECT id, CASE WHEN published_job_id IS NULL THEN CASE WHEN id % 7 = 0 THEN id + 5000000000 END WHEN id % 3 = 0 AND id % 9 <> 0 THEN NULL ELSE published_job_id END AS published_job_id FROM {draft}""")
def publication_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "draft").select("id", "published_job_id")
    wanted = rows.where("id % 7 = 0").select("id", (F.col("id") + 5000000000).alias("job_id"))
    back = rows.where("id % 3 = 0 and published_job_id is not null").select("id", F.when(F.col("id") % 9 == 0, F.col("published_job_id") + 1).otherwise(F.col("published_job_id")).alias("job_id"))
    return store.linked(rows, wanted, back)


@query("""WITH b AS (SELECT user_id % 20 AS run_id, user_id AS board, count(*) AS saved, count(*) FILTER (WHERE event_type = 'error') % 2 = 1 AS failed FROM {events} GROUP BY 1, 2)
    SELECT run_id, count(*) FILTER (WHERE NOT failed) AS sources_ok, count(*) FILTER (WHERE failed) AS sources_failed, CAST(coalesce(sum(saved) FILTER (WHERE NOT failed), 0) AS BIGINT) AS new_count, count(*) FILTER (WHERE failed) AS n_errors FROM b GROUP BY run_id""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    boards = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 20).alias("run_id"), F.concat(F.lit("B"), "user_id").alias("source_key")).agg(
        F.count("*").alias("saved"), F.when(F.count_if(F.col("event_type") == "error") % 2 == 1, "odd").alias("error"))
    out = runs.summary(boards)
    return out.select("run_id", "sources_ok", "sources_failed", "new_count", F.size("error_detail").cast("long").alias("n_errors"))


@query("""WITH e AS (SELECT user_id AS run_id, ts, CASE WHEN event_id % 3 = 0 THEN 'close' ELSE 'open' END AS kind, CAST(event_id % 7 AS INT) AS ok FROM {events}),
    r AS (SELECT run_id, min(ts) FILTER (WHERE kind = 'open') AS started_at, max(ts) FILTER (WHERE kind = 'close') AS finished_at, arg_max(ok, ts) FILTER (WHERE kind = 'close') AS sources_ok FROM e GROUP BY run_id)
    SELECT run_id, started_at, finished_at, sources_ok, CASE WHEN started_at IS NULL THEN 'closed but never opened' WHEN finished_at < started_at THEN 'finished before it started' END AS error FROM r""")
def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("event_id") % 7).cast("int")
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("ts").alias("at"), F.when(F.col("event_id") % 3 == 0, "close").otherwise("open").alias("kind"), F.lit("daily").alias("mode"), n.alias("sources_ok"), n.alias("sources_failed"), n.alias("new_count"))
    return runs.current(events).select("run_id", "started_at", "finished_at", "sources_ok", "error")


@query("""WITH r AS (SELECT user_id, min(ts) AS started_at, CASE WHEN user_id % 3 <> 0 THEN max(ts) END AS finished_at FROM {events} GROUP BY user_id)
    SELECT user_id AS run_id, started_at FROM r ORDER BY started_at DESC, user_id DESC LIMIT 10""")
def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("run_id")).agg(F.min("ts").alias("started_at"))
    return runs.recent(rows, 10)


@query(f"""WITH r AS (SELECT user_id, min(ts) AS started_at, CASE WHEN user_id % 3 <> 0 THEN max(ts) END AS finished_at FROM {{events}} GROUP BY user_id), {FOLD},
    counted AS (SELECT (SELECT count(*) FROM r WHERE finished_at IS NULL AND started_at < TIMESTAMP '2024-01-01 12:00:00' - INTERVAL 3 HOUR) AS dead_runs,
        (SELECT count(*) FROM folded WHERE failures >= 2 OR empty_runs >= 2 OR {QUIET}) AS alerted_boards,
        (SELECT count(*) FROM {{raw}} WHERE structured_at IS NULL AND structure_attempts >= 3) AS given_up, (SELECT count(*) FROM {{draft}} WHERE confidence = 'high' AND published_job_id IS NULL) AS unpublished)
    SELECT *, dead_runs > 0 OR alerted_boards > 0 OR given_up > 0 OR unpublished > 0 AS needed FROM counted""")
def needs_a_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("started_at"), F.max("ts").alias("last")).withColumn("finished_at", F.when(F.col("user_id") % 3 != 0, F.col("last")))
    boards = health.alerts(folded(spark, sf_dir), day("2024-03-24"))
    return runs.needs_a_person(rows, boards, pending_work(spark, sf_dir), F.lit("2024-01-01 12:00:00").cast("timestamp"))


@query("""SELECT id, source_key, posted_on FROM {raw} WHERE structured_at IS NULL AND structure_attempts < 3 ORDER BY posted_on, id LIMIT 50""")
def unstructured_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.unstructured(table(spark, sf_dir, "raw"), limit=50).select("id", "source_key", "posted_on")


@query("""WITH m AS (SELECT l_orderkey AS id, l_linenumber AS pos, CAST(l_quantity * 400000 AS BIGINT) AS n_bytes FROM {lineitem}),
    t AS (SELECT *, sum(n_bytes) OVER (PARTITION BY id ORDER BY pos) AS total FROM (SELECT id, pos, min(n_bytes) AS n_bytes FROM m GROUP BY id, pos))
    SELECT id, pos, n_bytes FROM t WHERE total <= 15000000""")
def media_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("pos"), (F.col("l_quantity") * 400000).cast("long").alias("n_bytes"))
    first = rows.groupBy("id", "pos").agg(F.min("n_bytes").alias("n_bytes"))
    return media.within_budget(first)


@query("""SELECT source_key, count(*) AS n FROM {raw} WHERE structured_at IS NULL AND structure_attempts < 3 GROUP BY source_key""")
def work_by_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.unstructured(table(spark, sf_dir, "raw")).groupBy("source_key").agg(F.count("*").alias("n"))


@query(r"""WITH said AS (SELECT conv_id, turn, string_split(c.text, ' ') AS words, regexp_replace(d.text, '\s', '', 'g') AS bare FROM {conversations} c JOIN {documents} d ON doc_id = conv_id),
    quoted AS (SELECT conv_id, turn, bare, regexp_replace(unnest(words), '\s', '', 'g') AS word, CAST(unnest(range(len(words))) AS INTEGER) AS nth FROM said)
    SELECT conv_id, turn, nth, CASE WHEN word <> '' AND contains(bare, word) THEN 'word' ELSE '' END || CASE WHEN contains(bare, 'the') THEN '+the' ELSE '' END AS kept FROM quoted""")
def grounded_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each word of a turn, and a fixed one, as evidence for a choice."""
    both = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("nth", "quote")).join(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), "text"), "conv_id")
    kept = drafts.choices_grounded(F.array(F.lit("word"), F.lit("the"), F.lit("no evidence")), F.array(F.col("quote"), F.lit("t h e")), F.array("text"))
    return both.select("conv_id", "turn", "nth", F.concat(F.when(F.array_contains(kept, "word"), "word").otherwise(""), F.when(F.array_contains(kept, "the"), "+the").otherwise("")).alias("kept"))
