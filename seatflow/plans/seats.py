"""Queries on seats: keys, rounds, departments, mailboxes, places, key merges and masters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.functions import text as T
from seatflow.operators import dedup, publish
from seatflow.plans.registry import day, query, table

TODAY = "2001-06-01"


def drafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = table(spark, sf_dir, "draft")
    return out.withColumns({
        "positions": F.split("role_key", r"\+"), "role": F.lit(None).cast("string"), "posted_at": F.col("posted_on"), "is_anchor": F.lit(False),
        "mailboxes": F.when(F.col("mailbox").isNotNull(), F.array("mailbox")).otherwise(F.array().cast("array<string>")),
        "completeness": F.col("address").isNotNull().cast("int") + F.col("mailbox").isNotNull().cast("int") + F.col("deadline").isNotNull().cast("int"),
        "review_status": F.when(F.col("confidence") == "high", "APPROVED").otherwise("PENDING"), "gone_at": F.col("gone_at").cast("date"),
    })


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open jobs that others published and that can be seen, as drafts that always win: owned, without a place or a deadline."""
    own = drafts(spark, sf_dir)
    jobs = table(spark, sf_dir, "job").withColumn("_of", F.col("job_id") - 1_000_000_000)
    seen = publish.anchors(jobs, own.where("published_job_id is not null").select(F.col("published_job_id").alias("job_id")), day(TODAY))
    none = {c: F.lit(None).cast(own.schema[c].dataType) for c in ("city", "address", "deadline", "reject_reason", "gone_at")}
    out = seen.select("job_id", F.col("posted_at").alias("seen_on"), "_of").join(own, F.col("_of") == F.col("id"))
    out = out.withColumns({**none, "id": F.col("job_id"), "posted_on": F.col("seen_on"), "posted_at": F.col("seen_on"), "is_owned": F.lit(True), "is_anchor": F.lit(True), "completeness": F.lit(0)})
    return out.select(own.columns)


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.judged(dedup.with_seat(drafts(spark, sf_dir)))


SEATED = r"""
    seated AS (SELECT *, nullif(regexp_replace(regexp_replace(church_name, '\[[^\]]*\]', '', 'g'), '[\s.,_/-]', '', 'g'), '') AS church,
        CAST(address IS NOT NULL AS INT) + CAST(mailbox IS NOT NULL AS INT) + CAST(deadline IS NOT NULL AS INT) AS completeness,
        CASE WHEN role_key = 'ETC' THEN 0 ELSE len(string_split(role_key, '+')) END AS named FROM {draft}),
    member AS (SELECT * FROM seated WHERE church IS NOT NULL AND region IS NOT NULL AND coalesce(reject_reason, '') <> 'HERESY' AND gone_at IS NULL)"""
ROUNDS = (
    SEATED
    + """, lagged AS (SELECT *, lag(posted_on) OVER (PARTITION BY church, region, role_key ORDER BY posted_on, id) AS before FROM member),
    rounds AS (SELECT *, CAST(sum(CASE WHEN before IS NULL OR CAST(posted_on - INTERVAL 3 MONTH AS DATE) > before THEN 1 ELSE 0 END)
        OVER (PARTITION BY church, region, role_key ORDER BY posted_on, id) AS INTEGER) AS round FROM lagged)"""
)


@query(f"WITH {SEATED} SELECT id, church, region, role_key FROM seated")
def seat_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.with_seat(drafts(spark, sf_dir)).select("id", "church", "region", "role_key")


@query(f"WITH {ROUNDS} SELECT id, church, region, role_key, round FROM rounds")
def dedup_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.with_rounds(members(spark, sf_dir)).select("id", "church", "region", "role_key", "round")


@query(f"""WITH {ROUNDS}, m AS (SELECT *, row_number() OVER (PARTITION BY church, region, role_key, round ORDER BY is_owned DESC, (confidence = 'high') DESC, completeness DESC, named DESC, posted_on DESC, id DESC) = 1 AS is_master,
        count(*) OVER (PARTITION BY church, region, role_key, round) AS n_members, max(posted_on) OVER (PARTITION BY church, region, role_key, round) AS newest FROM rounds)
    SELECT id, concat(church, ':', region, ':', role_key, ':-:R', round) AS dedup_key, CASE WHEN n_members = 1 THEN 'ALONE' WHEN is_master THEN 'MASTER' ELSE 'DUPLICATE' END AS dedup_state, newest FROM m""")
def dedup_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: which row stands for each opening."""
    out = dedup.with_master(dedup.with_rounds(members(spark, sf_dir)), dedup.ROUND)
    state = F.when(F.col("n_members") == 1, "ALONE").when(F.col("is_master"), "MASTER").otherwise("DUPLICATE")
    return out.select("id", dedup.dedup_key(F.lit("-")).alias("dedup_key"), state.alias("dedup_state"), "newest")


@query(f"""WITH {ROUNDS}, d AS (SELECT church, region, role_key, round, count(DISTINCT department) AS n_named, count(*) FILTER (WHERE department IS NULL) AS silent, max(department) AS single FROM rounds GROUP BY ALL)
    SELECT id, n_named > 1 AND silent > 0 AS held, coalesce(department, CASE WHEN n_named = 1 THEN single END, '-') AS slot FROM rounds JOIN d USING (church, region, role_key, round)""")
def dedup_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.with_department(dedup.with_rounds(members(spark, sf_dir))).select("id", "held", "slot")


@query(f"""WITH {ROUNDS} SELECT church, region, role_key, round, count(DISTINCT mailbox) > 1 AS clash FROM rounds WHERE mailbox IS NOT NULL GROUP BY church, region, role_key, round""")
def dedup_mailbox_clash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.mailbox_clash(dedup.with_rounds(members(spark, sf_dir)), dedup.ROUND)


FITS = """(CASE WHEN length({a}) > length({b}) THEN strpos({a}, {b}) > 0 AND NOT (substr({a}, strpos({a}, {b}) + length({b}), 1) BETWEEN '0' AND '9') AND NOT (strpos({a}, {b}) > 1 AND substr({a}, strpos({a}, {b}) - 1, 1) BETWEEN '0' AND '9')
    ELSE strpos({b}, {a}) > 0 AND NOT (substr({b}, strpos({b}, {a}) + length({a}), 1) BETWEEN '0' AND '9') AND NOT (strpos({b}, {a}) > 1 AND substr({b}, strpos({b}, {a}) - 1, 1) BETWEEN '0' AND '9') END)"""


def _fits(a: str, b: str) -> str:
    return FITS.replace("{a}", a).replace("{b}", b)


@query(f"""WITH {ROUNDS}, p AS (SELECT DISTINCT church, region, role_key, round, replace(city, ' ', '') AS c, replace(address, ' ', '') AS r FROM rounds WHERE address IS NOT NULL),
    n AS (SELECT church, region, role_key, round, count(*) AS n FROM rounds WHERE address IS NOT NULL GROUP BY ALL),
    apart AS (SELECT DISTINCT x.church, x.region, x.role_key, x.round FROM p x JOIN p y ON x.church = y.church AND x.region = y.region AND x.role_key = y.role_key AND x.round = y.round
        WHERE NOT ({_fits('x.c', 'y.c')} AND {_fits('x.r', 'y.r')}))
    SELECT n.church, n.region, n.role_key, n.round, CASE WHEN n.n >= 2 THEN apart.church IS NULL END AS same FROM n LEFT JOIN apart ON n.church = apart.church AND n.region = apart.region AND n.role_key = apart.role_key AND n.round = apart.round""")
def dedup_place_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.same_place(dedup.with_rounds(members(spark, sf_dir)), dedup.ROUND)


@query(f"""WITH RECURSIVE {ROUNDS}, placed AS (SELECT id, church, region, role_key, round, regexp_replace(coalesce(city, ''), '[\\s,.()-]', '', 'g') AS c, regexp_replace(coalesce(address, ''), '[\\s,.()-]', '', 'g') AS r,
        row_number() OVER (PARTITION BY church, region, role_key, round ORDER BY posted_on, id) AS n FROM rounds),
    step AS (SELECT DISTINCT CAST(NULL AS BIGINT) AS id, church, region, role_key, round, CAST(0 AS BIGINT) AS n, CAST([] AS STRUCT(c VARCHAR, r VARCHAR)[]) AS firsts, CAST(NULL AS INTEGER) AS cluster FROM placed
        UNION ALL SELECT id, church, region, role_key, round, n, CASE WHEN c <> '' AND r <> '' AND spot IS NULL THEN list_append(firsts, {{'c': c, 'r': r}}) ELSE firsts END,
            CASE WHEN c <> '' AND r <> '' THEN CAST(coalesce(spot, len(firsts) + 1) AS INTEGER) END
        FROM (SELECT p.*, firsts, nullif(list_position(list_transform(firsts, lambda f: {_fits('f.c', 'p.c')} AND {_fits('f.r', 'p.r')}), true), 0) AS spot
            FROM step s JOIN placed p ON s.church = p.church AND s.region = p.region AND s.role_key = p.role_key AND s.round = p.round AND p.n = s.n + 1))
    SELECT id, church, region, role_key, round, cluster FROM step WHERE n > 0""")
def dedup_place_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-fit clusters in order."""
    rows = dedup.with_rounds(members(spark, sf_dir)).select("id", *dedup.ROUND, "posted_on", "city", "address")
    return dedup.split_by_place(rows, dedup.ROUND).select("id", *dedup.ROUND, "cluster")


EDGES = (
    SEATED
    + f""", seat AS (SELECT DISTINCT church, region, role_key, concat(church, '|', region, '|', role_key) AS seat, mailbox FROM member WHERE mailbox IS NOT NULL),
    met AS (SELECT DISTINCT a.seat AS a, b.seat AS b FROM seat a JOIN seat b ON a.region = b.region AND a.mailbox = b.mailbox
        WHERE (a.church, a.role_key) < (b.church, b.role_key) AND (a.church = b.church OR contains(a.church, b.church) OR contains(b.church, a.church))
        AND (a.role_key = b.role_key OR 'ETC' IN (a.role_key, b.role_key) OR len(list_filter(string_split(a.role_key, '+'), lambda x: NOT list_contains(string_split(b.role_key, '+'), x))) = 0
            OR len(list_filter(string_split(b.role_key, '+'), lambda x: NOT list_contains(string_split(a.role_key, '+'), x))) = 0)),
    spot AS (SELECT DISTINCT concat(church, '|', region, '|', role_key) AS seat, replace(city, ' ', '') AS c, replace(address, ' ', '') AS r FROM member WHERE address IS NOT NULL),
    of_pair AS (SELECT a, b, c, r FROM met JOIN spot ON seat = a UNION SELECT a, b, c, r FROM met JOIN spot ON seat = b),
    far AS (SELECT DISTINCT x.a, x.b FROM of_pair x JOIN of_pair y ON x.a = y.a AND x.b = y.b WHERE NOT ({_fits('x.c', 'y.c')} AND {_fits('x.r', 'y.r')})),
    edges AS (SELECT met.a, met.b FROM met LEFT JOIN far ON met.a = far.a AND met.b = far.b WHERE far.a IS NULL)"""
)


def _text(c: str):  # noqa: ANN202
    return F.concat_ws("|", f"{c}.church", f"{c}.region", f"{c}.role_key")


@query(f"WITH {EDGES} SELECT a, b FROM edges")
def dedup_variant_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.variant_edges(members(spark, sf_dir)).select(_text("a").alias("a"), _text("b").alias("b"))


@query(f"""WITH RECURSIVE {EDGES}, way AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
    reach AS (SELECT a AS node, a AS here FROM way UNION SELECT reach.node, way.b FROM reach JOIN way ON reach.here = way.a)
    SELECT node, min(here) AS root FROM reach GROUP BY node""")
def dedup_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seatflow.operators.graph import components

    return components(dedup.variant_edges(members(spark, sf_dir)).select(_text("a").alias("a"), _text("b").alias("b")))


@query(f"""WITH {SEATED}, ours AS (SELECT DISTINCT published_job_id AS job_id FROM {{draft}} WHERE published_job_id IS NOT NULL),
    anchor AS (SELECT job_id AS id, church, region, role_key, posted_at FROM {{job}} JOIN (SELECT id AS of, church, region, role_key FROM seated) ON of = job_id - 1000000000
        WHERE status = 'OPEN' AND CASE WHEN deadline IS NOT NULL THEN deadline >= DATE '2001-06-01' ELSE posted_at + 90 >= DATE '2001-06-01' END
            AND job_id NOT IN (SELECT job_id FROM ours) AND church IS NOT NULL AND region IS NOT NULL),
    joint AS (SELECT id, church, region, role_key, posted_on, deadline, is_owned, false AS is_anchor FROM member UNION ALL SELECT id, church, region, role_key, posted_at, NULL, true, true FROM anchor),
    c AS (SELECT *, max(CASE WHEN deadline < DATE '2001-06-01' THEN deadline END) OVER (PARTITION BY church, region, role_key) AS closed_on FROM joint)
    SELECT id, is_anchor, closed_on, closed_on IS NULL OR is_anchor OR coalesce(deadline >= DATE '2001-06-01', false) OR (deadline IS NULL AND (posted_on > closed_on OR is_owned)) AS open FROM c""")
def dedup_still_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = drafts(spark, sf_dir).unionByName(anchors(spark, sf_dir))
    return dedup.still_open(dedup.judged(dedup.with_seat(both)), day(TODAY)).select("id", "is_anchor", "closed_on", "open")


@query()
def dedup_full_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules together, with the jobs of others as anchors; place splits hang on order, so tests hold it against permutation and repetition."""
    return dedup.planned(drafts(spark, sf_dir).unionByName(anchors(spark, sf_dir)), day(TODAY))


@query(f"""WITH {ROUNDS}, m AS (SELECT *, row_number() OVER (PARTITION BY church, region, role_key, round ORDER BY is_owned DESC, (confidence = 'high') DESC, completeness DESC, named DESC, posted_on DESC, id DESC) = 1 AS is_master,
        count(*) OVER (PARTITION BY church, region, role_key, round) AS n_members FROM rounds)
    SELECT region, CASE WHEN n_members = 1 THEN 'ALONE' WHEN is_master THEN 'MASTER' ELSE 'DUPLICATE' END AS dedup_state, count(*) AS n, count(DISTINCT concat(church, role_key, round)) AS n_keys FROM m GROUP BY 1, 2""")
def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup.with_master(dedup.with_rounds(members(spark, sf_dir)), dedup.ROUND)
    state = F.when(F.col("n_members") == 1, "ALONE").when(F.col("is_master"), "MASTER").otherwise("DUPLICATE")
    return out.groupBy("region", state.alias("dedup_state")).agg(F.count("*").alias("n"), F.countDistinct(F.concat("church", "role_key", "round")).alias("n_keys"))


@query(r"""SELECT s_suppkey AS id, CASE WHEN strpos(s_name, '#') > 0 THEN replace(s_name, '#', ' no. ') END AS name,
        lower(regexp_replace(replace(s_name, '#', ' no. '), '[\s.,_/-]', '', 'g')) AS key FROM {supplier}""")
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.replace("s_name", F.lit("#"), F.lit(" no. ")).alias("name"))
    return rows.select("id", "name", T.name_key(F.col("name")).alias("key"))
