"""Queries on texts, phrases, addresses, HTML, answers and drafts.

The given tables hold no Korean; phrases are put together from each row's own numbers and names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.functions import dates as D
from seatflow.functions import html as H
from seatflow.functions import text as T
from seatflow.functions import urls as U
from seatflow.functions.names import senior_pastor_of
from seatflow.operators import answers, denominations, drafts, media, store
from seatflow.plans.registry import VIEWS, query, table
from seatflow.vocab import DEPARTMENT, canonical

_WORDS = [w for listed in denominations.WORDS.values() for w in listed]
_WORD = lambda n: f"CASE {n} % {len(_WORDS)} " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(_WORDS)) + " END"

VIEWS |= {
    "stated_word": f"""
        SELECT o_orderkey AS id, {_WORD("o_orderkey")} AS one, {_WORD("(o_orderkey * 7 + o_custkey)")} AS two, o_custkey AS c FROM {{orders}}""",
    # values of a board's denomination field, texts and other fields of the posting
    "stated": """
        SELECT id, CASE c % 7 WHEN 0 THEN one WHEN 1 THEN concat('대한예수교 장로회 (', one, ')') WHEN 2 THEN concat(one, ' ', two) WHEN 3 THEN concat(one, ' 교단입니다') WHEN 4 THEN concat('x', upper(one), ' ', one)
                WHEN 5 THEN concat('Kx', one, 'x') END AS stated,
            CASE id % 9 WHEN 0 THEN ' ' WHEN 1 THEN concat('소속 ', upper(one), chr(10), 'x') WHEN 2 THEN concat(one, ' 신대원 졸업') WHEN 3 THEN concat('본 교단(', one, ') 신대원 졸업') WHEN 4 THEN concat('PCKWORLD a', one, 'b')
                WHEN 5 THEN concat(two, ' 신학대학원', chr(10), one) WHEN 6 THEN concat(one, ' 자격', chr(10), two, chr(10), '학력') WHEN 7 THEN NULL ELSE '없음' END AS text,
            CASE c % 4 WHEN 0 THEN two WHEN 1 THEN concat(one, ' 인준') WHEN 2 THEN '기타' END AS field FROM {stated_word}""",
    "phrase": """
        SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS posted_on,
            CASE o_orderkey % 12 WHEN 0 THEN concat('월 ', CAST(o_orderkey % 280 + 5 AS STRING), '만원') WHEN 1 THEN concat('연봉 ', CAST(3000 + o_orderkey % 1500 AS STRING), '만원')
                WHEN 2 THEN concat('월 ', CAST(90 + o_orderkey % 100 AS STRING), '~', CAST(150 + o_orderkey % 90 AS STRING), '만원') WHEN 3 THEN '교회 내규에 따름'
                WHEN 4 THEN concat('전도사 월 ', CAST(100 + o_orderkey % 50 AS STRING), '만원, 목사 월 ', CAST(180 + o_orderkey % 50 AS STRING), '만원')
                WHEN 5 THEN concat('사택 전세 ', CAST(1 + o_orderkey % 9 AS STRING), '천만원 월 ', CAST(200 + o_orderkey % 100 AS STRING), '만원')
                WHEN 6 THEN CAST(1000000 + (o_orderkey % 300) * 10000 AS STRING) WHEN 7 THEN concat(CAST(600 + o_orderkey % 300 AS STRING), '만원') WHEN 8 THEN concat('아파트(', CAST(o_orderkey % 60 AS STRING), '평) 제공')
                WHEN 9 THEN concat(CAST(1 + o_orderkey % 3 AS STRING), '억 건축헌금') WHEN 10 THEN concat('월 2,', CAST(100 + o_orderkey % 800 AS STRING), ',000원') END AS pay,
            CASE WHEN o_orderkey % 4 = 0 THEN '교회 내규에 따름' END AS note,
            concat(CASE o_orderkey % 9 WHEN 0 THEN '(끌어올림) ' WHEN 1 THEN '[수정, 끌어올림]' WHEN 2 THEN '끌올- ' WHEN 3 THEN '★끌올★ (답글) ' WHEN 4 THEN '(대전) ' WHEN 5 THEN '[재공고] ' ELSE '' END,
                'posting ', CAST(o_orderkey AS STRING), CASE o_orderkey % 11 WHEN 0 THEN ' (끌어올림)' WHEN 1 THEN ' 끌어올림' WHEN 2 THEN '...' WHEN 3 THEN '(청빙완료)' ELSE '' END) AS title,
            CASE o_orderkey % 6 WHEN 0 THEN '구인 완료' WHEN 1 THEN '마감' ELSE '진행중' END AS status,
            CASE o_custkey % 8 WHEN 0 THEN 'SEOUL' WHEN 1 THEN 'BUSAN' WHEN 2 THEN 'DAEGU' WHEN 3 THEN 'GYEONGGI' WHEN 4 THEN NULL ELSE 'INCHEON' END AS region,
            CASE o_orderkey % 7 WHEN 0 THEN '서울시 송파구' WHEN 1 THEN '부산진구' WHEN 2 THEN '대구광역시 중구' WHEN 3 THEN '서울특별시' WHEN 4 THEN '부산 해운대구' WHEN 5 THEN '인천 연수구' END AS city,
            CASE o_orderkey % 8 WHEN 0 THEN concat('테헤란로 ', CAST(o_orderkey % 300 AS STRING)) WHEN 1 THEN concat('안중읍 ', CAST(o_orderkey % 900 AS STRING), '-13') WHEN 2 THEN '인평1길 북삼교회' WHEN 3 THEN '본문 참조'
                WHEN 4 THEN concat('역삼동', CAST(o_orderkey % 99 AS STRING)) WHEN 5 THEN '  ' WHEN 6 THEN concat('휴가 ', CAST(o_orderkey % 20 AS STRING), '일') END AS address,
            CASE o_orderkey % 7 WHEN 0 THEN concat('2001. ', CAST(1 + o_orderkey % 12 AS STRING), '. ', CAST(1 + o_orderkey % 31 AS STRING), ' 까지') WHEN 1 THEN concat('2001-0', CAST(1 + o_orderkey % 9 AS STRING), '-05 ~ ', CAST(1 + o_orderkey % 12 AS STRING), '.20')
                WHEN 2 THEN concat(CAST(1 + o_orderkey % 12 AS STRING), '월 ', CAST(1 + o_orderkey % 28 AS STRING), '일') WHEN 3 THEN '20010831' WHEN 4 THEN '채용시까지' WHEN 5 THEN concat('2001년 2월 ', CAST(25 + o_orderkey % 7 AS STRING), '일') END AS due,
            concat(CASE o_orderkey % 5 WHEN 0 THEN '담임목사 : 홍길동' WHEN 1 THEN '2. 담임목사 처우' WHEN 2 THEN '(담임목사 김철수)' WHEN 3 THEN '담임목사: 없음' ELSE '담임목사님과 함께' END, ' ', chr(10), '교회') AS body,
            CASE o_custkey % 6 WHEN 0 THEN '예장합동' WHEN 1 THEN '대한예수교장로회 (백석대신)' WHEN 2 THEN 'PCK' WHEN 3 THEN 'GAPCK 합동' WHEN 4 THEN '고신에서 나온 독립' ELSE '합동교단과 교류합니다.' END AS denomination,
            CASE o_orderkey % 4 WHEN 0 THEN '소속: 예장합동 PCK 백석대신' WHEN 1 THEN '합동 신대원 졸업자' WHEN 2 THEN '본 교단(합동) 신대원 졸업' END AS source_line
        FROM {orders}""",
    "answer": """
        SELECT event_id AS id, user_id, CASE WHEN event_id % 40 = 0 THEN concat('x', props) WHEN event_id % 40 = 1 THEN replace(props, '"k"', '"j"') WHEN event_id % 40 = 2 THEN replace(replace(props, ': ', ': "x'), chr(125), concat('"', chr(125))) ELSE props END AS payload FROM {events}""",
    "graded_draft": """
        SELECT o_orderkey AS id, CASE WHEN o_orderkey % 23 = 0 THEN 'bad key' ELSE concat('B', CAST(o_custkey % 30 AS STRING)) END AS source_key, CAST(o_orderkey AS STRING) AS external_id,
            CASE WHEN o_orderkey % 19 = 0 THEN ' ' ELSE 'posting' END AS title, CASE WHEN o_orderkey % 29 <> 0 THEN concat('church ', CAST(o_custkey AS STRING)) END AS church_name,
            CASE o_orderkey % 3 WHEN 0 THEN 'MINISTRY' WHEN 1 THEN 'GENERAL' END AS job_kind, CASE WHEN o_orderkey % 4 = 0 THEN 'EVANGELIST' WHEN o_orderkey % 8 = 3 THEN 'ETC+EVANGELIST' END AS position_text,
            CASE WHEN o_orderkey % 5 < 2 THEN 'clerk' END AS role, CASE WHEN o_orderkey % 31 <> 0 THEN 'text' END AS description,
            CASE WHEN o_orderkey % 7 = 0 THEN 'a@b.org' END AS contact_email, CASE WHEN o_orderkey % 7 = 1 THEN '010' END AS contact_phone, CASE WHEN o_orderkey % 7 = 2 THEN 'https://x' END AS contact_link, CASE WHEN o_orderkey % 7 IN (2, 3, 4) THEN 'road 1' END AS contact_post,
            CASE o_orderkey % 10 WHEN 9 THEN 'UNCERTAIN' WHEN 8 THEN 'NO' ELSE 'YES' END AS gate, o_orderkey % 6 = 0 AS media_sent, o_orderkey % 12 = 0 AS media_missed, o_orderkey % 14 <> 0 AS can_compare, o_orderkey % 21 = 0 AS heresy_flag,
            CASE WHEN o_orderkey % 42 = 0 THEN 'list' END AS heresy_evidence, CASE WHEN o_orderkey % 33 = 0 THEN 'CLOSED' WHEN o_orderkey % 35 = 0 THEN 'DUPLICATE' END AS reject_reason,
            CAST(CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 300 - 2 END AS INT) AS pay_min, CAST(CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 400 END AS INT) AS pay_max,
            CASE WHEN o_orderkey % 13 = 0 THEN 'UNKNOWN' WHEN o_orderkey % 13 = 1 THEN NULL ELSE 'HAPDONG' END AS denomination, CASE WHEN o_orderkey % 2 = 0 THEN 'stated' ELSE 'unknown' END AS denomination_source,
            CASE WHEN o_orderkey % 35 = 0 THEN 'DUPLICATE' WHEN o_orderkey % 37 = 0 THEN 'DUPLICATE' ELSE 'ALONE' END AS dedup_state
        FROM {orders}""",
}


_UNITS = "|".join(T.UNITS)
PAY = rf"""said AS (SELECT id, pay, note, replace(replace(coalesce(pay, ''), ' ', ''), ',', '') AS bare FROM {{phrase}}),
    cut AS (SELECT *, list_zip(regexp_extract_all(bare, '([가-힣]{{{{0,4}}}})([0-9]+)({_UNITS})?', 1), regexp_extract_all(bare, '([가-힣]{{{{0,4}}}})([0-9]+)({_UNITS})?', 2),
        regexp_extract_all(bare, '([가-힣]{{{{0,4}}}})([0-9]+)({_UNITS})?', 3)) AS parts FROM said),
    money AS (SELECT id, pay, note, list_filter(list_transform(list_filter(parts, lambda x: coalesce(x[3], '') IN ({", ".join(f"'{u}'" for u in T.MONEY)}) AND NOT regexp_matches(x[1], '{"|".join(T.NOT_PAY)}')),
        lambda x: {{{{'lead': x[1], 'n': CASE WHEN starts_with(x[3], '억') THEN TRY_CAST(x[2] AS BIGINT) * 10000 WHEN starts_with(x[3], '천만') THEN TRY_CAST(x[2] AS BIGINT) * 1000 WHEN starts_with(x[3], '만') THEN TRY_CAST(x[2] AS BIGINT)
            WHEN x[3] = '원' OR TRY_CAST(x[2] AS BIGINT) >= 100000 THEN TRY_CAST(x[2] AS BIGINT) // 10000 ELSE TRY_CAST(x[2] AS BIGINT) END}}}}), lambda x: x.n BETWEEN 10 AND 10000) AS found FROM cut),
    timed AS (SELECT *, found[1].n AS first, CASE WHEN regexp_matches(found[1].lead, '연봉|년봉|연') THEN 'YEAR' WHEN regexp_matches(found[1].lead, '월급|월사례|월평균|매월|월') THEN 'MONTH'
        WHEN found[1].n <= 500 THEN 'MONTH' WHEN found[1].n >= 1000 THEN 'YEAR' END AS period FROM money),
    later AS (SELECT *, list_filter(found[2:], lambda x: x.n > first AND x.n <= CASE WHEN first > 500 THEN 10000 ELSE 500 END)[1].n AS second FROM timed),
    paid AS (SELECT *, period IS NOT NULL AND (second IS NULL OR regexp_matches(replace(coalesce(pay, ''), ' ', ''), '[0-9],*(만원|만)?[~∼〜–—-][0-9]')) AS usable FROM later)"""


@query(f"""WITH {PAY.replace("{{", "{").replace("}}", "}")} SELECT id, pay, CASE WHEN usable THEN first END AS low, CASE WHEN usable THEN second END AS high, period,
        CASE WHEN usable AND first IS NOT NULL THEN note WHEN note IS NULL THEN nullif(trim(pay), '') WHEN pay IS NULL OR contains(note, trim(pay)) THEN trim(note) WHEN contains(pay, note) THEN trim(pay) ELSE concat(note, ' · ', pay) END AS pay_note FROM paid""")
def pay_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts, period and note of pay phrases."""
    pay = F.col("pay")
    return table(spark, sf_dir, "phrase").select("id", "pay", T.pay_of(pay).alias("p"), T.period_of(pay).alias("period"), T.pay_note_of(pay, F.col("note")).alias("pay_note")).select("id", "pay", "p.low", "p.high", "period", "pay_note")


@query(r"""SELECT doc_id, CASE WHEN len(regexp_extract_all(text, '[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+')) > 0
        THEN array_to_string(list_distinct_in_order, ', ') END AS emails FROM
    (SELECT doc_id, text, list_transform(list_filter(list_zip(f, range(len(f))), lambda x: list_position(f, x[1]) = x[2] + 1), lambda x: x[1]) AS list_distinct_in_order FROM
        (SELECT doc_id, text, regexp_extract_all(text, '[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+') AS f FROM {documents}))""")
def emails_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    return rows.select("doc_id", F.when(F.col("text").rlike(T.MAIL), T.emails_only(F.col("text"))).alias("emails"))


@query("""SELECT id, city, region, CASE WHEN region IS NULL OR city IS NULL THEN city
        WHEN region = 'SEOUL' AND regexp_matches(city, '^서울(특별시|광역시|시)?(\\s|$)') THEN nullif(trim(regexp_replace(city, '^서울(특별시|광역시|시)?', '')), '')
        WHEN region = 'BUSAN' AND regexp_matches(city, '^부산(특별시|광역시|시)?(\\s|$)') THEN nullif(trim(regexp_replace(city, '^부산(특별시|광역시|시)?', '')), '')
        WHEN region = 'DAEGU' AND regexp_matches(city, '^대구(특별시|광역시|시)?(\\s|$)') THEN nullif(trim(regexp_replace(city, '^대구(특별시|광역시|시)?', '')), '')
        WHEN region = 'INCHEON' AND regexp_matches(city, '^인천(특별시|광역시|시)?(\\s|$)') THEN nullif(trim(regexp_replace(city, '^인천(특별시|광역시|시)?', '')), '')
        ELSE city END AS bare FROM {phrase}""")
def city_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "phrase").select("id", "city", "region", T.city_without_region(F.col("city"), F.col("region")).alias("bare"))


@query(r"""SELECT id, CASE WHEN regexp_matches(trim(address), '[가-힣A-Za-z0-9]+\s?(로|길)\s*\d') OR regexp_matches(trim(address), '[가-힣]+(동|리|읍)\s*\d') THEN trim(address) END AS address FROM {phrase}""")
def address_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "phrase").select("id", T.address_or_none(F.col("address")).alias("address"))


@query(r"""SELECT id, title, CASE id % 9 WHEN 4 THEN '(대전) ' WHEN 5 THEN '[재공고] ' ELSE '' END || 'posting ' || CAST(id AS STRING) || CASE id % 11 WHEN 2 THEN '...' WHEN 3 THEN '(청빙완료)' ELSE '' END AS clean FROM {phrase}""")
def clean_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "phrase").select("id", "title", T.clean_title(F.col("title")).alias("clean"))


@query("""SELECT id, contains(replace(status, ' ', ''), '완료') OR contains(status, '마감') OR contains(replace(title, ' ', ''), '청빙완료') AS closed FROM {phrase}""")
def closed_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "phrase").select("id", T.closed_by_board(F.col("title"), F.col("status")).alias("closed"))


@query(r"""WITH said AS (SELECT id, due, posted_on, regexp_extract(due, '(20[0-9][0-9])\s*[-./년]\s*([0-9]+)\s*[-./월]\s*([0-9]+)', ['y', 'm', 'd']) AS f, regexp_extract(due, '(20[0-9][0-9])[-./년].*~\s*([0-9]+)\s*[-./월]\s*([0-9]+)', ['y', 'm', 'd']) AS t,
        regexp_extract(due, '^([0-9]+)월 ([0-9]+)일', ['m', 'd']) AS s, regexp_extract(due, '^(20[0-9][0-9])([0-9][0-9])([0-9][0-9])$', ['y', 'm', 'd']) AS c FROM {phrase}),
    told AS (SELECT *, list_max([TRY_CAST(concat(f.y, '-', lpad(f.m, 2, '0'), '-', lpad(f.d, 2, '0')) AS DATE), TRY_CAST(concat(t.y, '-', lpad(t.m, 2, '0'), '-', lpad(t.d, 2, '0')) AS DATE), TRY_CAST(concat(c.y, '-', c.m, '-', c.d) AS DATE)]) AS stated,
        TRY_CAST(concat(year(posted_on), '-', lpad(s.m, 2, '0'), '-', lpad(s.d, 2, '0')) AS DATE) AS short FROM said)
    SELECT id, due, posted_on, coalesce(stated, CASE WHEN short >= posted_on THEN short END) AS deadline FROM told""")
def deadline_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deadlines in phrases."""
    return table(spark, sf_dir, "phrase").select("id", "due", "posted_on", D.deadline_in(F.col("due"), F.col("posted_on")).alias("deadline"))


@query(r"""SELECT id, coalesce(nullif(nullif(regexp_extract(body, '담임목사 ?: ?([가-힣]{{2,4}})\s', 1), ''), '없음'), nullif(regexp_extract(body, '(^|[(\n])담임목사 ([가-힣]{{3,4}})[)\s]', 2), '')) AS pastor FROM {phrase}""".replace("{{", "{").replace("}}", "}"))
def senior_pastor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by their place in a text."""
    return table(spark, sf_dir, "phrase").select("id", senior_pastor_of(F.col("body"), F.lit(None).cast("string")).alias("pastor"))




_KEYS = ", ".join(f"('{w}', '{k}', {_WORDS.index(w)})" for k, listed in denominations.WORDS.items() for w in listed)
_HAS = lambda text, w: f"CASE WHEN regexp_matches({w}, '^[a-z]+$') THEN regexp_matches({text}, '(^|[^a-z])' || {w} || '([^a-z]|$)') ELSE contains({text}, {w}) END"


@query(f"""WITH words(word, key, place) AS (SELECT * FROM (VALUES {_KEYS}) v), bare AS (SELECT id, lower(replace(coalesce(stated, ''), ' ', '')) AS s, text, field FROM {{stated}}),
    met AS (SELECT id, word, key, place FROM bare, words WHERE NOT regexp_matches(s, '니다|[.]') AND {_HAS("s", "word")}),
    alone AS (SELECT * FROM met x WHERE NOT EXISTS (SELECT 1 FROM met y WHERE y.id = x.id AND y.word <> x.word AND contains(y.word, x.word))),
    single AS (SELECT id FROM alone GROUP BY id HAVING count(DISTINCT key) = 1),
    lines AS (SELECT id, lower(replace(unnest(string_split(text, chr(10))), ' ', '')) AS line FROM bare WHERE text IS NOT NULL UNION ALL SELECT id, lower(replace(field, ' ', '')) FROM bare WHERE field IS NOT NULL),
    borne AS (SELECT DISTINCT alone.id, word FROM alone JOIN lines ON alone.id = lines.id WHERE {_HAS("line", "word")} AND (NOT regexp_matches(line, '신대원|신학대학원|졸업|재학|자격|학력|인준') OR contains(line, '본교단'))),
    told AS (SELECT alone.id, max(key) AS key, arg_min(alone.word, place) FILTER (WHERE borne.word IS NOT NULL) AS first, arg_max(alone.word, place) AS last
        FROM alone JOIN single ON alone.id = single.id LEFT JOIN borne ON borne.id = alone.id AND borne.word = alone.word GROUP BY alone.id),
    best AS (SELECT bare.id, key, CASE WHEN first IS NOT NULL THEN first WHEN trim(coalesce(text, '')) = '' THEN last END AS word FROM bare LEFT JOIN told ON bare.id = told.id)
    SELECT id, CASE WHEN word IS NULL THEN 'UNKNOWN' ELSE key END AS key, CASE WHEN word IS NULL THEN 'unknown' ELSE 'stated' END AS source, word FROM best""")
def denomination_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the dictionary, alone, beside and within each other, against texts, requirements and fields."""
    fields = F.when(F.col("field").isNotNull(), F.array("field"))
    return table(spark, sf_dir, "stated").select("id", denominations.confirmed(F.col("stated"), F.col("text"), fields).alias("d")).select("id", "d.*")


@query("""WITH w AS (SELECT id, lower(replace(coalesce(source_line, ''), ' ', '')) AS line, source_line, CASE denomination WHEN '예장합동' THEN '예장합동' WHEN '대한예수교장로회 (백석대신)' THEN '백석대신' WHEN 'PCK' THEN 'pck' END AS alias, denomination FROM {phrase}),
    m AS (SELECT id, source_line, line, unnest(CASE WHEN denomination = 'GAPCK 합동' THEN ['합동', 'gapck'] WHEN alias IS NOT NULL THEN [alias] ELSE ['?'] END) AS alias,
        unnest(CASE WHEN denomination = 'GAPCK 합동' THEN [1, 2] ELSE [1] END) AS o FROM w),
    asks AS (SELECT *, line <> '' AND alias <> '?' AND contains(line, alias) AND NOT (regexp_matches(line, '신대원|졸업') AND NOT contains(line, '본교단')) AS borne FROM m)
    SELECT id, CASE WHEN max(alias) = '?' THEN NULL WHEN bool_or(borne) THEN arg_min(alias, o) FILTER (WHERE borne) WHEN max(source_line) IS NULL THEN arg_max(alias, o) END AS alias FROM asks GROUP BY id""")
def denomination_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = denominations.confirmed(F.col("denomination"), F.col("source_line"), F.lit(None).cast("array<string>"))
    return table(spark, sf_dir, "phrase").select("id", said["word"].alias("alias"))


@query(r"""WITH listed AS (SELECT c_custkey AS entry, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN n_name END AS region, CASE WHEN c_custkey % 3 = 0 THEN '홍길동' END AS pastor FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey),
    asked AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END AS o_custkey, n_name AS region, CASE o_orderkey % 5 WHEN 0 THEN '홍길동' WHEN 1 THEN '김철수' END AS pastor FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey)
    SELECT id, entry, CASE WHEN entry IS NULL THEN NULL WHEN coalesce(a.pastor <> l.pastor, false) THEN 'cleared'
        WHEN CASE WHEN l.region IS NOT NULL THEN a.region = l.region ELSE true END THEN 'conclusive' ELSE 'review' END AS screen FROM asked a LEFT JOIN listed l ON o_custkey = entry""")
def screen_reference_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    listed = people.select(
        F.col("c_custkey").alias("entry"), F.col("c_name").alias("name"), F.array(F.concat(F.lit("("), "n_name", F.lit(") "), F.lower("c_name"))).alias("aliases"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("n_name")).alias("region"), F.when(F.col("c_custkey") % 3 == 0, "홍길동").alias("pastor"))
    asked = table(spark, sf_dir, "orders").join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 4 != 0, F.concat("c_name", F.lit(" [x]"))).alias("church_name"), F.lit(None).cast("string").alias("raw_denomination"), F.col("n_name").alias("region"),
        F.when(F.col("o_orderkey") % 5 == 0, "홍길동").when(F.col("o_orderkey") % 5 == 1, "김철수").alias("senior_pastor"))
    return drafts.screened(asked, listed).select("id", F.col("match.entry").alias("entry"), "screen")


def _graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.array().cast("array<string>")
    return table(spark, sf_dir, "graded_draft").withColumn("positions", F.coalesce(F.split("position_text", r"\+"), none))


GRADED = """graded AS (SELECT *, concat_ws(',', CASE WHEN church_name IS NULL THEN 'church_name' END, CASE WHEN trim(title) = '' THEN 'title' END, CASE WHEN job_kind IS NULL THEN 'job_kind' END,
        CASE WHEN position_text IS NULL AND role IS NULL THEN 'position_or_role' END, CASE WHEN description IS NULL THEN 'description' END,
        CASE WHEN coalesce(contact_email, contact_phone, contact_link, contact_post) IS NULL THEN 'contact' END) AS gaps FROM {graded_draft}),
    rated AS (SELECT *, CASE WHEN gaps <> '' OR gate <> 'YES' OR media_missed OR NOT can_compare THEN 'low'
        WHEN media_sent OR (contact_post IS NOT NULL AND coalesce(contact_email, contact_phone, contact_link) IS NULL) OR heresy_flag THEN 'medium' ELSE 'high' END AS confidence FROM graded),
    told AS (SELECT *, CASE WHEN reject_reason IS NOT NULL THEN 'REJECTED' WHEN confidence = 'high' THEN 'APPROVED' ELSE 'PENDING' END AS review_status FROM rated)"""


@query(f"WITH {GRADED} SELECT id, gaps, confidence, review_status FROM told")
def confidence_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drafts.graded(_graded(spark, sf_dir)).select("id", F.array_join("gaps", ",").alias("gaps"), "confidence", "review_status")


@query("""SELECT id, job_kind, CASE WHEN job_kind = 'MINISTRY' THEN coalesce(position_text, 'ETC') ELSE '' END AS positions, CASE WHEN job_kind = 'GENERAL' THEN coalesce(role, '기타') END AS role,
        CASE WHEN pay_min IS NOT NULL AND pay_max IS NOT NULL THEN least(pay_min, pay_max) ELSE pay_min END AS pay_min, CASE WHEN pay_min IS NOT NULL AND pay_max IS NOT NULL THEN greatest(pay_min, pay_max) ELSE pay_max END AS pay_max FROM {graded_draft}""")
def classification_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drafts.repaired(_graded(spark, sf_dir))
    return out.select("id", "job_kind", F.array_join("positions", "+").alias("positions"), "role", "pay_min", "pay_max")


@query(f"""WITH {GRADED} SELECT id, concat_ws(',', CASE WHEN source_key = 'bad key' THEN 'C1 source key' END, CASE WHEN trim(title) = '' THEN 'C2 blank' END, CASE WHEN gate = 'NO' OR (gate = 'UNCERTAIN' AND confidence <> 'low') THEN 'C3 gate' END,
        CASE WHEN pay_min < 0 OR pay_max < 0 OR pay_min > pay_max THEN 'C4 pay' END, CASE WHEN denomination_source <> 'unknown' AND coalesce(denomination, 'UNKNOWN') = 'UNKNOWN' THEN 'C5 denomination' END,
        CASE WHEN NOT CASE WHEN job_kind IS NULL THEN position_text IS NULL AND role IS NULL ELSE (job_kind = 'MINISTRY') = (position_text IS NOT NULL) AND (job_kind = 'GENERAL') = (role IS NOT NULL) END THEN 'C6 kind' END,
        CASE WHEN heresy_flag AND heresy_evidence IS NULL THEN 'C7 evidence' END, CASE WHEN (coalesce(reject_reason, '') = 'DUPLICATE') <> (dedup_state = 'DUPLICATE') THEN 'C9 duplicate' END) AS violations FROM told""")
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drafts.graded(_graded(spark, sf_dir))
    return out.select("id", F.array_join(drafts.violations(drafts.draft_rules()), ",").alias("violations"))


# Every word of a turn is checked against the document of its conversation's number: it is grounded if it stands there.
CHECKED = r"""said AS (SELECT conv_id, turn, role, string_split(c.text, ' ') AS words, d.text AS source FROM {conversations} c JOIN {documents} d ON doc_id = conv_id),
    quoted AS (SELECT conv_id, turn, source, unnest(words) AS quote, CAST(unnest(range(len(words))) AS INTEGER) AS nth FROM said),
    checked AS (SELECT conv_id, turn, nth, quote, turn % 3 = 1 AS media_sent, coalesce(regexp_replace(quote, '\s', '', 'g') <> ''
        AND contains(regexp_replace(source, '\s', '', 'g'), regexp_replace(quote, '\s', '', 'g')), false) AS grounded FROM quoted)"""


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("nth", "quote"), (F.col("turn") % 3 == 1).alias("media_sent"))
    return turns.join(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), F.col("text").alias("source")), "conv_id")


@query(f"WITH {CHECKED} SELECT conv_id, turn, nth, quote, grounded FROM checked")
def text_squeeze_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select("conv_id", "turn", "nth", "quote", drafts.grounded(F.col("quote"), F.array("source")).alias("grounded"))


@query(f"""WITH {CHECKED} SELECT 'quote' AS field, CASE WHEN media_sent THEN 'unchecked' ELSE 'scrubbed' END AS outcome, count(*) AS n FROM checked WHERE NOT grounded AND trim(quote) <> '' GROUP BY 2""")
def verify_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drafts.tally(drafts.verified(_checked(spark, sf_dir), ["quote"], F.array("source"), F.col("media_sent")))


@query()
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of markup is no SQL relation; tests hold these three against worked examples."""
    return table(spark, sf_dir, "pages").select("page_id", H.normalized_text(F.col("html")).alias("text"))


@query()
def html_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", H.structural_html(F.col("html")).alias("markup"))


@query()
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", H.links(F.col("html"), F.col("url")).alias("l")).select("page_id", "l.images", "l.attachments")


@query(r"""SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '#(.*)$', 1), '') AS ref,
        regexp_extract(url, '^https?://[^/]+/[^/]+/([^/?#&]+)', 1) AS id FROM {pages}""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", U.part(u, "HOST").alias("host"), U.id_from_query(u, "page").alias("page"), U.part(u, "REF").alias("ref"), F.regexp_extract(u, r"^https?://[^/]+/[^/]+/([^/?#&]+)", 1).alias("id"))


@query("""SELECT id, CASE WHEN id % 40 = 0 THEN 'not JSON' WHEN id % 40 = 1 THEN 'k is missing' WHEN id % 40 = 2 THEN 'k is no int' END AS error, CASE WHEN id % 40 > 2 THEN CAST(json_extract_string(payload, '$.k') AS BIGINT) END AS k FROM {answer}""")
def model_answer_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = table(spark, sf_dir, "answer").select("id", answers.parsed(F.col("payload"), {"k": "int"}).alias("a"))
    return out.select("id", F.col("a.error").alias("error"), F.when(F.col("a.error").isNull(), F.col("a.value")["k"].cast("long")).alias("k"))


@query("""SELECT event_id AS id, concat_ws(' | ', CASE WHEN event_id % 3 <> 0 THEN concat('값: ', CAST(round(value, 2) AS STRING)) END, concat('종류: ', event_type)) AS lines FROM {events} WHERE value = value""")
def meta_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("event_id") % 3 == 0, " 본문 참조 ").otherwise(F.round("value", 2).cast("string"))
    meta = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("value"), value, F.lit("views"), F.lit("17"), F.lit("_body"), F.lit("x"))
    return table(spark, sf_dir, "events").where("value = value").select(F.col("event_id").alias("id"), F.array_join(answers.meta_lines(meta, {"kind": "종류", "value": "값"}), " | ").alias("lines"))


@query("""SELECT page_id, array_to_string(list_slice(list_filter([url, CASE WHEN page_id % 2 = 0 THEN concat(url, '&a.PNG') END, CASE WHEN page_id % 3 = 0 THEN concat(url, '&b.pdf') END], lambda u: u IS NOT NULL), 1, 4), ' ') AS urls FROM {pages}""")
def media_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    files = F.filter(F.array(F.when(F.col("page_id") % 3 == 0, F.struct(F.lit("b.pdf").alias("name"), F.concat(u, F.lit("&b.pdf")).alias("url"))),
                             F.when(F.col("page_id") % 2 == 0, F.struct(F.lit("a.PNG").alias("name"), F.concat(u, F.lit("&a.PNG")).alias("url")))), lambda x: x.isNotNull())
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(media.wanted(F.array(u, u), files), " ").alias("urls"))


@query("""SELECT md5(text) AS text_md5, min(doc_id) AS first_id, count(*) AS copies FROM {documents} GROUP BY md5(text)""")
def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(F.md5("text").alias("text_md5")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "draft").select("id", "church_name", "region", F.when(F.col("confidence") == "high", "APPROVED").otherwise("PENDING").alias("review_status"), "published_job_id", "is_owned", "reject_reason")
    new = rows.where("id % 3 <> 0").withColumns({"church_name": F.concat("church_name", F.lit(" new")), "region": F.coalesce("region", F.lit("none")), "published_job_id": F.lit(None).cast("long")})
    return rows.where("id % 5 <> 0"), new


@query("""WITH o AS (SELECT *, CASE WHEN confidence = 'high' THEN 'APPROVED' ELSE 'PENDING' END AS review_status FROM {draft}),
    t AS (SELECT *, CASE WHEN id % 5 = 0 THEN CASE WHEN id % 3 = 0 THEN 'none' ELSE 'inserted' END WHEN id % 3 = 0 THEN 'kept' WHEN NOT is_owned AND (review_status = 'PENDING' OR published_job_id IS NULL) THEN 'replaced' ELSE 'skipped' END AS outcome FROM o)
    SELECT id, CASE WHEN outcome IN ('inserted', 'replaced') THEN concat(church_name, ' new') ELSE church_name END AS church_name, CASE WHEN outcome IN ('inserted', 'replaced') THEN coalesce(region, 'none') ELSE region END AS region,
        CASE WHEN outcome <> 'inserted' THEN published_job_id END AS published_job_id, outcome FROM t WHERE outcome <> 'none'""")
def upsert_drafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _versions(spark, sf_dir)
    can = store.safe_to_replace(F.col("is_owned"), F.col("review_status"), F.col("published_job_id"), F.col("reject_reason"))
    return store.upserted(old, new, "id", ["published_job_id"], can).select("id", "church_name", "region", "published_job_id", "outcome")


@query("""WITH o AS (SELECT *, id % 5 <> 0 AS old, id % 3 <> 0 AS new FROM {draft})
    SELECT id, 'church_name' AS field, CASE WHEN old THEN church_name END AS left_value, CASE WHEN new THEN concat(church_name, ' new') END AS right_value FROM o WHERE old OR new
    UNION ALL SELECT id, 'region', region, 'none' FROM o WHERE old AND new AND region IS NULL""")
def ab_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _versions(spark, sf_dir)
    return store.compared(old.select("id", "church_name", "region"), new.select("id", "church_name", "region"), "id")


@query("""SELECT id, concat_ws('+', CASE WHEN id % 2 = 0 THEN 'CHILDREN' END, 'YOUTH', CASE WHEN id % 3 = 0 THEN 'ETC' END) AS departments FROM {raw}""")
def canonical_enums(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.array(F.when(F.col("id") % 3 == 0, "ETC").otherwise("NONSENSE"), F.lit("YOUTH"), F.when(F.col("id") % 2 == 0, "CHILDREN"), F.lit("YOUTH"))
    return table(spark, sf_dir, "raw").select("id", F.array_join(canonical(said, DEPARTMENT), "+").alias("departments"))
