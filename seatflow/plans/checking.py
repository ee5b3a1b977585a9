"""Queries on whole answers and on checks against the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.operators import checks, schema, verify
from seatflow.plans.registry import VIEWS, query, table
from seatflow.sources import decode
from seatflow.sources.decode import Field

#: The values of an answer's keys where they aren't null, as SQL for the text of a JSON value.
_SAID = {
    "is_church_recruitment": """CASE WHEN event_type = 'error' THEN '"perhaps"' ELSE '" yes"' END""",
    "region": """CASE user_id % 3 WHEN 0 THEN '"seoul"' WHEN 1 THEN '"NOWHERE"' ELSE 'null' END""",
    "job_kind": """CASE WHEN event_id % 12 = 5 THEN '["MINISTRY"]' ELSE '"Ministry"' END""",
    "position": """CASE event_id % 12 WHEN 4 THEN '["ETC"]' WHEN 6 THEN '[]' ELSE concat('[', chr(123), '"value": "evangelist", "evidence": " e', CAST(user_id AS STRING), ' "', chr(125), ', ', chr(123), '"value": "OTHER", "evidence": "x"', chr(125), ']') END""",
    "housing_provided": """CASE WHEN event_id % 12 = 1 THEN '"true"' WHEN user_id % 2 = 0 THEN 'true' ELSE 'null' END""",
    "requirements": """CASE WHEN event_id % 12 = 2 THEN '"one"' ELSE concat('["r', CAST(user_id AS STRING), '", " ", "last"]') END""",
    "preferred": """CASE WHEN event_id % 12 = 3 THEN concat('["', repeat('p", "', 20), 'p"]') WHEN event_id % 12 = 7 THEN concat('["', repeat('x', 301), '"]') ELSE '[]' END""",
    "city": """concat('" city ', CAST(event_id AS STRING), ' "')""",
}
_PARTS = ", ".join(
    f"""CASE WHEN event_id % 12 = 0 THEN '' ELSE concat('"region": ', {_SAID['region']}, ', ') END""" if key == "region" else f"""concat('"{key}": ', {_SAID.get(key, "'null'")}, '{', ' if key != schema.KEYS[-1] else ''}')"""
    for key in schema.KEYS
)
VIEWS["whole_answer"] = f"SELECT event_id AS id, user_id, event_type, concat(CASE WHEN event_id % 12 = 8 THEN '[' ELSE '' END, chr(123), {_PARTS}, chr(125)) AS payload FROM {{events}}"

_FAULTS = {
    8: "no JSON object", 0: "region is missing", 1: "housing_provided is no truth value", 2: "requirements is no list of texts", 3: "preferred has too many items", 4: "position is no list of values with evidence",
    5: "job_kind is no text", 7: "preferred has an item that is too long",
}


@query(f"""WITH told AS (SELECT id, user_id, event_type, CASE id % 12 {' '.join(f"WHEN {k} THEN '{v}'" for k, v in _FAULTS.items())} END AS fault FROM {{whole_answer}})
    SELECT id, fault, CASE WHEN fault IS NULL THEN CASE WHEN event_type = 'error' THEN 'UNCERTAIN' ELSE 'YES' END END AS gate, CASE WHEN fault IS NULL THEN 'MINISTRY' END AS job_kind, CASE WHEN fault IS NULL AND user_id % 3 = 0 THEN 'SEOUL' END AS region,
        CASE WHEN fault IS NULL THEN CASE WHEN id % 12 = 6 THEN '' ELSE concat('EVANGELIST=e', user_id) END END AS positions, CASE WHEN fault IS NULL AND user_id % 2 = 0 THEN true END AS housing,
        CASE WHEN fault IS NULL THEN concat('r', user_id, '|last') END AS requirements, CASE WHEN fault IS NULL THEN concat('city ', id) END AS city FROM told""")
def answer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = schema.answered(table(spark, sf_dir, "whole_answer").select("id", "payload"), "payload")
    pairs = F.array_join(F.zip_with("position", "position_items", lambda a, b: F.concat(a, F.lit("="), b)), "|")
    return out.select("id", "fault", F.col("is_church_recruitment").alias("gate"), "job_kind", "region", pairs.alias("positions"), F.col("housing_provided").alias("housing"), F.array_join("requirements", "|").alias("requirements"), "city")


VIEWS["caller"] = """SELECT c_custkey AS id, c_custkey % 5 AS how,
    concat('010-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0'), '-', lpad(CAST(c_custkey * 7919 % 10000 AS STRING), 4, '0')) AS phone FROM {customer}"""


@query("""WITH said AS (SELECT id, how, phone, replace(phone, '-', '') AS digits FROM {caller})
    SELECT id, how, CASE how WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN contains(translate(concat('call ', left(phone, length(phone) - 1), (CAST(right(phone, 1) AS INTEGER) + 1) % 10), 'cal -', ''), digits) WHEN 3 THEN true ELSE false END AS grounded FROM said""")
def verify_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phone numbers against texts that hold them as they are, in Hangul, with another last digit, in wide digits, or not at all."""
    phone, how = F.col("phone"), F.col("how")
    other = F.concat(F.left(phone, F.length(phone) - 1), ((F.right(phone, F.lit(1)).cast("int") + 1) % 10).cast("string"))
    text = F.when(how == 0, phone).when(how == 1, F.translate(phone, "0123456789", "공일이삼사오육칠팔구")).when(how == 2, other).when(how == 3, F.translate(phone, "0123456789", "０１２３４５６７８９")).otherwise(F.lit("none"))
    return table(spark, sf_dir, "caller").select("id", "how", checks.phones_grounded(phone, F.concat(F.lit("call "), text)).alias("grounded"))


_VALUES = ["SENIOR_PASTOR", "ASSOCIATE_PASTOR", "EVANGELIST", "FULL_TIME", "ETC"]
_EVIDENCE = ["담임 목사 청빙", "담임목사: 홍길동", "부목사 1명", "전도사 모집", "준 전임 사역", "전임 사역자", "Full Time Evangelist"]
_TITLES = ["한빛교회 담임목사 청빙", "한빛교회(담임목사 홍길동) 사무간사 모집", "공고"]


def _pick(names: list[str], at: str) -> str:
    return f"CASE {at} {' '.join(f'''WHEN {i} THEN '{n}' ''' for i, n in enumerate(names))} END"


@query(f"""WITH said AS (SELECT o_orderkey AS id, {_pick(_VALUES, 'o_orderkey % 5')} AS value, lower(replace({_pick(_EVIDENCE, 'o_custkey % 7')}, ' ', '')) AS e, o_custkey % 3 = 0 AS asks FROM {{orders}})
    SELECT id, value, CASE value WHEN 'SENIOR_PASTOR' THEN contains(e, '담임') AND (contains(e, '청빙') OR asks) WHEN 'ASSOCIATE_PASTOR' THEN contains(e, '목사') AND NOT contains(e, '담임')
        WHEN 'EVANGELIST' THEN contains(e, '전도사') OR contains(e, 'evangelist') WHEN 'FULL_TIME' THEN (contains(e, '전임') OR contains(e, 'full')) AND NOT contains(e, '준전임') ELSE true END AS supported FROM said""")
def verify_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda names, at: F.element_at(F.array(*map(F.lit, names)), (at % len(names) + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), pick(_VALUES, F.col("o_orderkey")).alias("value"), pick(_EVIDENCE, F.col("o_custkey")).alias("e"), pick(_TITLES, F.col("o_custkey")).alias("t"))
    return rows.select("id", "value", checks.supports(F.col("value"), F.col("e"), F.col("t")).alias("supported"))


VIEWS["held_answer"] = """
    SELECT o_orderkey AS id, concat('church ', CAST(o_custkey AS STRING), ' road ', CAST(o_orderkey % 50 AS STRING), ' 청년부 전도사 모집 010-1234-', lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0'),
            CASE WHEN o_orderkey % 4 = 0 THEN ' 사택' ELSE '' END, ' pay ', CAST(o_orderkey % 300 AS STRING)) AS text, '공고' AS title, o_orderkey % 10 = 0 AS media,
        concat('church', CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 1 ELSE o_custkey END AS STRING)) AS church_name,
        concat('010 1234 ', lpad(CAST(CASE WHEN o_orderkey % 5 = 0 THEN (o_orderkey + 1) % 10000 ELSE o_orderkey % 10000 END AS STRING), 4, '0'), ' (김영수)') AS contact_tel,
        CASE o_orderkey % 3 WHEN 0 THEN 'YOUNG_ADULT' WHEN 1 THEN 'CHILDREN' END AS department, CASE WHEN o_orderkey % 2 = 0 THEN '청년 부' ELSE '아동부' END AS department_evidence,
        CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN '강도사' ELSE '전도사 모집' END AS item,
        concat('pay ', CAST(CASE WHEN o_orderkey % 11 = 0 THEN 301 ELSE o_orderkey % 300 END AS STRING)) AS pay_amount, CAST(o_orderkey % 300 AS INT) AS pay_min,
        o_orderkey % 8 < 5 AS housing_provided, CASE WHEN o_orderkey % 9 = 0 THEN '청년부' ELSE 'clerk' END AS role
    FROM {orders}"""


@query("""WITH bare AS (SELECT *, replace(text, ' ', '') AS b FROM {held_answer}),
    told AS (SELECT *, contains(b, church_name) AS name_ok, contains(regexp_replace(translate(text, '공영일이삼사오육칠팔구', '00123456789'), '[^0-9]', '', 'g'), regexp_replace(contact_tel, '[^0-9]', '', 'g')) AS tel_ok,
        department IS NULL OR department = 'YOUNG_ADULT' AND department_evidence = '청년 부' AS department_ok, coalesce(item = '전도사 모집', false) AS first_ok, contains(b, replace(pay_amount, ' ', '')) AS pay_ok,
        NOT housing_provided OR contains(b, '사택') AS housing_ok FROM bare),
    said AS (SELECT *, concat_ws(',', CASE WHEN NOT name_ok THEN 'church_name' END, CASE WHEN NOT tel_ok THEN 'contact_tel' END, CASE WHEN NOT first_ok THEN 'position' END, 'position', CASE WHEN NOT department_ok THEN 'department' END,
        CASE WHEN NOT pay_ok THEN 'pay_amount' END, CASE WHEN NOT housing_ok THEN 'housing_provided' END) AS fields FROM told)
    SELECT id, CASE WHEN name_ok OR media THEN church_name END AS church_name, CASE WHEN tel_ok OR media THEN contact_tel END AS contact_tel, CASE WHEN department_ok OR media THEN department END AS department,
        CASE WHEN media THEN 'EVANGELIST+LICENSED_MINISTER' WHEN first_ok THEN 'EVANGELIST' ELSE '' END AS positions, CASE WHEN pay_ok OR media THEN pay_min END AS pay_min, pay_amount,
        CASE WHEN housing_ok OR media THEN housing_provided END AS housing, CASE WHEN housing_ok OR media THEN 'note' END AS housing_note, CASE WHEN media THEN '' ELSE fields END AS dropped,
        CASE WHEN media THEN len(string_split(fields, ',')) ELSE 0 END AS unverifiable, CASE WHEN role = 'clerk' THEN 1 END AS role_unchecked, CASE WHEN housing_ok OR media THEN 1 END AS note_unchecked FROM said""")
def verify_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole answers against their postings: some values are right, some wrong, some of postings whose media were sent."""
    rows = table(spark, sf_dir, "held_answer")
    given = {"position": F.array(F.lit("EVANGELIST"), F.lit("LICENSED_MINISTER")), "position_items": F.array("item", F.lit("강도사")), "housing_note": F.lit("note")}
    named = [f for f, _ in verify.TESTS] + [f"{f}_evidence" for f, test in verify.TESTS if test == "evidence"] + [x for along in verify.ALONG.values() for x in along] + verify.COUNTED
    absent = {f: F.lit(None).cast("string") for f in named if f not in rows.columns and f not in given} | {f: F.lit(None).cast("array<string>") for f in verify.COUNTED_ITEMS}
    none = F.lit(None)
    parts = checks.haystack(F.col("text"), F.col("title"), none.cast("map<string,string>"), {"dept": "부서"}, none.cast("array<string>"))
    out = verify.verified(rows.withColumns(given | absent), parts, F.col("title"), F.col("media"))
    return out.select("id", "church_name", "contact_tel", "department", F.array_join("position", "+").alias("positions"), "pay_min", "pay_amount", F.col("housing_provided").alias("housing"), "housing_note",
        F.array_join("dropped.field", ",").alias("dropped"), "unverifiable", F.col("unchecked")["role"].alias("role_unchecked"), F.col("unchecked")["housing_note"].alias("note_unchecked"))


# rows as they come over a wire: in 14 of 20 some value isn't what it should be
VIEWS["wire_row"] = """
    SELECT event_id AS n, CAST(ts AS DATE) AS d, user_id, concat(CASE WHEN event_id % 20 = 0 THEN '[' ELSE '' END, chr(123), '"id": ', CASE event_id % 20 WHEN 1 THEN 'true' WHEN 2 THEN concat('"', CAST(event_id AS STRING), '"') WHEN 3 THEN '1.5' ELSE CAST(event_id AS STRING) END,
        CASE event_id % 20 WHEN 4 THEN '' WHEN 5 THEN ', "title": null' WHEN 6 THEN ', "title": 5' ELSE concat(', "title": "t', CAST(user_id AS STRING), '"') END,
        ', "open": ', CASE event_id % 20 WHEN 7 THEN '1' WHEN 8 THEN 'null' ELSE 'true' END, ', "posted_on": "', CAST(CAST(ts AS DATE) AS STRING), CASE WHEN event_id % 20 = 9 THEN ' 10:00' ELSE '' END,
        '", "fetched_at": "', CAST(CAST(ts AS DATE) AS STRING), CASE event_id % 20 WHEN 10 THEN 'T10:00:00' WHEN 11 THEN 'T25:00:00Z' WHEN 12 THEN 'T01:00:00Z' ELSE 'T10:00:00+09:00' END,
        '", "files": ', CASE event_id % 20 WHEN 13 THEN '"a"' WHEN 14 THEN '["a", null]' WHEN 15 THEN '[]' ELSE '["a", "b"]' END, CASE WHEN event_id % 20 = 16 THEN ', "extra": 1' ELSE '' END, chr(125)) AS payload FROM {events}"""
WIRE = {"id": Field("whole"), "title": Field("text"), "open": Field("truth", False), "posted_on": Field("day"), "fetched_at": Field("time"), "files": Field("texts", False)}
_WIRE_FAULTS = {
    0: "no JSON object", 1: "id is no whole number", 2: "id is no whole number", 3: "id is no whole number", 4: "title is missing", 5: "title is null", 6: "title is no text", 7: "open is no truth value", 9: "posted_on is no day",
    10: "fetched_at is no time with an offset", 11: "fetched_at is no time with an offset", 13: "files is no list of texts", 14: "files is no list of texts", 16: "extra is unknown",
}


@query(f"""WITH told AS (SELECT n, d, user_id, CASE n % 20 {' '.join(f"WHEN {k} THEN '{v}'" for k, v in _WIRE_FAULTS.items())} END AS fault FROM {{wire_row}})
    SELECT n, fault, CASE WHEN fault IS NULL THEN n END AS id, CASE WHEN fault IS NULL THEN concat('t', user_id) END AS title, CASE WHEN fault IS NULL AND n % 20 <> 8 THEN true END AS open, CASE WHEN fault IS NULL THEN d END AS posted_on,
        CASE WHEN fault IS NULL THEN CAST(date_diff('day', DATE '1970-01-01', d) AS BIGINT) * 86400 + 3600 END AS fetched, CASE WHEN fault IS NULL THEN CASE WHEN n % 20 = 15 THEN '' ELSE 'a|b' END END AS files FROM told""")
def decode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of JSON by the kinds of their values, each fault once."""
    out = decode.decoded(table(spark, sf_dir, "wire_row").select("n", "payload"), "payload", WIRE)
    return out.select("n", "fault", "id", "title", "open", "posted_on", F.unix_timestamp("fetched_at").alias("fetched"), F.array_join("files", "|").alias("files"))
