"""Answers by their whole schema, and checks of answers against their source."""

import json

from pyspark.sql import functions as F

from seatflow.operators import checks, schema
from seatflow.plans import checking

N = None


def answer(**more):
    base = {k: None for k in schema.KEYS} | {"is_church_recruitment": "yes", "position": [{"value": " evangelist", "evidence": " 전도사 1명 "}, {"value": "POPE", "evidence": "x"}, {"value": "ETC"}], "requirements": [" a ", "", "b"], "housing_provided": True}
    return base | more


def test_whole_answers(spark):
    gone = answer()
    gone.pop("region")
    cases = [
        (answer(region="seoul", department="nonsense", city=" 중구 ", role=" "), None), (answer(is_church_recruitment="perhaps"), None), (answer(requirements=["x"] * 20), None), (answer(description="y" * 5000), None),
        (gone, "region is missing"), (answer(housing_provided="true"), "housing_provided is no truth value"), (answer(requirements="a, b"), "requirements is no list of texts"), (answer(requirements=["a", 3]), "requirements is no list of texts"),
        (answer(requirements=["a", None]), "requirements is no list of texts"), (answer(preferred=["x"] * 21), "preferred has too many items"), (answer(preferred=["x" * 301]), "preferred has an item that is too long"), (answer(position=["ETC"]), "position is no list of values with evidence"),
        (answer(position=[{"evidence": "x"}]), "position is no list of values with evidence"), (answer(role=7), "role is no text"), (answer(region=["SEOUL"]), "region is no text"), (answer(is_church_recruitment=True), "is_church_recruitment is no text"),
    ]
    rows = [(i, json.dumps(a, ensure_ascii=False)) for i, (a, _) in enumerate(cases)] + [(90, "[1]"), (91, "{"), (92, None), (93, '"x"')]
    frame = spark.createDataFrame(rows, "i int, payload string")
    got = {r["i"]: r for r in frame.select("i", *[c.alias(k) for k, c in schema.parsed(F.col("payload")).items()]).collect()}
    assert [got[i]["fault"] for i in range(len(cases))] == [want for _, want in cases]
    assert {got[i]["fault"] for i in (90, 91, 92, 93)} == {"no JSON object"} and got[91]["position"] is None
    r = got[0]
    assert (r["is_church_recruitment"], r["region"], r["department"], r["city"], r["role"], r["housing_provided"]) == ("YES", "SEOUL", None, "중구", None, True)
    assert (r["position"], r["position_items"], r["requirements"], r["preferred"]) == (["EVANGELIST", "ETC"], ["전도사 1명", ""], ["a", "b"], [])
    assert got[1]["is_church_recruitment"] == "UNCERTAIN" and len(got[3]["description"]) == 5000 and len(schema.KEYS) == 35


def test_answers_of_a_table_are_parsed_once(spark):
    """A payload is parsed in one place of the plan, whatever is selected; columns are those of parsed, one by one."""
    gone = answer()
    gone.pop("city")
    said = [answer(region="seoul"), answer(role=7), gone, answer(requirements=["a", None]), answer(position=["ETC"]), answer(position=[{"value": "etc", "evidence": N}]), answer(CITY="x"), [], N]
    frame = spark.createDataFrame([(i, "old", json.dumps(a)) for i, a in enumerate(said)] + [(90, "old", "{"), (91, "old", N)], "i int, city string, payload string")
    told = schema.answered(frame, "payload")
    one = frame.select("i", *[c.alias(k) for k, c in schema.parsed(F.col("payload")).items()])
    assert told.columns == one.columns and {r["i"]: r for r in told.collect()} == {r["i"]: r for r in one.collect()}
    for some in (told, told.where("fault is null").select("i", "city", "requirements"), told.select(F.zip_with("position", "position_items", lambda a, b: F.concat(a, b))), checking.answer_schema(spark, "/root/testdata/sf0.001")):
        assert some._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_numbers_and_hosts(spark):
    cases = [
        ("010-2720-9692", "연락 010-2720-구육구이", True), ("010-2285-1151 (김준수 목사)", "문의 010.2285.1151", True), ("010-1234-5678, 02-333-4444", "010 1234 5678 / 02)333-4444", True), ("010-1234-5678", "010-1234-5679", False),
        ("０１０-1234-5678", "010-1234-5678", True), ("사오육칠팔구", "456789", False), ("없음", "010", False), (N, "010", False), ("010-1234-5678", N, False),
    ]
    frame = spark.createDataFrame([(i, v, s) for i, (v, s, _) in enumerate(cases)], "i int, v string, s string")
    assert [r["x"] for r in frame.select("i", checks.phones_grounded(F.col("v"), F.col("s")).alias("x")).orderBy("i").collect()] == [w for *_, w in cases]
    cases = [("doyu78@naver.com", "메일 doyu78@네이버.com 으로", True), ("a@네이버.com", "A@naver.com", True), ("www.x.com", "www,x.com", True), ("b@naver.com", "a@naver.com", False), ("", "x", False), (N, "x", False)]
    frame = spark.createDataFrame([(i, v, s) for i, (v, s, _) in enumerate(cases)], "i int, v string, s string")
    assert [r["x"] for r in frame.select("i", checks.address_grounded(F.col("v"), F.col("s")).alias("x")).orderBy("i").collect()] == [w for *_, w in cases]


def test_supporting_words(spark):
    cases = [
        ("ASSOCIATE_PASTOR", "부목사 1명", "", True), ("ASSOCIATE_PASTOR", "담임목사", "", False), ("SENIOR_PASTOR", "담임목사: 박은제", "부목사 청빙", False), ("SENIOR_PASTOR", "담임목사 청빙", "", True), ("SENIOR_PASTOR", "담임목사 1명", "강릉교회 담임목사 청빙", True),
        ("SENIOR_PASTOR", "담임목사 1명", "현대교회(담임목사 박건욱)에서 사무간사님을 모십니다", False), ("FULL_TIME", "준 전임 사역자", "", False), ("FULL_TIME", "평일은 상근직", "", True), ("EXPERIENCED", "Work Experience", "", True), ("ETC", "", "", True), (N, "x", "", N), ("YOUTH", N, N, False),
    ]
    frame = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, v string, e string, t string")
    assert [r["x"] for r in frame.select("i", checks.supports(F.col("v"), F.col("e"), F.col("t")).alias("x")).orderBy("i").collect()] == [c[3] for c in cases]


def test_what_is_looked_at(spark):
    frame = spark.createDataFrame([("본문 글\n\n둘째", "제목", {"dept": "장년 교구", "views": "3"}, ["공고 문.hwp"]), (N, N, N, N)], "text string, title string, meta map<string,string>, files array<string>")
    one, none = frame.select(checks.haystack(F.col("text"), F.col("title"), F.col("meta"), {"dept": "모집부서"}, F.col("files")).alias("h"), checks.source_lines(F.col("text"), F.col("meta")).alias("l")).collect()
    assert set(one["h"]) == {"본문글둘째", "제목", "장년교구", "3", "모집부서:장년교구", "공고문.hwp"} and none["h"] == []
    assert one["l"][-2:] == ["본문 글", "둘째"] and set(one["l"][:-2]) == {"장년 교구", "3"} and none["l"] == []
