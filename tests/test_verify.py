"""Verification of whole answers by the table of tests."""

import datetime

import pytest
from pyspark.sql import functions as F

from seatflow.operators import checks, verify

N = None
TEXT = """한빛교회에서 부목사와 전도사를 모집합니다.
청년부 담당, 준전임. 신대원 졸업자.
연락처 010-2720-구육구이 / 메일 doyu78@네이버,com 홈페이지 www,hanbit.org
월 200만원, 사택 제공. 서울시 송파구 올림픽로 12. 마감 7월 말"""
BASE = dict(
    church_name="한빛 교회", raw_denomination=N, city="송파구", address="올림픽로 12", contact_email="doyu78@naver.com (김민성)", contact_tel="010-2720-9692 (목사)", contact_link="https://www.hanbit.org (홈페이지)",
    position=["ASSOCIATE_PASTOR", "EVANGELIST"], position_items=["부목사", "전도사를 모집"], department="YOUNG_ADULT", department_evidence="청년부 담당", employment_type="SEMI_FULL_TIME", employment_type_evidence="준전임",
    qualification="SEMINARIAN", qualification_evidence="신대원 졸업자", region="SEOUL", region_evidence="서울시", pay_amount="월 200만원", pay_min=200, pay_max=N, pay_period="MONTH", deadline_text="7월 말", deadline=datetime.date(2026, 7, 31),
    housing_provided=True, housing_note="사택 제공", role="부교역자", start_timing=N, work_days=N, headcount=N, pay_note=N, benefit_note="4대보험", contact_post=N,
    requirements=["신대원 졸업자", "세례 교인"], preferred=[], required_docs=N, optional_docs=["증명서", "통장"], process_steps=[],
)
KINDS = {"position": "array<string>", "position_items": "array<string>", "pay_min": "int", "pay_max": "int", "deadline": "date", "housing_provided": "boolean", **{k: "array<string>" for k in verify.COUNTED_ITEMS}}
SCHEMA = ", ".join(f"{k} {KINDS.get(k, 'string')}" for k in BASE) + ", text string, title string, media boolean"


def run(spark, *changes, text=TEXT, title="공고", media=False):
    rows = spark.createDataFrame([(*{**BASE, **c}.values(), text, title, media) for c in changes], SCHEMA)
    none = F.lit(None)
    parts = checks.haystack(F.col("text"), F.col("title"), none.cast("map<string,string>"), {"dept": "부서"}, none.cast("array<string>"))
    return verify.verified(rows, parts, F.col("title"), F.col("media")).collect()


def test_what_the_posting_bears_out_stays(spark):
    (r,) = run(spark, {})
    assert r["dropped"] == [] and r["unverifiable"] == 0
    assert r["unchecked"] == {"role": 1, "benefit_note": 1, "requirements": 1, "optional_docs": 2}
    assert {k: r[k] for k in BASE} == BASE


WRONG = [
    ({"church_name": "다른교회"}, {"church_name": N}, [("church_name", "다른교회", N)]),
    ({"raw_denomination": "  "}, {"raw_denomination": N}, [("raw_denomination", "  ", N)]),
    ({"city": "강남구"}, {"city": N}, [("city", "강남구", N)]),
    ({"address": "올림픽로 13"}, {"address": N}, [("address", "올림픽로 13", N)]),
    ({"contact_email": "other@naver.com"}, {"contact_email": N}, [("contact_email", "other@naver.com", N)]),
    ({"contact_email": "김민성"}, {"contact_email": N}, [("contact_email", "김민성", N)]),
    ({"contact_tel": "010-2720-9693"}, {"contact_tel": N}, [("contact_tel", "010-2720-9693", N)]),
    ({"contact_tel": "없음"}, {"contact_tel": N}, [("contact_tel", "없음", N)]),
    ({"contact_link": "www.other.org"}, {"contact_link": N}, [("contact_link", "www.other.org", N)]),
    ({"position_items": ["부목사", "강도사"]}, {"position": ["ASSOCIATE_PASTOR"], "position_items": ["부목사"]}, [("position", "EVANGELIST", "강도사")]),
    ({"position_items": ["전도사를 모집"]}, {"position": [], "position_items": []}, [("position", "ASSOCIATE_PASTOR", "전도사를 모집"), ("position", "EVANGELIST", N)]),
    ({"employment_type": "FULL_TIME"}, {"employment_type": N}, [("employment_type", "FULL_TIME", "준전임")]),
    ({"department_evidence": N}, {"department": N}, [("department", "YOUNG_ADULT", N)]),
    ({"region_evidence": "부산"}, {"region": N}, [("region", "SEOUL", "부산")]),
    ({"pay_amount": "연 3200"}, {"pay_min": N, "pay_period": N, "pay_amount": "연 3200"}, [("pay_amount", "연 3200", N)]),
    ({"deadline_text": "8월 말"}, {"deadline": N}, [("deadline_text", "8월 말", N)]),
    ({"deadline_text": N}, {"deadline": BASE["deadline"]}, []),
    ({"housing_provided": False}, {"housing_provided": False, "housing_note": "사택 제공"}, []),
]


def test_what_it_does_not_goes(spark):
    for r, (change, want, dropped) in zip(run(spark, *[c for c, *_ in WRONG]), WRONG):
        assert {k: r[k] for k in {**BASE, **change}} == {**BASE, **change, **want}, change
        assert [tuple(d) for d in r["dropped"]] == dropped


def test_where_media_were_sent_nothing_goes(spark):
    changes = [c for c, *_ in WRONG]
    for r, (change, _, dropped) in zip(run(spark, *changes, media=True), WRONG):
        assert {k: r[k] for k in {**BASE, **change} if not k.startswith("position")} == {k: v for k, v in {**BASE, **change}.items() if not k.startswith("position")}
        assert r["dropped"] == [] and r["unverifiable"] == len(dropped) and r["position"] == BASE["position"]


def test_housing_that_no_one_speaks_of(spark):
    (r,) = run(spark, {}, text=TEXT.replace("사택", "차량"))
    assert r["housing_provided"] is None and r["housing_note"] is None and ("housing_provided", "true", None) in [tuple(d) for d in r["dropped"]] and "housing_note" not in r["unchecked"]
    (r,) = run(spark, {}, text=TEXT.replace("사택", "차량"), media=True)
    assert r["housing_provided"] and r["unchecked"]["housing_note"] == 1


@pytest.mark.parametrize(("title", "kept"), [("담임목사 청빙", ["SENIOR_PASTOR"]), ("<담임목사 홍길동> 사무간사 모집", [])])
def test_a_senior_pastor_by_the_title(spark, title, kept):
    (r,) = run(spark, {"position": ["SENIOR_PASTOR"], "position_items": ["담임목사 1명"]}, text="담임목사 1명", title=title)
    assert r["position"] == kept


def test_numbers_do_not_run_over_parts(spark):
    (r,) = run(spark, {"contact_tel": "010-1234-5678"}, text="010-1234-56", title="78")
    assert r["contact_tel"] is None


def test_tally(spark):
    rows = spark.createDataFrame([([("a", "x", N), ("a", "y", N)], {"r": 2}), ([("b", "x", N)], {"r": 1})], f"dropped {verify.DROPPED}, unchecked map<string,int>")
    assert {tuple(r) for r in verify.tally(rows).collect()} == {("a", "dropped", 2), ("b", "dropped", 1), ("r", "unchecked", 3)}
