"""A day: answers to drafts, verdicts, publication; a second pass changes nothing."""

import datetime
import json

from pyspark.sql import functions as F

from seatflow.operators import daily, schema
from seatflow.operators.graph import checkpointed

D = datetime.date


def tables(spark):
    raw = spark.createDataFrame(
        [(1, "B", "1", "(끌어올림) 한빛교회 교육전도사", "한빛교회 서울 송파구 테헤란로 12 메일: a@b.org 월 90~120만원 2026.7.31 까지", {"status": "진행"}, D(2026, 5, 1)),
         (2, "B", "2", "한빛교회 청빙", "한빛교회 서울시 송파구 a@b.org", {}, D(2026, 5, 20)),
         (3, "B", "3", "청빙완료 달빛교회", "달빛교회 중구 010-1234-오육칠8", {}, D(2026, 5, 2)),
         (4, "B", "4", "광고", "팝니다", {}, D(2026, 5, 3)),
         (5, "B", "5", "별빛교회", "별빛교회 부산 c@d.org", None, D(2026, 5, 4))],
        "id long, source_key string, external_id string, title string, raw_text string, raw_meta map<string,string>, posted_on date")
    fields = ("gate", "church_name", "region", "city", "address", "job_kind", "positions", "role", "department", "description", "contact_email", "contact_phone", "contact_link", "contact_post", "raw_denomination", "pay_amount", "pay_note", "deadline_text")
    base = dict.fromkeys(fields) | {"gate": "YES", "job_kind": "ministry", "positions": ["evangelist", "NONSENSE"], "description": "d", "region": "seoul"}
    rows = [
        {**base, "id": 1, "church_name": "한빛교회", "city": "서울 송파구", "address": "테헤란로 12", "contact_email": "메일: a@b.org", "pay_amount": "월 90~120만원", "deadline_text": "2026.7.31 까지"},
        {**base, "id": 2, "church_name": "한빛교회", "city": "서울시 송파구", "contact_email": "a@b.org", "address": "지어낸로 9"},
        {**base, "id": 3, "church_name": "달빛교회", "contact_phone": "010-1234-5678"}, {**base, "id": 4, "gate": "no"}, {**base, "id": 5, "church_name": "별빛교회", "region": "busan", "contact_email": "c@d.org"},
    ]
    kinds = ", ".join(["id long"] + [f"{f} {'array<string>' if f == 'positions' else 'string'}" for f in fields])
    answers = spark.createDataFrame([{k: r.get(k) for k in ("id", *fields)} for r in rows], kinds).withColumns({"media_sent": F.lit(False), "media_missed": F.lit(False)})
    reference = spark.createDataFrame([(1, "별빛교회", ["별빛 교회(부산)"], "BUSAN", None)], "entry long, name string, aliases array<string>, region string, pastor string")
    return raw, answers, reference


def test_a_day(spark):
    today = F.lit("2026-06-01").cast("date")
    raw, answers, reference = tables(spark)
    made = checkpointed(daily.built(raw, answers, reference, today))  # each pass writes a snapshot that the next one reads
    got = {r["id"]: r for r in made.collect()}
    assert set(got) == {1, 2, 3, 5}
    one = got[1]
    assert (one["title"], one["city"], one["contact_email"], one["pay_min"], one["pay_max"], one["pay_period"]) == ("한빛교회 교육전도사", "송파구", "a@b.org", 90, 120, "MONTH")
    assert one["deadline"] == D(2026, 7, 31) and one["positions"] == ["EVANGELIST"] and one["confidence"] == "high" and one["review_status"] == "APPROVED"
    assert got[2]["address"] is None and got[2]["scrubbed"] == ["address"]
    assert got[3]["contact_phone"] == "010-1234-5678" and got[3]["scrubbed"] == []
    assert got[3]["reject_reason"] == "CLOSED" and got[5]["reject_reason"] == "HERESY" and got[5]["review_status"] == "REJECTED"

    rows = made.withColumns({
        "mailboxes": F.when(F.col("contact_email").isNotNull(), F.array("contact_email")).otherwise(F.array().cast("array<string>")), "is_owned": F.lit(False), "is_anchor": F.lit(False),
        "gone_at": F.lit(None).cast("date"), "completeness": daily.content(["city", "address", "deadline", "pay_min", "heresy_flag", "positions"]), "published_job_id": F.lit(None).cast("long"),
    })
    assert {r["id"]: r["completeness"] for r in rows.collect()}[1] == 5
    after, unknown = daily.judged(rows, today)
    after = checkpointed(after)
    state = {r["id"]: (r["dedup_state"], r["review_status"], r["posted_at"]) for r in after.collect()}
    assert unknown.count() == 0 and state[1] == ("MASTER", "APPROVED", D(2026, 5, 20)) and state[2][:2] == ("DUPLICATE", "REJECTED") and state[3][0] is None
    again, _ = daily.judged(after.drop("changed"), today)
    assert not any(r["changed"] for r in again.collect())

    jobs = spark.createDataFrame([], "job_id long, posted_at date, church_id long")
    changes = daily.published(after, jobs)
    new = changes["insert"].collect()
    assert [r["id"] for r in new] == [1] and new[0]["status"] == "OPEN" and changes["release"].count() == changes["bump"].count() == 0
    linked = after.withColumn("published_job_id", F.when(F.col("id") == 1, F.lit(new[0]["job_id"])))
    there = spark.createDataFrame([(new[0]["job_id"], D(2026, 5, 1), None)], "job_id long, posted_at date, church_id long")
    later = daily.published(linked, there)
    assert later["insert"].count() == 0 and [r["posted_at"] for r in later["bump"].collect()] == [D(2026, 5, 20)]
    assert [r["id"] for r in daily.published(linked, jobs)["release"].collect()] == [1]


def test_an_answer_without_a_posting_is_an_error(spark):
    import pytest

    raw, answers, reference = tables(spark)
    with pytest.raises(Exception, match="no posting for answer 1"):
        daily.built(raw.where("id <> 1"), answers, reference, F.lit("2026-06-01").cast("date")).collect()


def test_a_day_from_what_the_model_said(spark):
    """Whole payloads to drafts: what the posting doesn't bear out is dropped with its reason, a bad payload fails alone."""
    today = F.lit("2026-06-01").cast("date")
    raw, _, reference = tables(spark)
    empty = dict.fromkeys(schema.KEYS) | {"is_church_recruitment": "YES", "job_kind": "MINISTRY", "position": [], "requirements": [], "preferred": [], "required_docs": [], "optional_docs": [], "process_steps": []}
    said = {
        1: empty | {"church_name": "한빛교회", "region": "SEOUL", "region_evidence": "서울", "city": "서울 송파구", "address": "테헤란로 12", "contact_email": "a@b.org", "pay_amount": "월 90~120만원", "deadline": "2026.7.31 까지",
                    "position": [{"value": "EVANGELIST", "evidence": "교육전도사"}, {"value": "SENIOR_PASTOR", "evidence": "담임"}], "description": "d", "role": "교육 담당", "raw_denomination": "합동"},
        2: empty | {"church_name": "한빛교회", "region": "BUSAN", "region_evidence": "부산", "pay_amount": "연 3200만원", "deadline": "8월 말", "contact_tel": "010-9999-9999"},
        3: {k: v for k, v in empty.items() if k != "city"}, 4: empty | {"is_church_recruitment": "NO"}, 77: empty,
    }
    payloads = spark.createDataFrame([(i, json.dumps(p, ensure_ascii=False), False, False) for i, p in said.items()], "id long, payload string, media_sent boolean, media_missed boolean")
    answers, failed = daily.answered(raw, payloads, {"status": "상태"})
    assert {tuple(r) for r in failed.collect()} == {(3, "city is missing"), (77, "no posting")}
    answers = checkpointed(answers)
    told = {r["id"]: [tuple(d) for d in r["dropped"]] for r in answers.collect()}
    assert told == {1: [("raw_denomination", "합동", None), ("position", "SENIOR_PASTOR", "담임")], 2: [("contact_tel", "010-9999-9999", None), ("region", "BUSAN", "부산"), ("pay_amount", "연 3200만원", None), ("deadline_text", "8월 말", None)], 4: []}
    got = {r["id"]: r for r in daily.built(raw, answers, reference, today).collect()}
    assert set(got) == {1, 2}
    one, two = got[1], got[2]
    assert (one["pay_min"], one["pay_max"], one["deadline"], one["positions"], one["city"], one["contact_email"], one["region"]) == (90, 120, D(2026, 7, 31), ["EVANGELIST"], "송파구", "a@b.org", "SEOUL")
    assert (one["denomination"], one["denomination_source"], one["counted"]) == ("UNKNOWN", "unknown", {"role": 1})
    assert (two["pay_min"], two["deadline"], two["region"], two["contact_phone"]) == (None, None, None, None)
