"""Checks of answers against sources, runs, links and state."""

import datetime

import pytest
from pyspark.sql import functions as F

from seatflow.operators import checks, drafts, ledger, media, runs, store

T = datetime.datetime


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in rows.select("i", expression.alias("x")).orderBy("i").collect()]


def test_grounds(spark):
    source = F.array(F.lit("전화 010-1234-5678 / 교 회 명: 한빛"), F.lit("월 250만원"))
    assert column(spark, ["교회명:한빛", "없는 말", " ", None], drafts.grounded(F.col("v"), source)) == [True, False, False, False]
    assert column(spark, ["010.1234.5678", "010-1234-5679", "no number", None], checks.phones_grounded(F.col("v"), F.array_join(source, "|"))) == [True, False, False, False]
    kept = drafts.choices_grounded(F.array(F.lit("A"), F.lit("B")), F.array(F.col("v")), source)
    assert column(spark, ["한빛", "달빛", None], kept) == [["A"], [], []]
    said = drafts.supported(F.lit("FULL_TIME"), F.col("v"), {"FULL_TIME": ["전임", "풀타임"]}, {"FULL_TIME": ["반전임"]})
    assert column(spark, ["전 임", "반전임", "파트", None], said) == [True, False, False, False]
    checked = drafts.verified(spark.createDataFrame([("한빛", False), ("달빛", False), ("달빛", True)], "name string, media boolean"), ["name"], source, F.col("media")).collect()
    assert [(r["name"], r["scrubbed"], r["unchecked"]) for r in checked] == [("한빛", [], []), (None, ["name"], []), ("달빛", [], ["name"])]


def test_verdict_and_reasons(spark):
    v = F.col("v")
    assert column(spark, ["e", "w", "x", "NO", "YES"], drafts.verdict(v != "e", v == "w", F.when(v == "x", "bad"), v)) == ["EMPTY", "DEFERRED", "FAILED", "EXCLUDED", "DRAFTED"]
    assert column(spark, ["conclusive", "review", None], drafts.reject_reason(v, F.lit(True))) == ["HERESY", "CLOSED", "CLOSED"]
    assert column(spark, ["서울", None], drafts.screen_evidence(F.lit("이름"), F.lit("총회"), F.lit("교회명"), v)) == ["이름 · 총회 · 교회명 · 서울", "이름 · 총회 · 교회명 · 지역 미상"]


def test_state_is_monotone(spark):
    at = T(2026, 1, 1)
    schema = "id long, structured_at timestamp, structure_attempts int, structure_error string"
    rows = spark.createDataFrame([(1, None, 1, "x"), (2, at, 2, None), (3, None, 2, None), (4, None, 0, None)], schema)
    new = spark.createDataFrame([(1, at, 2, None), (2, None, 3, "y"), (3, None, 1, "z")], schema)
    got = {r["id"]: r for r in store.state_updated(rows, new).collect()}
    assert got[1]["structured_at"] == at and got[1]["structure_error"] is None and got[1]["refused"] is None
    assert got[2]["structured_at"] == at and got[2]["refused"] == "the verdict would be lost" and got[3]["refused"] == "attempts would fall" and got[4]["refused"] is None
    state = column(spark, [None, "timeout"], store.attempted(F.lit(1), F.col("v"), F.lit(at)))
    assert [(s["structured_at"], s["structure_attempts"], s["structure_error"]) for s in state] == [(at, 2, None), (None, 2, "timeout")]


def test_links(spark):
    rows = spark.createDataFrame([(1, None), (2, 20), (3, 30), (4, 40)], "id long, published_job_id long")
    pairs = lambda x: spark.createDataFrame(x, "id long, job_id long")
    got = store.linked(rows, pairs([(1, 11), (2, 22)]), pairs([(3, 30), (4, 41)])).collect()
    assert {r["id"]: r["published_job_id"] for r in got} == {1: 11, 2: 20, 3: None, 4: 40}


def test_runs(spark):
    events = spark.createDataFrame([("a", T(2026, 1, 1), "open", None), ("a", T(2026, 1, 1, 1), "close", 3), ("b", T(2026, 1, 2), "open", None), ("c", T(2026, 1, 3), "close", 1)], "run_id string, at timestamp, kind string, n int")
    events = events.select("*", F.lit("daily").alias("mode"), F.col("n").alias("sources_ok"), F.lit(0).alias("sources_failed"), F.lit(0).alias("new_count"))
    got = {r["run_id"]: r for r in runs.current(events).collect()}
    assert got["a"]["sources_ok"] == 3 and got["b"]["finished_at"] is None and got["c"]["error"] == "closed but never opened"
    assert [r["run_id"] for r in runs.recent(runs.current(events).where("error is null"), 1).collect()] == ["b"]
    boards = spark.createDataFrame([("a", "X", 3, None), ("a", "Y", 9, "down"), ("a", "_aborted", 0, "stopped")], "run_id string, source_key string, saved long, error string")
    (s,) = runs.summary(boards).collect()
    assert (s["sources_ok"], s["sources_failed"], s["new_count"], s["error_detail"]) == (1, 1, 3, {"Y": "down", "_aborted": "stopped"})


def test_queue_and_budget(spark):
    rows = spark.createDataFrame([(1, "A", None, 0, datetime.date(2026, 1, 2)), (2, "A", None, 3, datetime.date(2026, 1, 1)), (3, "B", None, 1, datetime.date(2026, 1, 1))], "id long, source_key string, structured_at timestamp, structure_attempts int, posted_on date")
    assert [r["id"] for r in ledger.unstructured(rows, 5).collect()] == [3, 1] and [r["id"] for r in ledger.unstructured(rows, board="A").collect()] == [1]
    files = spark.createDataFrame([(1, 1, 10), (1, 2, 10), (1, 3, 1), (2, 1, 99)], "id long, pos int, n_bytes long")
    assert sorted(tuple(r) for r in media.within_budget(files, 20).collect()) == [(1, 1, 10), (1, 2, 10)]
    assert store.preview(rows, ["id"]).columns == ["posted_on", "source_key", "structure_attempts", "structured_at"]


class Stopped(Exception):
    pass


def test_a_release_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    kinds = {"drafts": "id long, published_job_id long", "jobs": "job_id long, status string"}
    release = store.Release(spark, str(tmp_path / "r"), kinds)
    frames = lambda link, status: {"drafts": spark.createDataFrame([(1, link)], kinds["drafts"]), "jobs": spark.createDataFrame([(7, status)], kinds["jobs"])}
    state = lambda: (release.read("drafts").collect()[0][1], release.read("jobs").collect()[0][1])
    assert release.versions() == {} and release.write(frames(None, "OPEN")) == 0 and state() == (None, "OPEN")

    # stopped after the first table, and before the manifest's row
    from pyspark.sql.readwriter import DataFrameWriter

    for step in ("parquet", "json"):
        done, whole = [], getattr(DataFrameWriter, step)

        def stop(self, path, *args, whole=whole, done=done, step=step, **options):
            if step == "json" or done:
                raise Stopped(path)
            done.append(path)
            return whole(self, path, *args, **options)

        with monkeypatch.context() as patch:
            patch.setattr(DataFrameWriter, step, stop)
            with pytest.raises(Stopped):
                release.write(frames(7, "CLOSED"))
        assert state() == (None, "OPEN")
    assert release.write(frames(7, "CLOSED")) == 1 and state() == (7, "CLOSED")
    # a table that isn't named stays; a release with a fault writes nothing
    assert release.write({"jobs": frames(0, "OPEN")["jobs"]}) == 2 and state() == (7, "OPEN")
    bad = spark.createDataFrame([(7, 1, "x")], "job_id long, status int, note string")
    with pytest.raises(ValueError, match="jobs.note is unknown; jobs.status is int, not string"):
        release.write({"drafts": frames(9, "x")["drafts"], "jobs": bad})
    with pytest.raises(ValueError, match="drafts.published_job_id is missing; other is no table"):
        release.write({"drafts": bad.selectExpr("job_id as id"), "other": bad})
    assert state() == (7, "OPEN") and store.Release(spark, str(tmp_path / "r"), kinds).versions() == {"drafts": 1, "jobs": 2, "": 2}
