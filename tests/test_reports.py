"""Limits, targets, queues and reports on worked examples."""

import datetime

import pytest
from pyspark.sql import functions as F

from seatflow.functions import dates
from seatflow.operators import drafts, ledger, publish

D = datetime.date


def test_dates_and_limits(spark):
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate([("2026.05.01.", None, 40), ("20260501", 7, None), ("26-5-1", 300, 200), ("2026-05-01 10:00:00", None, None), ("soon", 3, 2), (None, 1, 1)])], "i int, v string, a int, b int")
    out = rows.select("i", dates.board_date(F.col("v")).alias("d"), ledger.page_limit(F.col("a"), F.col("b")).alias("n")).orderBy("i").collect()
    assert [r["d"] for r in out] == [D(2026, 5, 1)] * 4 + [None, None] and [r["n"] for r in out] == [40, 7, 100, 100, 2, 1]
    paths = spark.createDataFrame([("https://h/a/20260501_1.png",), ("20269901.png",), ("poster.png",), (None,)], "v string")
    assert [r[0] for r in paths.select(dates.date_in_path(F.col("v"))).collect()] == [D(2026, 5, 1), None, None, None]
    for wrong in ({}, {"days": 1, "months": 1}, {"days": 0}, {"months": 0}):
        with pytest.raises(ValueError):
            dates.cutoff(F.current_date(), **wrong)


def test_ids_are_compared_without_blanks(spark):
    known = spark.createDataFrame([("B", " 1 ", "t", D(2026, 1, 1))], "source_key string, external_id string, title string, posted_on date")
    rows = spark.createDataFrame([("B", "1", "t", D(2026, 1, 1)), ("B", "2 ", "t", D(2026, 1, 1))], known.schema)
    assert [r["external_id"] for r in ledger.new_postings(rows, known).collect()] == ["2 "]
    listing = rows.withColumns({"page": F.lit(1), "pos": F.lit(0)})
    assert {r["external_id"]: r["verdict"] for r in ledger.page_plan(listing, known, F.lit("2025-01-01").cast("date")).collect()} == {"1": "seen", "2 ": "fresh"}


def test_probes_targets_and_budget(spark):
    bodies = spark.createDataFrame([('{"code": 42004}',), ('{"code": "10000"}',), ('{"code": 1}',), ("<html>",), (None,)], "v string")
    assert [r[0] for r in bodies.select(publish.probed(F.col("v"))).collect()] == ["gone", "alive", "unknown", "unknown", "unknown"]
    pages = spark.createDataFrame([("t", [], [], None), (" ", ["i"], None, None), (None, None, ["f"], None), (" ", [], None, None), ("t", [], [], "404")], "x string, i array<string>, f array<string>, e string")
    assert [r[0] for r in pages.select(publish.detail_alive(F.col("x"), F.col("i"), F.col("f"), F.col("e"))).collect()] == [True, True, True, False, False]
    rows = spark.createDataFrame([(i, D(2026, 1, 30 - i), "EMPTY" if i % 3 == 0 else "DRAFTED") for i in range(9)], "id long, posted_on date, verdict string")
    assert sorted(r["id"] for r in drafts.within_budget(rows, 2).collect()) == [0, 3, 6, 7, 8]


def test_listed_records(spark, tmp_path):
    import json

    from pyspark.sql import types as t

    from seatflow.sources import records

    def read(name, value):
        (tmp_path / name).write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False))
        return {r["name"]: r["faults"] for r in records.restricted_list(spark, str(tmp_path / name)).collect()}

    good = {"name": "가", "aliases": ["나"], "ruled_by": [], "region": "SEOUL"}
    assert read("a.json", {"version": 2, "entries": [good, {"name": "다"}]}) == {"가": [], "다": []}
    found = read("b.json", {"version": 2, "entries": [{**good, "note": 1}, {"aliases": []}, {"name": " "}, {"name": "라", "region": "MARS"}]})
    assert found["가"] == ["unknown note"] and found[" "] == ["blank name"] and found["라"] == ["unknown region"] and found[None] == ["missing name", "blank name"]
    assert read("c.json", {"version": 1, "entries": [good]})[None] == ["another version"] and read("d.json", {"version": 2, "entries": [], "x": 1})[None] == ["unknown field", "no records"]
    assert read("e.json", "[")[None] == ["no JSON object", "no records", "another version"]
    rows = records.restricted_list(spark, str(tmp_path / "b.json"))
    with pytest.raises(Exception, match="faulty record"):
        records.refused(rows).collect()
    assert [r["name"] for r in records.refused(records.restricted_list(spark, str(tmp_path / "a.json"))).orderBy("name").collect()] == ["가", "다"]

    flags = t.StructType([t.StructField("http_only", t.BooleanType()), t.StructField("www_required", t.BooleanType())])
    boards = spark.createDataFrame([("A", "https://h/l", None), ("B", "http://h/l", (True, False)), ("C", "http://h/l", (False, False)), ("D", "https://www.h/l", (False, True)), ("E", "https://h/l", (False, True)), ("A", "https://h/l", None)],
                                   t.StructType([t.StructField("key", t.StringType()), t.StructField("list_url", t.StringType()), t.StructField("flags", flags)]))
    told = records.with_faults(boards.withColumn("faults", F.array().cast("array<string>")), records.flag_rules(), unique="key")
    got = {r["key"]: r["faults"] for r in told.collect()}
    assert got == {"A": ["not unique"], "B": [], "C": ["flags against scheme"], "D": [], "E": ["flags against host"]}
    assert records.by_key(boards, " b ").count() == 1


def test_accounts_of_a_run(spark):
    """Board A reads well, B's details all fail, C saves only empty rows, D has a conflict, E has no dates, F reads nothing new."""
    day = datetime.date(2026, 5, 1)
    planned = [("A", str(i), f"a{i}", day if i else None, 1 + i // 4, i % 4, "fresh" if i < 5 else "seen") for i in range(6)] + [("A", "9", "old", datetime.date(2020, 1, 1), 2, 3, "stale")]
    planned += [(b, str(i), f"{b}{i}", None if b == "E" else day, 1, i, v) for b, v in (("B", "fresh"), ("C", "fresh"), ("D", "fresh"), ("E", "fresh"), ("F", "seen")) for i in range(2)] + [("D", "7", "d", day, 1, 7, "conflict")]
    read = [("A", "0", True, "x", None, None, None), ("A", "1", True, " ", [], None, None), ("A", "2", False, "x", None, None, None), ("A", "3", None, None, None, None, "timeout"), ("A", "4", True, None, ["p.png"], None, None)]
    read += [("B", str(i), None, None, None, None, f"refused {i}") for i in range(2)] + [("C", str(i), True, "", None, [], None) for i in range(2)] + [(b, "0", True, "x", None, None, None) for b in "DE"]
    kinds = "source_key string, external_id string, title string, posted_on date, page int, pos int, verdict string", "source_key string, external_id string, inserted boolean, text string, images array<string>, attachments array<string>, error string"
    frames = spark.createDataFrame(planned, kinds[0]).repartition(3), spark.createDataFrame(read, kinds[1])
    got = {r["source_key"]: r for r in ledger.accounts(*frames, F.lit(True)).collect()}
    a = got["A"]
    assert (a["pages"], a["fresh"], a["seen"], a["stale"], a["details"], a["saved"], a["empty"], a["failed"]) == (2, 5, 1, 1, 4, 3, 1, 1)
    assert (a["oldest"], a["newest"], a["samples"], a["failures"]) == (day, day, ["a0", "a1", "a2"], ["3: timeout"])
    assert {b: r["fault"] for b, r in got.items()} == {"A": None, "B": "nothing was saved", "C": "all that was saved is empty", "D": "conflicts", "E": "no dates for the cutoff", "F": None}
    assert got["B"]["failures"] == ["0: refused 0", "1: refused 1"] and got["F"]["samples"] is None and got["F"]["saved"] == 0
    assert {r["source_key"]: r["fault"] for r in ledger.accounts(*frames, F.lit(False)).collect()}["E"] is None
