"""Strict decoding of JSON rows."""

import datetime

from seatflow.sources import decode
from seatflow.sources.decode import Field

FIELDS = {"id": Field("whole"), "title": Field("text"), "share": Field("number", False), "open": Field("truth", False), "posted_on": Field("day", False), "fetched_at": Field("time", False), "files": Field("texts", False), "meta": Field("any", False)}
GOOD = '"id": 7, "title": "x"'
CASES = [
    (f"{{{GOOD}}}", None), (f'{{{GOOD}, "share": 1.5, "open": true, "posted_on": "2026-02-28", "fetched_at": "2026-02-28T10:00:00+09:00", "files": ["a", ""], "meta": {{"k": [1]}}}}', None),
    (f'{{{GOOD}, "share": null, "open": null, "posted_on": null, "fetched_at": null, "files": null, "meta": null}}', None), (f'{{{GOOD}, "share": 2, "files": []}}', None),
    ("", "no JSON object"), ("[1]", "no JSON object"), ("7", "no JSON object"), (None, "no JSON object"), (f"{{{GOOD}", "no JSON object"), (f'{{{GOOD}, "zzz": 1, "aaa": 2}}', "aaa is unknown"),
    ('{"id": 7}', "title is missing"), ('{"id": 7, "title": null}', "title is null"), ('{"id": true, "title": "x"}', "id is no whole number"), ('{"id": "7", "title": "x"}', "id is no whole number"), ('{"id": 7.5, "title": "x"}', "id is no whole number"),
    ('{"id": 99999999999999999999, "title": "x"}', "id is no whole number"), ('{"id": 7, "title": 5}', "title is no text"), ('{"id": 7, "title": ["x"]}', "title is no text"), (f'{{{GOOD}, "share": true}}', "share is no number"), (f'{{{GOOD}, "share": "1.5"}}', "share is no number"),
    (f'{{{GOOD}, "open": 1}}', "open is no truth value"), (f'{{{GOOD}, "open": "true"}}', "open is no truth value"), (f'{{{GOOD}, "posted_on": "2026-02-30"}}', "posted_on is no day"), (f'{{{GOOD}, "posted_on": "20260228"}}', "posted_on is no day"),
    (f'{{{GOOD}, "posted_on": 20260228}}', "posted_on is no day"), (f'{{{GOOD}, "fetched_at": "2026-02-28T10:00:00"}}', "fetched_at is no time with an offset"), (f'{{{GOOD}, "fetched_at": "2026-02-28"}}', "fetched_at is no time with an offset"),
    (f'{{{GOOD}, "fetched_at": "2026-02-28T25:00:00Z"}}', "fetched_at is no time with an offset"), (f'{{{GOOD}, "files": "a"}}', "files is no list of texts"), (f'{{{GOOD}, "files": ["a", null]}}', "files is no list of texts"), (f'{{{GOOD}, "files": [1]}}', "files is no list of texts"),
]


def test_faults(spark):
    rows = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(CASES)], "n int, payload string")
    got = {r["n"]: r for r in decode.decoded(rows, "payload", FIELDS).collect()}
    assert {n: r["fault"] for n, r in got.items()} == {i: f for i, (_, f) in enumerate(CASES)}
    r = got[1]
    assert (r["id"], r["title"], r["share"], r["open"], r["posted_on"], r["files"], r["meta"]) == (7, "x", 1.5, True, datetime.date(2026, 2, 28), ["a", ""], '{"k":[1]}')
    assert r["fetched_at"].astimezone(datetime.timezone.utc) == datetime.datetime(2026, 2, 28, 1, tzinfo=datetime.timezone.utc)
    assert all(got[i][c] is None for i, (_, f) in enumerate(CASES) if f for c in FIELDS) and got[3]["share"] == 2.0


def test_one_bad_row_does_not_stop_the_others(spark):
    rows = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(CASES)], "n int, payload string")
    good, bad = decode.quarantined(rows, "payload", FIELDS)
    assert sorted(r["n"] for r in good.collect()) == [0, 1, 2, 3] and good.columns == ["n", "payload", *FIELDS]
    assert {r["n"]: (r["payload"], r["fault"]) for r in bad.collect()} == {i: c for i, c in enumerate(CASES) if c[1]}
    assert decode.decoded(rows.limit(0), "payload", FIELDS).collect() == []
