"""Ledger, seats, publication, health, store, boards: small tables with known answers."""

import datetime
import random

from pyspark.sql import functions as F

from seatflow.operators import answers, dedup, drafts, graph, health, ledger, media, publish, store
from seatflow.plans.catalog import ORACLE_SQL, QUERIES
from seatflow.sources import boards, records, robots

D = datetime.date
TODAY = "2026-06-01"
FIELDS = (
    "id long, posted_on date, posted_at date, church_name string, region string, positions array<string>, role string, department string, mailboxes array<string>, city string, address string, "
    "deadline date, confidence string, is_owned boolean, completeness int, is_anchor boolean, review_status string, reject_reason string, gone_at date"
)


def draft(i, on, **more):
    base = dict(id=i, posted_on=on, posted_at=on, church_name="한빛교회", region="SEOUL", positions=["EVANGELIST"], role=None, department=None, mailboxes=["a@b.c"], city="중구", address="길 1",
                deadline=None, confidence="high", is_owned=False, completeness=1, is_anchor=False, review_status="PENDING", reject_reason=None, gone_at=None)
    return {**base, **more}


def plan(spark, rows):
    return {r["id"]: r for r in dedup.planned(spark.createDataFrame(rows, FIELDS), F.lit(TODAY).cast("date")).collect()}


def test_rounds_master_and_keys(spark):
    got = plan(spark, [draft(1, D(2026, 1, 1)), draft(2, D(2026, 3, 31)), draft(3, D(2026, 6, 30)), draft(4, D(2026, 10, 1)), draft(5, D(2026, 1, 1), region=None)])
    assert {i: r["dedup_state"] for i, r in got.items()} == {1: "DUPLICATE", 2: "DUPLICATE", 3: "MASTER", 4: "ALONE"}
    assert got[3]["dedup_key"] == "한빛교회:SEOUL:EVANGELIST:-:R1" and got[4]["dedup_key"].endswith("R2")
    assert got[1]["review_status"] == "REJECTED" and got[1]["reject_reason"] == "DUPLICATE" and got[3]["review_status"] == "APPROVED"


def test_departments(spark):
    one = plan(spark, [draft(1, D(2026, 1, 1), department="YOUTH"), draft(2, D(2026, 1, 2))])
    assert {r["dedup_state"] for r in one.values()} == {"MASTER", "DUPLICATE"} and one[2]["dedup_key"].endswith(":YOUTH:R1")
    two = plan(spark, [draft(1, D(2026, 1, 1), department="YOUTH"), draft(2, D(2026, 1, 2), department="CHILDREN"), draft(3, D(2026, 1, 3))])
    assert {r["dedup_state"] for r in two.values()} == {"UNCERTAIN"} and two[3]["dedup_key"].endswith(":-:R1")
    assert sorted(r["review_status"] for r in two.values()) == ["APPROVED", "PENDING", "PENDING"]
    apart = plan(spark, [draft(1, D(2026, 1, 1), department="YOUTH"), draft(2, D(2026, 1, 2), department="CHILDREN")])
    assert {r["dedup_state"] for r in apart.values()} == {"ALONE"}


def test_mailboxes_and_places(spark):
    far = plan(spark, [draft(1, D(2026, 1, 1)), draft(2, D(2026, 1, 2), mailboxes=["x@y.z"], address="길 9")])
    assert {r["dedup_state"] for r in far.values()} == {"ALONE"}
    near = plan(spark, [draft(1, D(2026, 1, 1)), draft(2, D(2026, 1, 2), mailboxes=["x@y.z"])])
    assert {r["dedup_state"] for r in near.values()} == {"MASTER", "DUPLICATE"}
    unknown = plan(spark, [draft(1, D(2026, 1, 1)), draft(2, D(2026, 1, 2), mailboxes=["x@y.z"], address=None)])
    assert {r["dedup_state"] for r in unknown.values()} == {"UNCERTAIN"}


def test_owned_rows_and_anchors(spark):
    got = plan(spark, [draft(1, D(2026, 1, 1), is_owned=True, review_status="APPROVED"), draft(2, D(2026, 1, 2)), draft(3, D(2026, 1, 3), is_anchor=True, church_name="새빛교회", is_owned=True), draft(4, D(2026, 1, 4), church_name="새빛교회")])
    assert got[1]["dedup_state"] == "MASTER" and got[1]["posted_at"] == D(2026, 1, 1) and got[2]["dedup_state"] == "DUPLICATE"
    assert 3 not in got and got[4]["dedup_state"] == "DUPLICATE"
    both = plan(spark, [draft(1, D(2026, 1, 1), is_owned=True), draft(2, D(2026, 1, 2), is_owned=True)])
    assert {r["dedup_state"] for r in both.values()} == {"UNCERTAIN"}


def test_closed_seats(spark):
    rows = [draft(1, D(2026, 1, 1), deadline=D(2026, 2, 1)), draft(2, D(2026, 1, 20)), draft(3, D(2026, 3, 1)), draft(4, D(2026, 1, 5), deadline=D(2026, 7, 1))]
    assert set(plan(spark, rows)) == {3, 4}
    settled = plan(spark, [draft(1, D(2026, 1, 1), reject_reason="HERESY"), draft(2, D(2026, 1, 2), gone_at=D(2026, 1, 9)), draft(3, D(2026, 1, 3))])
    assert set(settled) == {3} and settled[3]["dedup_state"] == "ALONE"


def test_key_merges(spark):
    got = plan(spark, [draft(1, D(2026, 1, 1)), draft(2, D(2026, 1, 2), church_name="큰한빛교회"), draft(3, D(2026, 1, 3), positions=["ETC"]), draft(4, D(2026, 1, 4), church_name="다른교회"), draft(5, D(2026, 1, 5), church_name="큰한빛교회", mailboxes=["q@q.q"], region="BUSAN")])
    assert {got[i]["dedup_key"] for i in (1, 2, 3)} == {"큰한빛교회:SEOUL:EVANGELIST:-:R1"}
    assert got[4]["dedup_state"] == got[5]["dedup_state"] == "ALONE"
    # a bridge between two names that disagree is taken down whole
    bridged = plan(spark, [draft(1, D(2026, 1, 1), church_name="가나교회"), draft(2, D(2026, 1, 2), church_name="가나다라교회"), draft(3, D(2026, 1, 3), church_name="다라교회")])
    assert {r["dedup_state"] for r in bridged.values()} == {"ALONE"}


def test_order_does_not_matter_and_twice_changes_nothing(spark):
    rng = random.Random(3)
    rows = []
    for i in range(120):
        rows.append(draft(i, D(2026, 1, 1) + datetime.timedelta(days=rng.randint(0, 200)), church_name=rng.choice(["가교회", "가 교회", "가나교회", "라교회"]), department=rng.choice([None, None, "YOUTH"]),
                          mailboxes=rng.choice([[], ["a@b"], ["c@d"]]), address=rng.choice([None, "길 1", "길 12"]), is_owned=rng.random() < 0.05, deadline=rng.choice([None, None, None, D(2026, 2, 1)])))
    one = plan(spark, rows)
    rng.shuffle(rows)
    assert plan(spark, rows) == one
    again = [{**r, **{k: one[r["id"]][k] for k in ("review_status", "reject_reason", "posted_at")}} if r["id"] in one else r for r in rows]
    assert {i: (r["dedup_key"], r["dedup_state"], r["posted_at"]) for i, r in plan(spark, again).items()} == {i: (r["dedup_key"], r["dedup_state"], r["posted_at"]) for i, r in one.items()}
    assert plan(spark, [r for r in rows if r["id"] < 0]) == {}


def test_split_by_place_is_first_fit(spark):
    rows = [(i, 1, D(2026, 1, i), "중구", a) for i, a in enumerate(["길 1", "길 12", "길 1 호", None, "길 12", "길 3"], 1)]
    frame = spark.createDataFrame(rows, "id long, g int, posted_on date, city string, address string")
    assert {r["id"]: r["cluster"] for r in dedup.split_by_place(frame, ["g"]).collect()} == {1: 1, 2: 2, 3: 1, 4: None, 5: 2, 6: 3}


def test_components(spark):
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 51)], "a long, b long")).collect())
    assert got == {i: 0 for i in range(21)} | {50: 50, 51: 50}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_page_plan(spark):
    known = spark.createDataFrame([("B", "1", "old  title", D(2026, 5, 1)), ("B", "2", "t", D(2026, 5, 1))], "source_key string, external_id string, title string, posted_on date")
    rows = [("B", "1", "oldtitle", D(2026, 5, 2), 1, 0), ("B", "2", "u", D(2026, 5, 2), 1, 1), ("B", "3", "n", None, 1, 2), ("B", "4", "n", D(2025, 1, 1), 1, 3), ("B", "3", "n", None, 2, 0)]
    listing = spark.createDataFrame(rows, "source_key string, external_id string, title string, posted_on date, page int, pos int")
    planned = ledger.page_plan(ledger.first_seen(listing), known, F.to_date(F.lit("2026-01-01")))
    assert {r["external_id"]: r["verdict"] for r in planned.collect()} == {"1": "seen", "2": "conflict", "3": "fresh", "4": "stale"}
    assert [tuple(r) for r in ledger.stop_pages(planned).collect()] == [("B", 1, 1)]
    assert {r["external_id"] for r in ledger.new_postings(listing, known).collect()} == {"3", "4"}


def test_health_fold_against_a_loop(spark):
    rng = random.Random(1)
    rows = [(k, D(2026, 1, d), rng.choice(["OK", "EMPTY", "FAIL"]), rng.randint(0, 5), rng.randint(0, 3), rng.choice([None, D(2025, 11, d)]), rng.choice([None, D(2025, 12, d)])) for k in "abc" for d in range(1, 15)]
    got = {r["source_key"]: r for r in health.fold(spark.createDataFrame(rows, "source_key string, run_at date, status string, n_rows long, new_count long, cutoff date, newest date")).collect()}
    for k in "abc":
        failures = empties = 0
        newest = last = n_rows = cutoff = fresh = None
        for _, at, s, n, many, since, new in [r for r in rows if r[0] == k]:
            failures = failures + 1 if s == "FAIL" else 0
            empties = 0 if s == "OK" else empties + (s == "EMPTY")
            newest, last, n_rows = new or newest, at if s == "OK" else last, n if s != "FAIL" else n_rows
            if s != "FAIL":
                fresh, cutoff = many, since or cutoff
        r = got[k]
        assert (r["failures"], r["empty_runs"], r["newest"], r["last_success"], r["n_rows"], r["new_count"], r["cutoff"]) == (failures, empties, newest, last, n_rows, fresh, cutoff)


def test_quiet_boards(spark):
    rows = [("old", 5, None, D(2026, 3, 1)), ("young", 5, None, D(2026, 5, 1)), ("no dates", 5, None, None), ("none since", 5, D(2026, 4, 1), None), ("not read", 0, D(2026, 4, 1), D(2020, 1, 1))]
    boards_ = spark.createDataFrame([(k, n, c, d, 0, 0) for k, n, c, d in rows], "source_key string, n_rows long, cutoff date, newest date, failures long, empty_runs long")
    got = {r["source_key"]: r["alerts"] for r in health.alerts(boards_, F.lit(TODAY).cast("date")).collect()}
    assert got == {"old": ["quiet"], "young": [], "no dates": [], "none since": ["quiet"], "not read": []}


def test_gone_stop_pages(spark):
    new, old = D(2026, 5, 1), D(2025, 1, 1)
    listing = [("A", "1", new, 1, 0), ("A", "2", old, 1, 1), ("A", "3", old, 2, 0), ("A", "4", old, 3, 0), ("A", "5", new, 4, 0)]  # old pages count from the floor on
    listing += [("B", "1", new, 1, 0), ("B", "2", new, 2, 0), ("B", "2", new, 3, 0), ("B", "3", new, 4, 0), ("C", "1", None, 1, 0)]
    frame = spark.createDataFrame(listing, "source_key string, external_id string, posted_on date, page int, pos int")
    targets = spark.createDataFrame([("A",)] * 5 + [("B",)], "source_key string")
    got = {r["source_key"]: (r["floor_page"], r["stop_page"]) for r in ledger.gone_stop_pages(frame, targets, F.lit("2026-04-01").cast("date")).collect()}
    assert got == {"A": (3, 3), "B": (1, 3), "C": (1, 1)}


def test_new_postings_keep_the_first_read(spark):
    rows = [("B", "1", f"t{i}", D(2026, 1, 9 - i)) for i in range(6)]
    frame = spark.createDataFrame(rows, "source_key string, external_id string, title string, posted_on date").repartition(5)
    (r,) = ledger.new_postings(frame, frame.limit(0)).collect()
    assert r["title"] == "t5"


def test_mailbox_clash_and_places_against_pairs(spark):
    rng = random.Random(12)
    sets = [["a"], ["b"], ["a", "b"], ["b", "c"], ["c", "a"], ["a", "b", "c"], ["d", "a"], []]
    rows = [(g, rng.choice(sets), rng.choice(["길1", "길12", "길1호", "큰길1호", "", None]), "중구") for g in range(60) for _ in range(rng.randint(1, 4))]
    frame = spark.createDataFrame(rows, "g int, mailboxes array<string>, address string, city string")
    clash = {r["g"]: r["clash"] for r in dedup.mailbox_clash(frame, ["g"]).collect()}
    same = {r["g"]: r["same"] for r in dedup.same_place(frame, ["g"]).collect()}

    def fit(a, b):
        short, long = sorted((a, b), key=len)
        at = long.find(short)
        return at >= 0 and not long[max(0, at - 1) : at].isdigit() and not long[at + len(short) : at + len(short) + 1].isdigit()

    for g in range(60):
        own = [set(m) for k, m, _, _ in rows if k == g and m]
        assert clash.get(g) == (any(not a & b for a in own for b in own) if own else None)
        roads = [a for k, _, a, _ in rows if k == g and a]
        assert same.get(g) == (all(fit(a, b) for a in roads for b in roads) if len(roads) > 1 else None)


def test_crowded_mailboxes_find_the_same_pairs(spark, monkeypatch):
    rng = random.Random(5)
    names = ["가교회", "가나교회", "가나다교회", "나다교회", "교회", "라교회", "큰라교회", "가 나"]
    rows = [draft(i, D(2026, 1, 1), church_name=rng.choice(names), mailboxes=["a@b"], positions=rng.choice([["EVANGELIST"], ["ETC"], ["EVANGELIST", "YOUTH"]]), address=None) for i in range(60)]
    members = dedup.judged(dedup.with_seat(spark.createDataFrame(rows, FIELDS)))
    found = []
    for crowd in (64, 1):
        monkeypatch.setattr(dedup, "CROWD", crowd)
        found.append({(tuple(r["a"]), tuple(r["b"])) for r in dedup.variant_edges(members).collect()})
    assert found[0] == found[1] and len(found[0]) > 20


PAGE = "source_key string, external_id string, text string, images array<string>, attachments array<string>, error string, body string"


def swept(spark, targets, listing, boards, pages):
    frames = [
        spark.createDataFrame([(i, b, str(i)) for i, b in targets], "id long, source_key string, external_id string"),
        spark.createDataFrame([(b, str(i), page, pos) for b, i, page, pos in listing], "source_key string, external_id string, page int, pos int"),
        spark.createDataFrame(boards, "source_key string, check string"),
        spark.createDataFrame([(b, str(i), *answer) for b, i, *answer in pages], PAGE),
    ]
    return publish.gone_sweep(*frames)


ALIVE, EMPTY, TIMEOUT = ("text", None, None, None, None), ("  ", [], None, None, None), (None, None, None, "timeout", None)


def test_gone_by_the_postings_own_page(spark):
    """Ten of twelve are listed; of the two candidates one lives on its own page, whatever the list says."""
    listing = [("A", i, 1, i) for i in range(10)]
    controls = [("A", 0, *ALIVE), ("A", 1, None, ["poster.png"], None, None, None)]
    for answer, want in ((ALIVE, "alive"), (EMPTY, "gone"), (TIMEOUT, "gone"), ((None, None, ["a.hwp"], None, None), "alive"), (("", ["x"], None, None, None), "alive")):
        got = {r["id"]: (r["verdict"], r["guard"]) for r in swept(spark, [(i, "A") for i in range(12)], listing, [("A", "page")], [*controls, ("A", 10, *answer)]).collect()}
        assert got == {**{i: ("listed", None) for i in range(10)}, 10: (want, None), 11: ("unknown", None)}


def test_gone_by_an_interface(spark):
    coded = lambda code, error=None: (None, None, None, error, f'{{"code": "{code}"}}')
    listing = [("A", i, 1, i) for i in range(10)]
    pages = [("A", 0, *coded(10000)), ("A", 1, *coded(10000)), ("A", 10, *coded(42004)), ("A", 11, *coded(10000)), ("A", 12, *coded(42004, "timeout"))]
    got = {r["id"]: r["verdict"] for r in swept(spark, [(i, "A") for i in range(13)], listing, [("A", "interface")], pages).collect()}
    assert [got[i] for i in (9, 10, 11, 12)] == ["listed", "gone", "alive", "unknown"]


def test_gone_guards(spark):
    """A is judged; B loses too many, C lists nothing, D's control is dead, E can't ask, F has nothing to look for."""
    ids = {"A": range(20), "B": range(30, 44), "C": [50], "D": range(60, 70), "E": range(80, 90), "F": range(90, 93)}
    kept = {"A": 18, "B": 9, "C": 0, "D": 9, "E": 9, "F": 3}
    listing = [(b, i, 1, n) for b, x in ids.items() for n, i in enumerate(list(x)[: kept[b]])]
    boards = [(b, None if b == "E" else "page") for b in ids]
    pages = [(b, i, *(EMPTY if (b, i) in (("D", 61), ("A", 18), ("A", 19), ("F", 90)) else ALIVE)) for b, x in ids.items() for i in x]
    found = swept(spark, [(i, b) for b, x in ids.items() for i in x], listing, boards, pages)
    got = {r["id"]: (r["verdict"], r["guard"]) for r in found.collect()}
    assert got[3] == ("listed", None) and got[18] == got[19] == ("gone", None)
    assert got[43] == ("held", "bulk") and got[50] == ("held", "nothing listed") and got[69] == ("held", "a control isn't alive") and got[89] == ("held", "no second check")
    assert got[90] == ("listed", None)  # no candidate, so no control is asked
    # a control beyond the first two, or on a later page, decides nothing
    later = [(b, i, 2 if i == 61 else p, n) for b, i, p, n in listing]
    got = {r["id"]: r["verdict"] for r in swept(spark, [(i, b) for b, x in ids.items() for i in x], later, boards, pages).collect()}
    assert got[69] == "alive"
    rows = spark.createDataFrame([(18, None), (19, D(2026, 1, 1)), (3, None), (50, None)], "id long, gone_at date")
    marked = publish.marked_gone(rows, found, F.lit(TODAY).cast("date"))
    assert {r["id"]: r["gone_at"] for r in marked.collect()} == {18: D(2026, 6, 1), 19: D(2026, 1, 1), 3: None, 50: None}


def test_store(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "id long, state string, note string")
    out, unknown = store.with_updates(rows, spark.createDataFrame([(1, "c"), (2, "b"), (9, "z")], "id long, state string"), "id")
    assert {r["id"]: (r["state"], r["changed"]) for r in out.collect()} == {1: ("c", True), 2: ("b", False)} and [r["id"] for r in unknown.collect()] == [9]
    again, _ = store.with_updates(out.drop("changed"), spark.createDataFrame([(1, "c")], "id long, state string"), "id")
    assert not any(r["changed"] for r in again.collect())
    snaps = store.Snapshots(spark, str(tmp_path / "t"))
    assert snaps.version() is None and snaps.write(rows) == 0 and snaps.write(rows.where("id = 1")) == 1 and snaps.read().count() == 1
    diff = store.compared(rows, rows.withColumn("state", F.lit("b")).where("id < 2"), "id").collect()
    assert {(r["id"], r["field"]) for r in diff} == {(1, "state"), (2, "state")}


def test_answers_media_and_rules(spark):
    rows = spark.createDataFrame([('{"k": 3}',), ('{"k": "x"}',), ("{}",), ("{",), (None,)], "v string")
    assert [r["e"] for r in rows.select(answers.parsed(F.col("v"), {"k": "int"})["error"].alias("e")).collect()] == [None, "k is no int", "k is missing", "not JSON", "not JSON"]
    data = spark.createDataFrame([(b"\xff\xd8\xff\xe0",), (b"%PDF-1.7",), (b"RIFF\0\0\0\0WEBPVP8 ",), (b"no",), (None,)], "v binary")
    assert [r["k"] for r in data.select(media.sniffed(F.col("v")).alias("k")).collect()] == ["image/jpeg", "application/pdf", "image/webp", None, None]
    good, bad = drafts.quarantined(spark.createDataFrame([(1,), (-1,)], "n int"), {"n": F.col("n") > 0})
    assert good.count() == 1 and bad.first()["violations"] == ["n"]


LIST = """<table><tr class=notice><td>공지<td><a href="?no=1">n</a><td>2026-01-01<tr><td>12<td><a href="/view.php?no=5">제목 <em>new</em></a><td>2026-01-02<tr><td>11<td><a onclick="go(7)" href="?no=7">둘</a><td>01-03</table>"""


def test_boards(spark):
    spec = {"X": boards.Spec(rows="table tr", link="a", date=2, number=0, notice=".notice", badge="em", body="div.body", hidden="p.hidden", files="ul.files")}
    pages = spark.createDataFrame([("X", 1, "https://h/l.php", LIST), ("X", 2, "https://h/l.php", "<p>down</p>"), ("Y", 1, "https://h", LIST)], "source_key string, page int, url string, html string")
    rows = boards.listings(pages, spec).collect()
    assert [(r["external_id"], r["title"], r["date_text"], r["url"]) for r in rows if r["external_id"]] == [("5", "제목", "2026-01-02", "https://h/view.php?no=5"), ("7", "둘", "01-03", "https://h/l.php?no=7")]
    assert {r["error"] for r in rows if not r["external_id"]} == {"no rows", "no spec"}
    detail = spark.createDataFrame([("X", "https://h/v", "<div class=body><p class=hidden>no</p><p>text</p><img src=a.png></div><ul class=files><a href=f.pdf>f.pdf</a></ul>"), ("X", "https://h/v", "<p>x")], "source_key string, url string, html string")
    one, two = boards.details(detail, spec).collect()
    assert one["raw_text"] == "text" and one["image_urls"] == ["https://h/a.png"] and one["attachments"][0]["url"] == "https://h/f.pdf" and two["error"] == "no body"


def test_board_irregularities(spark):
    spec = boards.Spec(rows="li", link="a", date=None, locked=".lock", empty="p.none", encoded_body=True, body="textarea", files="div.f", script_files=r"down\('([^']+)','([^']+)'\)")
    assert boards.read_list("<p class=none>nothing</p>", "https://h", spec) == ([], None)
    rows, error = boards.read_list("<li><a href='?no=1'>a</a><li class=x><i class=lock></i><a href='?no=2'>b</a>", "https://h/", spec)
    assert [r["external_id"] for r in rows] == ["1"] and error is None
    assert boards.read_list("<li><a href='?no=1'>a</a><li><a href='?no=1'>b</a>", "https://h/", spec)[1] == "an id comes twice"
    page = "<textarea>&lt;p&gt;inner &lt;b&gt;text&lt;/b&gt;&lt;/p&gt;</textarea><div class=f><a onclick=\"down('/f/1','plan.pdf')\">x</a></div>"
    got = boards.details(spark.createDataFrame([("X", "https://h/v", page)], "source_key string, url string, html string"), {"X": spec}).first()
    assert got["raw_text"] == "inner text" and got["attachments"][0]["name"] == "plan.pdf" and got["attachments"][0]["url"] == "https://h/f/1"
    answers_ = spark.createDataFrame([("J", 1, '{"code": "0", "data": {"list": [{"no": 5, "t": "a", "d": "20260102", "who": "secret", "v": "None"}, {"no": 6, "t": " ", "d": "x", "v": "7"}]}}'), ("J", 2, '{"code": "9", "data": {"list": []}}'), ("J", 3, "<html>")], "source_key string, page int, body string")
    found = boards.json_listing(answers_, boards.JsonSpec("data.list", "no", "t", "d", keep=("v",), code="code", ok=("0",))).orderBy("page", "pos").collect()
    assert [(r["external_id"], r["title"], r["meta"], r["error"]) for r in found] == [("5", "a", {}, None), ("6", None, {"v": "7"}, None), (None, None, found[2]["meta"], "the answer says no"), (None, None, found[3]["meta"], "not JSON")]
    urls = boards.page_addresses(spark.createDataFrame([("K", "https://h/l?a=1", "offset", 0, 50)], "source_key string, list_url string, param string, first_page int, page_step int"), 3)
    assert [r["url"] for r in urls.orderBy("page").collect()] == ["https://h/l?a=1", "https://h/l?a=1&offset=50", "https://h/l?a=1&offset=100"]


def test_robots(spark):
    body = "User-agent: *\nCrawl-delay: 2.5\n\nUser-agent: other\nUser-agent: ourbot # us\nCrawl-delay: 7\nUser-agent: x\nCrawl-delay: 99"
    rows = spark.createDataFrame([("a", body), ("b", "User-agent: *\nCrawl-delay: 3"), ("c", None), ("d", "User-agent: z\nCrawl-delay: 4")], "host string, body string")
    assert dict(tuple(r) for r in robots.crawl_delays(rows, "OurBot/1.0").collect()) == {"a": 7.0, "b": 3.0}


def test_records(spark, tmp_path):
    import pytest

    (tmp_path / "x.json").write_text('{"key": "A", "enabled": true}\n{"key": \n')
    good, bad = records.json_records(spark, str(tmp_path / "x.json"), records.BOARD)
    assert good.count() == 1 and bad.count() == 1
    with pytest.raises(ValueError, match="missing"):
        records.require_columns(good.drop("key"), records.BOARD)
    assert records.require_columns(good, records.BOARD).columns == records.BOARD.names


def test_every_query_has_a_name_of_its_own():
    assert set(ORACLE_SQL) <= set(QUERIES) and len(QUERIES) > 50


def test_blanks_are_no_part_of_a_key(spark):
    rows = spark.createDataFrame([("A", " 7", 1), ("A", "7", 2), ("B", "7 ", 3)], "source_key string, external_id string, id long")
    none = rows.where("false").select("source_key", "external_id")
    assert sorted(r["id"] for r in ledger.new_postings(rows, none).collect()) == [1, 3]
