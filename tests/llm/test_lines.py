"""Line dedup against brute force, and its edge cases."""

from pyspark.sql import functions as F

from seatflow.llm import lines

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least_chars=10, least_documents=2):
    """rows: (doc_id, text) with ids that aren't null."""
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            held.setdefault(line.strip(BLANKS).translate(LOWER), set()).add(i)
    out = []
    for i, text in rows:
        split, kept = (text or "").split("\n"), []
        for line in split:
            key = line.strip(BLANKS).translate(LOWER)
            if len(key) < least_chars or len(held[key]) < least_documents or min(held[key]) == i:
                kept.append(line)
        out.append((i, len(split), len(split) - len(kept), "\n".join(kept)))
    return sorted(out)


def ours(frame, **options):
    return sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in lines.without_repeated_lines(frame, **options).collect())


ROWS = [
    (5, "Terms Of Service apply\n\nbody one\n\tterms of service APPLY\r\nend"),
    (3, "terms of service apply \x0b\nbody two\nbody two, longer line\nbody two, longer line\n"),
    (9, "short\nTERMS OF SERVICE APPLY"),
    (7, "short\n0123456789\n 012345678 "),
    (8, "0123456789\n012345678\n" * 3),
    (11, "ÄÖÜ äöü éèê\nÄÖÜ äöü ÉÈÊ\n🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂"),
    (12, "äöü äöü éèê\nÄÖÜ äöü ÉÈÊ\n🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂\n🙂🙂🙂🙂🙂🙂🙂🙂🙂"),
    (13, None), (14, ""), (15, "\n"), (16, "\n\n\n"), (17, "\xa0no-break space stays\xa0"), (18, "no-break space stays"),
    (20, "every line of this one\nterms of service apply"), (2, "every line of this one"),
]


def test_lines_against_brute_force(spark, documents, texts):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)
    assert ours(frame) == brute(ROWS)
    dropped = {i: kept for i, _, n, kept in ours(frame) if n}
    assert dropped[20] == "" and dropped[5] == "\nbody one\nend" and 12 in dropped and 18 not in dropped
    assert ours(documents) == brute(texts)


def test_lines_by_other_thresholds(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string")
    for least_chars, least_documents in ((1, 2), (10, 3), (0, 2), (22, 4)):
        assert ours(frame, least_chars=least_chars, least_documents=least_documents) == brute(ROWS, least_chars, least_documents)


def test_line_edges(spark, nothing, awkward):
    assert lines.without_repeated_lines(nothing).collect() == []
    out = lines.without_repeated_lines(awkward.withColumns({"n_lines": F.lit("x"), "_gone": F.lit("y"), "_text": F.lit("z")}))
    got = out.collect()
    assert len(got) == 8 and {r["_gone"] for r in got} == {"y"} and {r["_text"] for r in got} == {"z"} and {r["n"] for r in got} == {"clash"}
    assert [(r["n_lines"], r["n_dropped"], r["kept"]) for r in got if r["doc_id"] == 2] == [(1, 1, "")]


def test_lines_of_rows_that_share_an_id(spark):
    """One document in several rows: their common lines stay, and each row loses the lines of a smaller id, wherever they stand in it."""
    rows = [(4, "a line that recurs\nanother line here"), (4, "another line here\na line that recurs"), (4, "another line here\na line that recurs"), (1, "a line that recurs"), (None, "a line that recurs\nof no id at all"), (None, "of no id at all")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_dropped"], r["kept"]) for r in lines.without_repeated_lines(frame).collect())
    assert got == [(0, 0, "a line that recurs\nof no id at all"), (0, 0, "of no id at all"), (1, 0, "a line that recurs")] + [(4, 1, "another line here")] * 3


def test_one_text_of_very_many_lines(spark):
    many = "\n".join(f"line number {i:06d}" for i in range(60_000))
    rows = [(1, many[: len(many) // 2]), (2, many), (3, many)]
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in lines.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1][1] == 0 and 29_000 < got[2][1] < 31_000 and got[3] == (60_000, 60_000)
