"""Stated denominations: words within words, lines that don't count, postings without a text."""

import pytest
from pyspark.sql import functions as F

from seatflow.operators import denominations

CASES = [
    ("예장 합동", "저희는 예장합동 소속", [], ("HAPDONG", "stated", "예장합동")),
    ("합동", "합동", [], ("HAPDONG", "stated", "합동")),
    ("합동신학", "합동신학 대학원", [], ("UNKNOWN", "unknown", None)),  # a requirement: a seminary's name
    ("합동신학", "합동신학", [], ("HAPSIN", "stated", "합동신학")),
    ("백석대신", "백석 대신", [], ("BAEKSEOK", "stated", "백석대신")),
    ("대한예수교장로회 독립교회 (고신에서 독립함)", "고신", [], ("UNKNOWN", "unknown", None)),
    ("합동교단과 교류 교단입니다.", "합동", [], ("UNKNOWN", "unknown", None)),
    ("통합", "자격: 통합 신대원 졸업", [], ("UNKNOWN", "unknown", None)),
    ("통합", "자격: 본 교단(통합) 신대원 졸업", [], ("TONGHAP", "stated", "통합")),
    ("통합", "자격: 통합 신대원 졸업\n통합 교단", [], ("TONGHAP", "stated", "통합")),
    ("통합", "다른 말", [], ("UNKNOWN", "unknown", None)),
    ("통합", "다른 말", ["통합측"], ("TONGHAP", "stated", "통합")),
    ("통합", "", [], ("TONGHAP", "stated", "통합")),
    ("통합", None, ["기타"], ("TONGHAP", "stated", "통합")),
    ("PCK", "GAPCK 소속", [], ("UNKNOWN", "unknown", None)),  # a Latin word within another
    ("PCK", "소속: pck.", [], ("TONGHAP", "stated", "pck")),
    ("PCKWORLD", "pckworld", [], ("UNKNOWN", "unknown", None)),
    ("나사렛성결", "나사렛 성결", [], ("ETC", "stated", "나사렛성결")),
    ("기하성 순복음", "기하성\n순복음", [], ("SUNBOK", "stated", "순복음")),
    ("기하성 순복음", "기하성", [], ("SUNBOK", "stated", "기하성")),
    ("기하성 순복음", " \n ", [], ("SUNBOK", "stated", "기하성")),
    ("초교파", "초교파", [], ("UNKNOWN", "unknown", None)),
    (None, "합동", [], ("UNKNOWN", "unknown", None)),
    ("", "", [], ("UNKNOWN", "unknown", None)),
]


def test_confirmed(spark):
    rows = spark.createDataFrame([(i, *case[:3]) for i, case in enumerate(CASES)], "id int, stated string, text string, fields array<string>")
    got = {r["id"]: tuple(r["d"]) for r in rows.select("id", denominations.confirmed(F.col("stated"), F.col("text"), F.col("fields")).alias("d")).collect()}
    assert got == {i: case[3] for i, case in enumerate(CASES)}


@pytest.mark.parametrize("size", [20])
def test_found_is_every_word_that_stands_in_the_text(spark, size):
    """The one pattern against each word tried by itself."""
    import itertools
    import re

    each = [(w, k) for k, listed in denominations.WORDS.items() for w in listed]
    texts = [a + between + b for (a, _), (b, _) in itertools.islice(itertools.product(each, each), 0, None, 7) for between in ("", "x", "(")]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: [(x["word"], x["key"]) for x in r["f"]] for r in rows.select("t", denominations.found(F.col("t")).alias("f")).collect()}
    for t in texts:
        met = [w for w, _ in each if re.search(rf"(?<![a-z]){w}(?![a-z])" if w.isascii() else w, t)]
        assert got[t] == [(w, k) for w, k in each if w in met and not any(w != x and w in x for x in met)], t
