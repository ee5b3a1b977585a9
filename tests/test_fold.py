"""Compatibility folding against Python's own, code point by code point."""

import sys
import unicodedata

from pyspark.sql import functions as F

from seatflow.functions import fold
from seatflow.operators import checks


def test_every_code_point(spark):
    wanted = [c for c in map(chr, range(0x20, sys.maxunicode + 1)) if unicodedata.category(c) not in ("Cs", "Co", "Cn", "Cc")]
    folding = [c for c in wanted if unicodedata.normalize("NFKC", c) != c and not unicodedata.category(c).startswith("C")]
    assert len(folding) > 4500
    texts = ["a" + c + "b" for c in folding] + ["".join(wanted[i : i + 500]) for i in range(0, 20_000, 500)] + [None, ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["f"] for r in rows.select("i", fold.nfkc(F.col("t")).alias("f")).collect()}
    single = lambda t: "".join(unicodedata.normalize("NFKC", c) for c in t)
    assert all(got[i] == (None if t is None else single(t)) for i, t in enumerate(texts))


def test_numbers_in_other_styles(spark):
    cases = [("𝟎𝟏𝟎-𝟏𝟐𝟑𝟒-𝟓𝟔𝟕𝟖", "010-1234-5678"), ("010-1234-5678", "⓪①⓪-①②③④-⑤⑥⑦⑧"), ("010-1234-5678", "⓪⑩-①②③④ ⑤⑥⑦⑧"), ("0₁₀-¹²³⁴-5678", "01012345678")]
    rows = spark.createDataFrame([(v, s) for v, s in cases], "v string, s string")
    assert all(r[0] for r in rows.select(checks.phones_grounded(F.col("v"), F.col("s"))).collect())


def test_bracketed_title_names_no_opening(spark):
    cases = [("<담임목사 홍길동> 사무간사 모집", False), ("[담임목사] 사무간사 모집", False), ("【담임목사】 모집", True), ("담임목사 모집", True)]
    rows = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    assert [r[0] for r in rows.select(checks.supports(F.lit("SENIOR_PASTOR"), F.lit("담임목사"), F.col("t"))).collect()] == [w for _, w in cases]
