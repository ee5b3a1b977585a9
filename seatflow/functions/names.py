"""Who a posting names as its senior pastor, in built-in functions.

A text is cut into lines, and a line at each place where the label stands. What follows the label is
read part by part: a title, a mark, and the value up to the next bracket, comma or stroke. The value is
a name if nothing else is in it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label and the words and marks around a name.
LABEL = "담임"
TITLES = ["목사님", "목사", "목회자"]
POLITE = "목사님"
RANKS = ["담임", "위임", "원로", "군종"]
MARKS = [":", "：", "-", "–", "—"]
OPENERS = ["(", "（", ")", "）", ","]
VALUE_ENDS = [")", "）", "(", "（", ",", "/"]
NOT_NAMES = ["없음", "공석", "아래", "청빙"]
SEVERAL = [",", "/", "·"]
ELSEWHERE = ["참조"]
BLANK_FIELD = "-"
SHORTEST_BARE = 3

HANGUL_NAME = "^[가-힣]{2,4}$"
SPACED_NAME = "^[가-힣]( [가-힣]){2}$"
RANKED_TITLE = f"({'|'.join(RANKS)})?\\s*목사님?"


def _bare(c: Column) -> Column:
    """Without blanks and tabs at the ends; a line feed never gets here."""
    return F.trim(F.translate(c, "\t", " "))


def _first_of(c: Column, words: list[str]) -> Column:
    """The first of the words that the text starts with, or nothing."""
    return F.coalesce(*[F.when(F.startswith(c, F.lit(w)), F.lit(w)) for w in words], F.lit(""))


def _after(c: Column, head: Column) -> Column:
    return _bare(F.substring(c, F.length(head) + 1, F.length(c)))


def as_name(value: Column) -> Column:
    """The value without blanks if it is two to four syllables, or three with a blank between; null else."""
    closed = F.replace(value, F.lit(" "), F.lit(""))
    shaped = value.rlike(HANGUL_NAME) | value.rlike(SPACED_NAME)
    return F.when(shaped & ~closed.isin(NOT_NAMES), closed)


def _with(rows: Column, *kept: str, **new) -> Column:  # noqa: ANN003
    """Rows with some fields kept and others made of each row; every step's values are found once."""
    return F.transform(rows, lambda x: F.struct(*[x[k].alias(k) for k in kept], *[make(x).alias(k) for k, make in new.items()]))


def _introduced(line: Column) -> Column:
    """The names that the labels of a line introduce, null where one introduces none."""
    parts = F.split(line, LABEL)
    places = F.filter(F.sequence(F.lit(1), F.size(parts)), lambda k: k < F.size(parts))
    rows = F.transform(places, lambda k: F.struct(
        _bare(F.array_join(F.slice(parts, F.lit(1), k), LABEL)).alias("lead"), _bare(F.array_join(F.slice(parts, k + 1, F.size(parts)), LABEL)).alias("rest")))
    rows = _with(rows, "lead", "rest", title=lambda x: _first_of(x["rest"], TITLES))
    rows = _with(rows, "lead", "title", rest=lambda x: _after(x["rest"], x["title"]))
    rows = _with(rows, "lead", "title", rest=lambda x: _after(x["rest"], _first_of(x["rest"], ["명"])))
    rows = _with(rows, "lead", "title", "rest", mark=lambda x: _first_of(x["rest"], MARKS))
    rows = _with(rows, "lead", "title", "mark", rest=lambda x: _after(x["rest"], x["mark"]))
    rows = _with(rows, "lead", "title", "mark", rest=lambda x: F.when(x["mark"] != "", _bare(F.regexp_replace(x["rest"], f"^{RANKED_TITLE}", ""))).otherwise(x["rest"]))

    def value(x: Column) -> Column:
        out = x["rest"]
        for end in VALUE_ENDS:
            out = F.substring_index(out, end, 1)
        return _bare(F.regexp_replace(out, f"{RANKED_TITLE}.*$", ""))

    rows = _with(rows, "lead", "title", "mark", value=value)
    rows = _with(rows, "lead", "title", "mark", name=lambda x: as_name(x["value"]))

    def counts(x: Column) -> Column:
        alone = (x["lead"] == "") | F.right(x["lead"], F.lit(1)).isin(OPENERS)
        return (x["mark"] != "") | ((F.length(x["name"]) >= SHORTEST_BARE) & (x["title"] != POLITE) & alone)

    return F.transform(rows, lambda x: F.when(counts(x), x["name"]))


def named_in(text: Column) -> Column:
    """The first name that a label in the text introduces.

    With a mark after the label any name counts; without one it must begin its line or field, be longer
    than two syllables, and not follow the polite form.
    """
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.contains(line, F.lit(LABEL)))
    names = F.flatten(F.transform(lines, _introduced))
    return F.get(F.filter(names, lambda n: n.isNotNull()), F.lit(0))


def senior_pastor_of(text: Column, field: Column) -> Column:
    """The name in the form's field, or else in the text; a field that says several names or none decides too."""
    stated = F.trim(field)
    elsewhere = (stated == "") | (stated == BLANK_FIELD)
    for word in ELSEWHERE:
        elsewhere = elsewhere | F.contains(stated, F.lit(word))
    bare = F.regexp_replace(stated, r"[（(\[【][^)）\]】]*[)）\]】]", "")
    several = F.lit(False)
    for mark in SEVERAL:
        several = several | F.contains(bare, F.lit(mark))
    closed = F.regexp_replace(F.regexp_replace(bare, r"(?U)\s", ""), f"{RANKED_TITLE}$", "")
    return F.when(F.coalesce(elsewhere, F.lit(True)), named_in(text)).when(~several, as_name(closed))
