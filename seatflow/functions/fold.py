"""Compatibility forms of letters and digits as plain ones, in SQL functions.

The tables are made from Python's Unicode data: code points that fold to one other by one translation, and those
that fold to several by replacement, which only texts that hold one go through. Marks that stand apart from their letter
aren't put together with it: each code point is folded by itself.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


@functools.cache
def tables() -> tuple[dict[str, str], dict[str, str]]:
    """Code points by what they fold to under NFKC: one code point, or several. Hangul syllables are whole already."""
    one, several = {}, {}
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        folded = unicodedata.normalize("NFKC", c)
        if folded != c and not unicodedata.category(c).startswith("C"):
            (one if len(folded) == 1 else several)[c] = folded
    return one, several


@functools.cache
def _classed() -> str:
    """A character class of the code points that fold to several."""
    at = sorted(map(ord, tables()[1]))
    spans = []
    for c in at:
        if spans and c == spans[-1][1] + 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in spans) + "]"


def nfkc(text: Column) -> Column:
    """Each code point in its compatibility form."""
    one, several = tables()
    plain = F.translate(text, "".join(one), "".join(one.values()))
    # one entry is looked up at a time: its place in a string of all of them is its place in the list
    names, forms = "".join(several), F.split(F.lit("\n".join(several.values())), "\n")
    each = F.transform(F.split(plain, ""), lambda c: F.when(c.rlike(_classed()), F.get(forms, F.instr(F.lit(names), c) - 1)).otherwise(c))
    return F.when(plain.rlike(_classed()), F.array_join(each, "")).otherwise(plain)
