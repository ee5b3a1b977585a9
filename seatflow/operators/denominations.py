"""Which denomination a church states, by a dictionary of words, and whether the posting itself bears it out.

All words are looked for in one pass: a pattern of all of them, the longest first, read at every place. At a
place it finds the longest word that begins there; any shorter one there lies within it and wouldn't count.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from seatflow.functions.text import squeeze

# Words of each denomination, Latin ones last; words of requirements; how a posting speaks of its own church.
WORDS = {
    "HAPSIN": ["합동신학", "예장합신", "합신"],
    "BAEKSEOK": ["합동정통", "백석대신", "예장백석", "백석"],
    "HAPDONG": ["예장합동", "합동", "gapck"],
    "TONGHAP": ["예장통합", "통합", "pck"],
    "GAMLI": ["기독교대한감리회", "예수교대한감리회", "기감", "감리", "연회"],
    "SUNBOK": ["여의도순복음", "하나님의성회", "순복음", "기하성", "agk"],
    "BAPTIST": ["기독교한국침례회", "침례", "기침"],
    "SEONGGYUL": ["기독교대한성결교회", "예수교대한성결교회", "성결", "기성", "예성"],
    "GOSIN": ["고려신학", "예장고신", "고신"],
    "ETC": ["합동보수", "한국기독교장로회", "기장", "나사렛성결", "나사렛", "루터", "그리스도의교회", "독립", "카이캄", "브니엘", "예장개혁", "대신", "호헌", "prok", "kaicam"],
}
REQUIREMENTS = ["신대원", "신학대학원", "졸업", "재학", "자격", "학력", "인준"]
OWN = "본교단"
SENTENCE = r"니다|\."


def _pattern(word: str) -> str:
    """Latin words stand between non-letters, others anywhere."""
    return rf"(?<![a-z]){word}(?![a-z])" if word.isascii() else re.escape(word)


def found(bare: Column, words: dict[str, list[str]] = WORDS) -> Column:
    """array<struct<at, word, key>>: dictionary words in a text without white space and in lower case, in the dictionary's order, but for those
    within another that was found."""
    each = [(w, key) for key, listed in words.items() for w in listed]
    everywhere = "(?=(" + "|".join(_pattern(w) for w, _ in sorted(each, key=lambda x: -len(x[0]))) + "))"
    at_of = F.create_map(*[F.lit(x) for i, (w, _) in enumerate(each) for x in (w, i)])
    keys = F.array(*[F.lit(key) for _, key in each])
    met = F.array_distinct(F.regexp_extract_all(bare, F.lit(everywhere), F.lit(1)))
    alone = F.filter(met, lambda w: ~F.exists(met, lambda x: (x != w) & F.contains(x, w)))
    return F.array_sort(F.transform(alone, lambda w: F.struct(F.element_at(at_of, w).alias("at"), w.alias("word"), F.get(keys, F.element_at(at_of, w)).alias("key"))))


def stands_in(line: Column, word: Column) -> Column:
    """Whether a bare line has the word, by the same rule as where it was looked up."""
    return F.when(word.rlike("^[a-z]+$"), F.regexp_like(line, F.concat(F.lit("(?<![a-z])"), word, F.lit("(?![a-z])")))).otherwise(F.contains(line, word))


def confirmed(stated: Column, text: Column, fields: Column, words: dict[str, list[str]] = WORDS) -> Column:
    """struct<key, source, word>: the one denomination that a stated value means, if the posting bears it out; else UNKNOWN, unknown and null.

    fields: the values of the board's own fields. The words found in the value must all mean one key, and the value must not be a sentence.
    A line of the text, or a field, bears a word out if it holds it and isn't a requirement, unless that requirement speaks
    of the writer's own church. Of several words the dictionary's first that is borne out counts. A posting without any text (an image, say) can't
    bear anything out and is taken by its word, its last one, if its fields don't decide.
    """
    bare = lambda c: F.lower(squeeze(c))
    met = F.when(~bare(stated).rlike(SENTENCE), found(bare(stated), words))
    one = F.size(F.array_distinct(F.transform(met, lambda x: x["key"]))) == 1
    none = F.array().cast("array<string>")
    lines = F.transform(F.concat(F.coalesce(fields, none), F.split(F.coalesce(text, F.lit("")), r"\R")), lambda x: F.coalesce(bare(x), F.lit("")))
    asks = lambda line: line.rlike("|".join(REQUIREMENTS)) & ~F.contains(line, F.lit(OWN))
    borne = F.filter(met, lambda x: F.exists(lines, lambda line: stands_in(line, x["word"]) & ~asks(line)))
    shown = F.coalesce(F.trim(squeeze(text)) != "", F.lit(False))
    best = F.when(one, F.when(F.size(borne) > 0, F.get(borne, F.lit(0))).when(~shown, F.element_at(met, -1)))
    return F.struct(F.coalesce(best["key"], F.lit("UNKNOWN")).alias("key"), F.when(best.isNotNull(), "stated").otherwise("unknown").alias("source"), best["word"].alias("word"))
