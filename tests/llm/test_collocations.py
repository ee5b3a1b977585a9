"""Collocations against brute force, the summaries' guarantee, and edge cases."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from seatflow.llm import collocations

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least=10, most=3, top=2000, share=50):
    """rows: (lang, text)."""
    counts = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            for k in range(1, most + 1):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n, rows_ = sum(c for p, c in f.items() if len(p) == 1), []
        candidates = [p for p, c in f.items() if len(p) > 1 and c >= least]
        longer = collections.Counter()
        for p in candidates:
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], f[p])
        for p in candidates:
            a = f[p]
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if not longer[p] or 100 * longer[p] < share * a:
                rows_.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, p, l, r) in enumerate(sorted(rows_)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def ours(frame, **options):
    return sorted(tuple(r) for r in collocations.collocations(frame, **options).collect())


def some(n=300, seed=3):
    rng = random.Random(seed)
    words = [a + b for a in ("Ka", "lo", "mé", "語", "x") for b in ("ra", "N", "tu")] + ["\xa0", "'s", "a\x1cb"]
    common = ["new york city", "of the", "in spite of", "New  York\tcity"]
    rows = []
    for i in range(n):
        parts = [rng.choice(common) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 60))]
        text = "".join(p + rng.choice([" ", " ", " ", "\t", ", ", ". ", "\n", "!?", " \x0b"]) for p in parts)
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text))
    return rows + [(None, None), ("fr", ""), ("fr", "one phrase of its own"), ("en", " \t\n")]


@pytest.mark.parametrize("options", [{}, {"least": 3, "share": 80}, {"least": 2, "top": 25}, {"least": 4, "most": 5}, {"most": 2}])
def test_collocations_against_brute_force(spark, options):
    rows = some()
    got = ours(spark.createDataFrame(rows, "lang string, text string").repartition(5), **options)
    assert got == brute(rows, **options) and len(got) > 10


def test_small_blocks_and_parts(spark, documents, texts):
    rows = [("en", t) for _, t in texts]
    frame = documents.select("lang", "text").repartition(6)
    assert ours(frame, least=3) == brute(rows, least=3)
    counts = {r["phrase"]: r["f"] for r in collocations.frequent_phrases(frame, 3).collect()}
    plain = collections.Counter(w for _, t in rows for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (t or "").translate(LOWER)) for w in re.split(r"[ \t]+", piece) if w)
    assert counts[None] == sum(plain.values()) and all(counts[w] == c for w, c in plain.items() if c >= 3)


def test_counts_beyond_64_bit_products(spark):
    """Squares of a count times a million pass 64 bits."""
    f = 4_000_000_000
    rows = [("x", "a b", 2, f), ("x", "a", 1, f + 1), ("x", "b", 1, 3 * f), ("x", None, 0, 9 * f)]
    (r,) = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, words int, f long")).collect()
    assert r["score"] == 10**6 * f * f // ((f + 1) * 3 * f) and (r["l"], r["r"]) == (f + 1, 3 * f)


def test_equal_cuts_take_the_first(spark):
    rows = [("x", "a b c", 3, 10), ("x", "a b", 2, 10), ("x", "b c", 2, 20), ("x", "a", 1, 10), ("x", "b", 1, 40), ("x", "c", 1, 20), ("x", None, 0, 99)]
    got = {r["phrase"]: (r["l"], r["r"], r["score"]) for r in collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, words int, f long")).collect()}
    assert got == {"a b c": (10, 20, 500_000)}


def test_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.integers(0, 40, 3000), rng.integers(0, 5000, 20000)]).astype(np.uint64)
    exact = dict(zip(*np.unique(keys, return_counts=True)))
    for pieces in (1, 7, 40):
        summary = collocations.Summary(len(keys) // 25 + 1)
        for part in np.array_split(rng.permutation(keys), pieces):
            summary.merge(*np.unique(part, return_counts=True))
        assert len(summary.keys) <= summary.capacity and summary.taken < 25
        assert all(c <= exact[k] <= c + summary.taken for k, c in zip(summary.keys, summary.counters))
        assert {k for k, c in exact.items() if c >= 25} <= set(summary.survivors(25)) and (pieces == 1 or summary.taken > 0)


def test_words_of_equal_hashes_are_counted_apart(monkeypatch):
    monkeypatch.setattr(collocations.xxhash, "xxh3_64_intdigest", lambda *_: 7)
    found = collocations.Phrases("en", b"a b a b a c. b a", 3)
    texts, _, counts = found.told(np.ones(sum(map(len, found.counts)), bool))
    assert dict(zip(texts, counts)) == {"a": 4, "b": 3, "c": 1, "a b": 2, "b a": 3, "a c": 1, "a b a": 2, "b a b": 1, "b a c": 1}


def test_collocation_edges(spark, nothing, awkward):
    assert ours(nothing) == []
    clash = awkward.withColumns({c: F.lit("clash") for c in ("phrase", "block", "part", "f", "rank", "texts")})
    rows = [("x", r["text"]) for r in awkward.select("text").collect()]
    assert ours(clash.withColumn("lang", F.lit("x"))) == brute(rows)
    assert ours(spark.createDataFrame([("x", "a " * 500_000)], "lang string, text string")) == brute([("x", "a " * 500_000)])
