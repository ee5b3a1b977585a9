import random

import pytest

WORDS = [a + b for a in ("ba", "ke", "lo", "mi", "nu", "sé", "ta") for b in ("ra", "fi", "do", "pe", "ß", "n")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def corpus():
    """Texts with exact and near copies, shared passages, nulls, blanks, odd white space and one long text."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(1, 260)) for _ in range(40)]
    passage, long = prose(rng, 90), prose(rng, 6000)
    texts += [texts[3], texts[3], texts[7] + " xyz", texts[7] + " uvw", "aa " * 130, None, "", " \n\t ", "x", "Ünï çödé 語 🙂 words", long]
    texts += [f"{prose(rng, 30)}\n{passage} {prose(rng, 20)}" for _ in range(6)]
    texts += [f"{prose(rng, 12)} {passage[40:]}", long[5000:9000], passage + "\t" + passage, "a b c d", "THE end The END", "a  b\x0b\x0cc"]
    return [(100 + 3 * (i * 17 % len(texts)), t) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def texts():
    return corpus()


@pytest.fixture(scope="session")
def documents(spark, texts):
    rows = [(i, t, "en", f"src{i % 3}" if i % 5 else None, len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def awkward(spark):
    """Null ids, repeated rows, one id with two texts, and columns whose names clash with the operators' own."""
    rows = [(None, "a b c d e f"), (None, None), (4, "same text of six words here"), (4, "same text of six words here"), (4, "another text"), (9, None), (2, "z " * 300), (1, "z " * 300)]
    out = spark.createDataFrame([(i, t, None if i == 4 else "s", 1) for i, t in rows], "doc_id long, text string, source string, n_chars long")
    from pyspark.sql import functions as F

    clash = ["n_words", "kept", "spans", "fp", "tag", "bucket", "guest", "size", "copies", "target", "source_size", "anchor", "place", "at", "n", "_at", "held_out", "score", "rare", "_size", "word", "c"]
    return out.withColumns({x: F.lit("clash") for x in clash})
