"""The pipeline stage by stage, against plain Python on its own input, and its edge cases."""

import collections
import importlib
import random
import sys

import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as P
from seatflow.llm import bpe
from seatflow.llm.queries import VOCABULARY
from tests.llm.test_operators import brute_simhash, brute_substring, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, documents, texts, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    documents.write.parquet(str(path / "documents.parquet"))
    labels = [(i, int(not (t or "").startswith("aa aa")), 0) for i, t in texts]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def rows(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=str)


def test_stages_are_named_in_order():
    assert [f.__name__ for _, f in P.STAGES] == ["keep_quality", "drop_near_duplicates", "cut_repeated_passages", "mix_sources", "encode_tokens"]


def test_quality_stage_keeps_what_scores(spark, documents, folder):
    from seatflow.llm import quality

    kept = rows(P.keep_quality(spark, documents, folder))
    scores = {r["doc_id"]: r["predicted"] for r in quality.scored(documents, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    assert kept == [r for r in rows(documents) if scores[r[0]]]


def test_near_duplicates_leave_one_of_each_group(spark, documents, texts, folder):
    fps = {i: brute_simhash(t) for i, t in texts}
    root = dict((i, i) for i in fps)
    for _ in fps:
        for i in fps:
            root[i] = min(root[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 3)
    assert {r[0] for r in rows(P.drop_near_duplicates(spark, documents, folder))} == {i for i in fps if root[i] == i}


def test_passages_are_cut(spark, documents, texts, folder):
    want = brute_substring(texts)
    for i, text, _, _, n in rows(P.cut_repeated_passages(spark, documents, folder)):
        before = dict(texts)[i]
        assert (text, n) == ((want[i][2], len(want[i][2])) if want[i][1] else (before, len(before or "")))


def test_mixing_repeats_documents(spark, documents, texts, folder):
    got = collections.Counter(r[0] for r in rows(P.mix_sources(spark, documents, folder)))
    assert set(got) <= {i for i, _ in texts} and max(got.values()) <= 3
    size = sum(len(words(t)) for _, t in texts)
    assert abs(sum(n * len(words(dict(texts)[i])) for i, n in got.items()) - size) < 0.5 * size


def test_tokens(spark, documents, texts, folder):
    import public_tokenizers

    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(VOCABULARY)), special_tokens={})
    for r in P.encode_tokens(spark, documents, folder).collect():
        assert list(r["ids"]) == tik.encode_ordinary(dict(texts)[r["doc_id"]] or "") and r["n_tokens"] == len(r["ids"])


def test_run(spark, folder):
    out = P.run(spark, folder)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and out.count() > 20


@pytest.mark.parametrize("name", [f.__name__ for _, f in P.STAGES])
def test_stage_edges(spark, nothing, awkward, folder, name):
    stage = getattr(P, name)
    assert stage(spark, nothing, folder).collect() == []
    odd = awkward.withColumn("lang", F.lit(None).cast("string"))
    out = stage(spark, odd, folder)
    assert out.count() > 0
    if name != "encode_tokens":
        assert out.columns == odd.columns and {r["kept"] for r in out.select("kept").collect()} == {"clash"}


def test_near_duplicate_stage_and_missing_ids(spark, awkward, folder):
    out = P.drop_near_duplicates(spark, awkward.withColumn("lang", F.lit("x")), folder)
    got = collections.Counter(r["doc_id"] for r in out.select("doc_id").collect())
    assert got[None] == 2 and got[1] == 1 and 2 not in got and got[4] == 1


def test_the_entry_works_without_the_operators(monkeypatch):
    import __spark_entry__

    monkeypatch.setitem(sys.modules, "seatflow.llm", None)
    monkeypatch.delitem(sys.modules, "seatflow.llm.queries", raising=False)
    try:
        bare = importlib.reload(__spark_entry__)
        assert not any(n.startswith("op1_") for n in bare.queries()) and "dedup_master" in bare.queries()
    finally:
        monkeypatch.undo()
        assert "pipeline" in importlib.reload(__spark_entry__).queries()


def test_near_duplicate_stage_links_at_four_fifths(spark, folder):
    rng, texts = random.Random(11), {}
    for g in range(60):
        base = [f"{rng.choice('bcdfg')}{rng.randint(0, 4000)}" for _ in range(rng.choice([5, 9, 40, 120, 400]))]
        for k in range(4):
            copy = list(base)
            for _ in range(k * len(base) // 90 + (k > 2)):
                copy[rng.randrange(len(copy))] = f"new{rng.randint(0, 9999)}"
            texts[10 * g + k] = " ".join(copy)
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for i, w in ((i, t.split()) for i, t in texts.items())}
    root = {i: i for i in sets}
    pairs = [(i, j) for i in sets for j in sets if i // 10 == j // 10 and i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    for _ in range(4):
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    assert 60 < len(set(root.values())) < len(texts)
    assert {r[0] for r in rows(P.drop_near_duplicates(spark, docs, folder))} == set(root.values())
