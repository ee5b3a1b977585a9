"""Each operator against brute force on a small fixture, and its edge cases."""

import collections
import hashlib
import math
import pathlib
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from seatflow.llm import bpe, components, fingerprints, language, matroska, media, minhash, mixing, quality, simhash, substring, suffixes
from seatflow.llm.common import shared_dir, word_hashes
from seatflow.llm.queries import VOCABULARY
from seatflow.llm.trees import boosted, classified, walk

SPLIT = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return SPLIT.findall((text or "").encode())


# --- 1 ------------------------------------------------------------------------------------


@pytest.mark.parametrize("part_bytes", [12_000_000, 1500])
def test_fingerprints_pair_each_text_with_the_next(documents, texts, monkeypatch, part_bytes):
    monkeypatch.setattr(fingerprints, "PART_BYTES", part_bytes)
    got = {r["doc_id"]: r for r in fingerprints.with_next(documents).collect()}
    order = sorted(texts, key=lambda x: -x[0])
    assert len(got) == len(texts)
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == minhash.fingerprint(t) and r["edited_fingerprint"] == minhash.fingerprint(edited)
        assert r["near_next"] == minhash.likeness(minhash.fingerprint(t), minhash.fingerprint(after))
        assert r["near_edited"] == minhash.likeness(minhash.fingerprint(t), minhash.fingerprint(edited))


def test_likeness_estimates_jaccard(texts):
    def shingles(t):
        w = words(t)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    errors = []
    long = max((t for _, t in texts if t), key=len).split(" ")
    for keep in (0.2, 0.5, 0.8, 0.95):
        for begin in range(0, 4000, 400):
            a = " ".join(long[begin : begin + 400])
            b = " ".join(long[begin : begin + int(400 * keep)] + long[5000 : 5400 - int(400 * keep)])
            x, y = shingles(a), shingles(b)
            errors.append(minhash.likeness(minhash.fingerprint(a), minhash.fingerprint(b)) - len(x & y) / len(x | y))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_fingerprint_edges(spark, nothing, awkward):
    assert fingerprints.with_next(nothing).collect() == []
    assert len(fingerprints.with_next(awkward).collect()) == 8
    assert minhash.fingerprint("") == minhash.fingerprint(None) == minhash.fingerprint(" \n") == minhash.NOTHING
    assert minhash.likeness(minhash.NOTHING, minhash.NOTHING) == 1 and minhash.likeness(minhash.NOTHING, minhash.fingerprint("a")) == 0
    (one,) = fingerprints.with_next(spark.createDataFrame([(5, "a b c")], "doc_id long, text string")).collect()
    assert one["near_next"] == 1.0
    filled = np.zeros(256, bool)
    filled[[3, 200]] = True
    assert set(minhash.densified(np.arange(256, dtype=np.uint64), filled)) == {3, 200}


# --- 2 ------------------------------------------------------------------------------------


def brute_substring(rows, window=50):
    first, out = {}, {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            first[k] = min(first.get(k, i), i)
    for i, t in rows:
        w = words(t)
        gone = {q for p in range(len(w) - window + 1) if first[tuple(w[p : p + window])] < i for q in range(p, p + window)}
        out[i] = (len(w), len(gone), b" ".join(x for q, x in enumerate(w) if q not in gone).decode())
    return out


def test_substring_dedup(documents, texts):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring.without_repeats(documents).collect()}
    assert got == brute_substring(texts)
    assert sum(x[1] > 0 for x in got.values()) > 8


def opposite_words(n):
    """Two words of n letters that a polynomial hash mod a power of two can't tell apart: Thue-Morse and its complement."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [8, 64, 1024, 2048])
def test_substring_compares_long_words(spark, n):
    shared, (one, other) = " ".join(f"w{i}" for i in range(49)), opposite_words(n)
    rows = spark.createDataFrame([(1, f"{shared} {one}"), (2, f"{shared} {other}"), (3, f"x\t{shared}  {one}")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in substring.without_repeats(rows).collect()}
    assert got == {1: 0, 2: 0, 3: 50}
    assert minhash.likeness(minhash.fingerprint(one), minhash.fingerprint(other)) < 0.1


def test_substring_of_words_in_opposite_orders(spark):
    one, other = opposite_words(2048)
    rows = [(i, " ".join({"a": "ab", "b": "ba"}[c] for c in word)) for i, word in enumerate((one, other))]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_substring(rows)


def test_substring_leaves_no_windows_on_disk(spark, documents, texts):
    """Digests of windows are needed only until their pieces are judged; what stays are the places found."""
    folder = pathlib.Path(shared_dir(spark))
    before = set(folder.glob("seatflow-*"))
    found = substring.repeated_windows(documents)
    left = set(folder.glob("seatflow-*")) - before
    assert left and all(spark.read.parquet(str(x)).columns == ["doc_id", "mark", "at", "n"] for x in left)
    assert {r["doc_id"] for r in found.collect()} == {i for i, (_, n, _) in brute_substring(texts).items() if n}


def test_substring_makes_anchors_once(spark, documents, monkeypatch):
    """The sketch counts stored anchors; it reads no texts again."""
    seen, count = [], substring.repeated_bits
    monkeypatch.setattr(substring, "repeated_bits", lambda frame, *rest: seen.append(frame.columns) or count(frame, *rest))
    substring.repeated_windows(documents)
    assert seen == [["anchors"]]


def test_substring_edges(nothing, awkward):
    assert substring.without_repeats(nothing).collect() == []
    got = {(r["doc_id"], r["text"]): r["n_removed"] for r in substring.without_repeats(awkward).collect()}
    assert got[2, "z " * 300] == 300 and got[1, "z " * 300] == 0 and got[4, "another text"] == 0 and len(got) == 7


def test_sketch_loses_nothing(spark):
    import pandas as pd

    from seatflow.llm.sketch import repeated, repeated_bits

    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64)
    rows = [(int(k >> np.uint64(1)),) for k in np.concatenate([keys, keys[:700]])]
    frame = spark.createDataFrame(rows, "k long").repartition(5)

    def of(part: pd.DataFrame):
        yield part["k"].to_numpy().astype(np.uint64)

    bits = repeated_bits(frame, of, 1 << 20).value
    found = repeated(bits, keys >> np.uint64(1))
    assert found[:700].all() and found[700:].mean() < 0.02


# --- 3: tests/llm/test_pages.py -----------------------------------------------------------
# --- 4 ------------------------------------------------------------------------------------


def brute_suffix(rows, width=200):
    count, out = {}, []
    for _, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - width + 1):
            count[raw[p : p + width]] = count.get(raw[p : p + width], 0) + 1
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - width + 1):
            if count[raw[p : p + width]] > 1:
                gone[p : p + width] = True
        edge = np.diff(np.concatenate(([0], gone.astype(int), [0])))
        out.append((i, len(raw), int((edge == 1).sum()), bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return sorted(out)


def test_suffix_array_dedup(documents, texts, monkeypatch):
    got = sorted((r["doc_id"], r["n_bytes"], len(r["spans"]), bytes(r["kept"])) for r in suffixes.without_repeats(documents).collect())
    assert got == brute_suffix(texts)
    assert sum(x[2] > 0 for x in got) > 10


@pytest.mark.parametrize("block_bytes", [300, 1500])
def test_suffix_dedup_of_anchors_larger_than_a_block(spark, documents, texts, block_bytes):
    """Blocks so small that some anchors, or all with two contexts, are grouped string by string."""
    import random

    from tests.llm.conftest import prose

    rng = random.Random(3)
    passage = prose(rng, 60)
    rows = texts + [(10_000 + i, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_bytes"], len(r["spans"]), bytes(r["kept"])) for r in suffixes.without_repeats(frame, block_bytes=block_bytes).collect())
    assert got == brute_suffix(rows)


def test_suffix_edges(nothing, awkward):
    assert suffixes.without_repeats(nothing).collect() == []
    rows = suffixes.without_repeats(awkward).collect()
    assert len(rows) == 8 and all(bytes(r["kept"]) == b"" for r in rows if r["text"] == "z " * 300)


def test_difference_cover_and_block():
    for a in range(suffixes.PERIOD):
        assert any((a + c) % suffixes.PERIOD in suffixes.COVER and c % suffixes.PERIOD in suffixes.COVER for c in range(suffixes.PERIOD))
    rng = np.random.default_rng(3)
    for letters, n in ((2, 900), (1, 500), (30, 3000)):
        block = rng.integers(97, 97 + letters, n).astype(np.uint8)
        block[n // 2 + 7 : n // 2 + 230] = block[5:228]
        starts = np.arange(n - 199)
        raw = block.tobytes()
        seen = {}
        for s in starts:
            seen.setdefault(raw[s : s + 200], []).append(s)
        want = np.array([len(seen[raw[s : s + 200]]) > 1 for s in starts])
        assert (suffixes.repeated_in_block(block, starts) == want).all() and want.any()


# --- 5 ------------------------------------------------------------------------------------


@pytest.fixture(scope="session")
def coder():
    return bpe.BytePairs(bpe.read_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN)


@pytest.fixture(scope="session")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(VOCABULARY)), special_tokens={})


def test_bpe_matches_tiktoken_and_round_trips(spark, documents, texts, tik):
    shared = bpe.shared_coder(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    rows = {r["doc_id"]: r for r in bpe.decode(bpe.encode(documents, shared), shared).collect()}
    for i, t in texts:
        assert list(rows[i]["ids"]) == tik.encode_ordinary(t or "")
        assert bytes(rows[i]["decoded"]) == (t or "").encode()


def test_bpe_appends_and_edits(coder, tik):
    import random

    rng = random.Random(2)
    text = bpe.EditedText(coder, "Hello wörld,  the quick   brown fox")
    for _ in range(150):
        a = rng.randint(0, len(text.text))
        b = min(len(text.text), a + rng.choice([0, 0, 1, 3, 8]))
        text.replace(a, b, rng.choice(["", "x", " ", "  ", "\n\n", "ing", "é", "123", "語🙂", "aaaaaaaaaaaaaaaaaaaaaaaaa", "'s "]))
        assert text.ids() == tik.encode_ordinary(text.text)
    text.append(" appended's end")
    assert text.ids() == tik.encode_ordinary(text.text)
    long = bpe.EditedText(coder, "a" * 20 + "bcdefgh" * 400)
    before = long.recomputed
    long.replace(1400, 1401, "zz")
    assert long.ids() == tik.encode_ordinary(long.text) and long.recomputed - before < 600


def test_bpe_edges(spark, nothing, awkward, coder, tik):
    shared = bpe.shared_coder(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    assert bpe.decode(bpe.encode(nothing, shared), shared).collect() == []
    assert len(bpe.encode(awkward, shared).collect()) == 8
    for t in ("a" * 3000, "!" * 700, " " * 500 + "x", "\t\n" * 90, "’'ll 'LL ½ ٣٤", "antidisestablishmentarianism" * 20):
        assert coder.encode(t) == tik.encode_ordinary(t)


# --- 6 ------------------------------------------------------------------------------------


def brute_simhash(t):
    w = words(t.lower() if t is not None and t.isascii() else t) if t is None or t.isascii() else SPLIT.findall(t.encode().lower())
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_components(documents, texts):
    got = {r["doc_id"]: (r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(documents).collect()}
    fps = {i: brute_simhash(t) for i, t in texts}
    root = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            low = min(root[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 3)
            changed |= low < root[i]
            root[i] = min(root[i], low)
    assert got == {i: (fps[i], root[i]) for i in fps}


def test_links_find_every_pair(spark):
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = {int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for c in centres for _ in range(12)}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    got = {frozenset((r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1)) for r in simhash.links(spark.createDataFrame(signed, "fp long")).collect()}
    assert got == {frozenset((a, b)) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3}


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = dict(tuple(r) for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_simhash_edges(nothing, awkward):
    assert simhash.near_duplicates(nothing).collect() == []
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == 8 and {r["component_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}


# --- 7 ------------------------------------------------------------------------------------


def test_boosted_trees_and_flat_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    model = boosted(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    tree = classified(x, y)

    def down(row, at=0):
        while tree.left[at] >= 0:
            at = tree.left[at] + (row[tree.feature[at]] > tree.threshold[at])
        return tree.value[at]

    assert np.allclose(walk(tree, x[:200]), [down(r) for r in x[:200]])
    assert boosted(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3


def test_quality(spark, documents, texts, nothing, awkward):
    shout = {i: int(bool(t) and len(t) % 2) for i, t in texts}
    rows = [(i, (t or "").upper() if shout[i] else t) for i, t in texts]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - s, 0) for i, s in shout.items()] + [(None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.scored(frame, labels).collect()}
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 for r in got.values())
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3)
    words = [i for i, t in texts if len(t or "") > 200]
    assert np.mean([got[i]["predicted"] == 1 - shout[i] for i in words]) > 0.9
    assert quality.scored(nothing, labels).collect() == []
    assert {r["score"] for r in quality.scored(awkward, labels.limit(0)).collect()} == {0.5}


def test_quality_of_held_out_rows_of_the_table():
    """Trees that learn from the other labelled rows rank held-out documents of the given table."""
    import os

    import duckdb

    folder = "/root/testdata/sf0.01"
    if not os.path.exists(folder):
        pytest.skip("no tables")
    rows = duckdb.sql(f"SELECT doc_id, text, quality FROM '{folder}/documents.parquet' JOIN '{folder}/labels.parquet' USING (doc_id) WHERE quality IS NOT NULL ORDER BY doc_id").fetchall()
    x, y = np.array([quality.statistics(t) for _, t, _ in rows], dtype=float), np.array([q for *_, q in rows], dtype=float)
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in rows])
    score = boosted(x[~held], y[~held]).score(x[held])
    good, bad = score[y[held] == 1], score[y[held] == 0]
    assert len(bad) >= 5 and (good[:, None] > bad[None]).mean() > 0.97
    assert ((score >= quality.ACCEPT) == y[held]).mean() > 0.95


# --- 8 ------------------------------------------------------------------------------------


def brute_targets(sizes, most=3.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        level = left / sum(weight[s] for s in free) if free else 0
        target = {s: most * sizes[s] if s in full else level * weight[s] for s in names}
        over = {s for s in free if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        full |= over


def test_mixing(spark):
    rng = np.random.default_rng(6)
    rows = [(i, ["b", "a", "ç", "zz", None][min(4, int(rng.exponential(1)))], int(rng.exponential(200))) for i in range(4000)] + [(9000 + i, "tiny", 1) for i in range(3)] + [(9100, "void", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.mixed_copies(frame).collect()
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = brute_targets(sizes)
    taken = {s: 0 for s in sizes}
    for r in got:
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-9) and r["source_size"] == sizes[r["source"]] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 300
    again = mixing.mixed_copies(frame.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixing_edges(nothing, awkward, spark):
    assert mixing.mixed_copies(nothing.withColumn("size", mixing.sizes("text"))).collect() == []
    rows = mixing.mixed_copies(awkward.withColumn("w", mixing.sizes("text")), size_col="w").collect()
    assert len(rows) == 8 and rows[0]["word"] == "clash"
    assert [r["n"] for r in spark.createDataFrame([("a b  c\x0bd",), (None,), ("",)], "text string").select(mixing.sizes("text").alias("n")).collect()] == [3, 0, 0]


# --- 9 ------------------------------------------------------------------------------------


def test_media_round_trip(documents, texts):
    files = media.stored_media(documents)
    rows = {r["doc_id"]: r for r in media.packet_tables(files, keep=("doc_id", "n_bytes")).collect()}
    for i, t in texts:
        raw = (t or "").encode()
        want = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        r = rows[i]
        assert bytes(r["payload"]) == want and r["n_bytes"] == len(raw) and r["error"] is None
        assert [p["timestamp"] for p in r["packets"]] == list(range(0, len(want), 64))
        assert r["tracks"][0]["codec"] == "A_PCM/INT/LIT" and r["tracks"][0]["depth"] == 8


def test_matroska_lacing_unknown_sizes_and_groups():
    e, n = matroska.element, matroska.number
    frames = [b"a" * 300, b"b" * 255, b"c" * 7]
    xiph = bytes([2, 255, 45, 255, 0]) + b"".join(frames)
    ebml = bytes([2]) + matroska.size_bytes(300, 2) + (255 - 300 + (1 << 13) - 1 | 1 << 14).to_bytes(2, "big") + b"".join(frames)
    fixed = bytes([2]) + b"x" * 30
    heads = [b"\x81" + struct.pack(">hB", t, flags) for t, flags in ((0, 0x82), (-3, 0x86), (5, 0x04))]
    body = n(matroska.TIME, 1000) + e(matroska.SIMPLE, heads[0] + xiph) + e(matroska.SIMPLE, heads[1] + ebml) + e(matroska.GROUP, e(matroska.BLOCK, heads[2] + fixed))
    cluster = bytes.fromhex("1F43B675") + b"\xff" + body
    track = e(matroska.TRACK, n(matroska.NUMBER, 1) + e(matroska.CODEC, b"X"))
    inner = e(matroska.TRACKS, track) + cluster + e(matroska.CUES, e(matroska.POINT, n(matroska.CUE_TIME, 1000) + e(matroska.CUE_AT, n(matroska.CUE_TRACK, 1) + n(matroska.CUE_CLUSTER, 9))))
    data = e(matroska.EBML, e(matroska.DOC_TYPE, b"webm")) + bytes.fromhex("18538067") + b"\x01" + b"\xff" * 7 + inner
    m = matroska.parsed(data)
    assert [data[p.start : p.end] for p in m.packets] == frames + frames + [b"x" * 10] * 3
    assert [p.timestamp for p in m.packets] == [1000] * 3 + [997] * 3 + [1005] * 3 and len(m.cues) == 1
    for bad in (b"", b"\0\0", data[:20], b"junk" * 20, e(matroska.EBML, e(matroska.DOC_TYPE, b"other")) + data):
        with pytest.raises((ValueError, IndexError)):
            matroska.parsed(bad)


def test_matroska_of_broken_files():
    """Cut anywhere and with any byte changed, a file is read or refused with ValueError, and nothing else."""
    good = matroska.written(bytes(range(256)) * 12)
    rng, refused = np.random.default_rng(9), 0
    broken = [good[:n] for n in range(0, len(good), 7)] + [good + b"\x1f"]
    for _ in range(1500):
        changed = bytearray(good)
        for at in rng.integers(0, 200 if rng.random() < 0.7 else len(good), rng.integers(1, 4)):
            changed[at] = rng.integers(0, 256)
        broken.append(bytes(changed))
    for data in broken:
        try:
            m = matroska.parsed(data)
            matroska.samples(data, m)
        except ValueError:
            refused += 1
    assert refused > 300
    short = matroska.element(matroska.SIMPLE, b"\x81\0")
    with pytest.raises(ValueError):
        matroska.parsed(matroska.element(matroska.SEGMENT, matroska.element(matroska.CLUSTER, short)))


def test_media_edges(nothing, awkward, spark):
    assert media.packet_tables(media.stored_media(nothing)).collect() == []
    assert len(media.packet_tables(media.stored_media(awkward)).collect()) == 8
    rows = media.packet_tables(spark.createDataFrame([(1, b"junk"), (2, None), (3, matroska.written(bytes(64))[:-30])], "doc_id long, media binary")).collect()
    assert len(rows) == 3 and all(r["error"] and r["payload"] is None and r["packets"] == [] for r in rows)


# --- 10 -----------------------------------------------------------------------------------


def brute_language(rows):
    """Tokens, known tokens, base and score of each text by plain recursion over dictionaries of counts."""
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    tokens = [(i, [b" start", *words((t or "").encode().lower().decode()), b" end"]) for i, t in rows]
    count = collections.Counter(tuple(ts[p : p + n]) for i, ts in tokens if not held[i] for n in (1, 2, 3) for p in range(len(ts) - n + 1))
    kept = {g: c for g, c in count.items() if len(g) == 1 or c >= 2}
    after = collections.defaultdict(list)
    for g, c in kept.items():
        after[g[:-1]].append(c)
    total = sum(c for g, c in count.items() if len(g) == 1 and g != (b" start",))
    room = total + 0.5 * (sum(len(g) == 1 and g != (b" start",) for g in count) + 1)

    def p(g):
        if len(g) == 1:
            return (count[g] + 0.5) / room
        h = g[:-1]
        if h not in after:
            return p(g[1:])
        weight = 1 - sum(c - 0.5 for c in after[h]) / count[h]
        return (kept[g] - 0.5 if g in kept else 0) / count[h] + weight * p(g[1:])

    out = {}
    for i, ts in tokens:
        base = sum(math.log10(p((t,))) for t in ts[1:])
        score = sum(math.log10(p(tuple(ts[max(0, k - 2) : k + 1]))) for k in range(1, len(ts)))
        out[i] = (held[i], len(ts) - 1, sum((t,) in count for t in ts[1:]), total, base, score)
    return out, p, count


def same_scores(got, want):
    assert len(got) == len(want)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert math.isclose(r["base_score"], w[4], rel_tol=1e-9) and math.isclose(r["score"], w[5], rel_tol=1e-9)


def test_language_scores(documents, texts):
    want, _, _ = brute_language(texts)
    got = language.scored(documents).collect()
    same_scores(got, want)
    assert sum(r["score"] - r["base_score"] for r in got) > 0


def test_language_over_many_blocks_and_parts(spark, documents, texts, monkeypatch):
    """Small blocks and parts: n-grams meet across blocks, and each has one owner."""
    monkeypatch.setattr(language, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(language, "PART_BYTES", 2000)
    same_scores(language.scored(documents).collect(), brute_language(texts)[0])


def test_language_is_a_distribution(texts):
    _, p, count = brute_language(texts)
    seen = [g for g in count if len(g) == 1 and g != (b" start",)]
    histories = [(), *[g for g in count if len(g) == 1 and g != (b" end",)][:8], *[g for g in count if len(g) == 2 and g[1] != b" end"][:60]]
    for h in histories:
        assert math.isclose(sum(p((*h, *w)) for w in seen) + p((*h, b"not seen")), 1.0, rel_tol=1e-9)


def test_language_packing():
    rng = np.random.default_rng(2)
    for keys in (np.sort(rng.integers(0, 1 << 64, 500, dtype=np.uint64)), np.empty(0, np.uint64), np.array([0, (1 << 64) - 1], np.uint64)):
        assert (language.unpacked_keys(language.packed_keys(keys)) == keys).all() and (language.unpacked(language.packed(keys)) == keys).all()


def test_language_edges(nothing, awkward):
    assert language.scored(nothing).collect() == []
    rows = language.scored(awkward).collect()
    assert len(rows) == 8
    twice = [r for r in rows if r["doc_id"] == 4 and r["n_tokens"] == 7]
    assert len(twice) == 2 and twice[0]["n_known"] == twice[1]["n_known"] == 7


def test_language_tells_texts_that_occur_twice_apart(spark):
    """What is gained over words alone is more for copies of which two were learned, held out or not, than for texts that occur once."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in np.minimum(rng.zipf(1.3, 60), 3000))) for i in range(300)]
    rows += [(1000 + i, rows[i // 2][1]) for i in range(80)]
    want, _, _ = brute_language(rows)
    got = language.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    same_scores(got, want)
    gain = {r["doc_id"]: (r["score"] - r["base_score"]) / r["n_tokens"] for r in got}
    learned = collections.Counter(t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1)
    twice, once = [i for i, t in rows if learned[t] >= 2], [i for i in range(40, 300)]
    assert len(twice) > 60 and min(gain[i] for i in twice) > max(gain[i] for i in once)


# --- chosen words and texts -----------------------------------------------------------------


def test_words_chosen_to_collide_are_told_apart(spark):
    """Pairs that a hash of eight bytes at a time, or of the bytes without the length, can't tell apart."""
    one, other = "zxdmytanabcdefgh", "qncbnrmmph/w0s`^"
    rows = [(i, one) for i in range(1, 10)] + [(100, other)]
    got = {r["doc_id"]: r for r in language.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    learned = [t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = collections.Counter(w for t in learned for w in (t, None))
    room = sum(counts.values()) + 0.5 * (len(counts) + 1)
    for i, text in rows:
        assert got[i]["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.5) / room) for w in (text, None)))
    assert round(got[1]["base_score"], 4) == -0.7390 and round(got[100]["base_score"], 4) == -1.3033
    assert minhash.likeness(minhash.fingerprint(one), minhash.fingerprint(other)) < 0.1
    hashes = word_hashes(np.frombuffer(" ".join(f"{'a' * n}\0" for n in range(300)).encode() + " ".join(f"{'a' * n}" for n in range(1, 300)).encode(), np.uint8))
    assert len(set(hashes.tolist())) == len(hashes)


@pytest.mark.parametrize("operator", ["op2", "op4"])
def test_rows_of_one_id_are_told_apart_by_whole_texts(spark, operator):
    """Texts with the same low 24 bits of a 64-bit hash: what one loses the other must not."""
    seen, pair = {}, None
    for k in range(100_000):
        text = " ".join(f"{k}x{j}" for j in range(70))
        low = xxhash.xxh64_intdigest(text.encode(), 42) & 0xFFFFFF
        if low in seen:
            pair = seen[low], text
            break
        seen[low] = text
    a, b = pair
    rows = spark.createDataFrame([(7, a), (7, b), (3, a)], "doc_id long, text string")
    run = substring.without_repeats if operator == "op2" else suffixes.without_repeats
    left = {(r["doc_id"], r["text"]): r["kept"] for r in run(rows).collect()}
    assert len(left[7, a]) == 0 and left[7, b] in (b, b.encode())
