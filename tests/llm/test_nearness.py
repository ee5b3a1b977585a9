"""Near-duplicates by shingle similarity against all pairs: large groups of copies with edits of their own."""

import random

import numpy as np
import pytest

from seatflow.llm import nearness
from seatflow.llm.common import mixed, stored


def copies(seed, n, words=130, most=0.12):
    """Copies of a text with more or fewer edits, and copies of copies."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = [base]
    for k in range(n):
        text = list(out[rng.randrange(len(out))] if rng.random() < 0.3 else base)
        for _ in range(rng.randint(0, int(most * words / 2))):
            at = rng.randrange(len(text))
            kind = rng.random()
            if kind < 0.7:
                text[at] = f"e{rng.randrange(10**6)}"
            elif kind < 0.85:
                del text[at]
            else:
                text.insert(at, f"i{k}")
        out.append(text)
    return [" ".join(t) for t in out]


def exact(rows, least=0.8):
    """The smallest id that links reach, by all pairs of the sets of words."""
    sets = [(i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}) for i, t in rows for w in [t.split(" ")]]
    root = {i: i for i, _ in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    links = 0
    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            both = len(x & y)
            if both >= least * (len(x) + len(y) - both) - 1e-9:
                links += 1
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: top(i) for i in root}, links


@pytest.mark.parametrize(("seed", "n", "most"), [(1, 260, 0.12), (2, 200, 0.3), (3, 120, 0.05)])
def test_large_groups_lose_no_link(spark, seed, n, most):
    rows = list(enumerate(copies(seed, n, most=most) + copies(seed + 10, 40, words=60)))
    random.Random(seed).shuffle(rows)
    got = {r["doc_id"]: r["component_id"] for r in nearness.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    want, _ = exact(rows)
    assert got == want and 2 < len(set(want.values())) < len(rows)


def test_members_that_share_what_the_centre_lacks_are_not_compared(spark):
    """Copies that have edits of their own and all lack what their centre has: few pairs are compared."""
    rng = random.Random(7)
    base = [f"w{k}" for k in range(130)]
    texts = [" ".join(x if rng.random() > 0.06 else f"e{n}-{k}" for k, x in enumerate(base)) for n in range(400)]
    sets = spark.createDataFrame([(n, bytearray(nearness.shingle_set(t).tobytes())) for n, t in enumerate(texts)], "fp long, shingles binary")
    beside = spark.createDataFrame([(0, n) for n in range(1, 400)], "centre long, fp long")
    told = stored(nearness.changes(beside, sets, 0.8))
    apart, held = nearness.around_consensus(told, sets, 0.8)
    near = nearness.nearest_links(apart).collect()
    roots = spark.createDataFrame([], "node long, root long")
    pairs = {(r["a"], r["b"]) for r in nearness.changed_alike(apart, held, roots, 0.8).collect()}
    each = [set(nearness.shingle_set(t).tolist()) for t in texts]
    alike = {(i, j) for j in range(400) for i in range(j) if len(each[i] & each[j]) >= 0.8 * len(each[i] | each[j]) - 1e-9}
    far = {r["fp"]: r["far"] for r in apart.collect()}
    assert all((min(a["a"], a["b"]), max(a["a"], a["b"])) in alike for a in near)
    assert {p for p in alike if far[p[0]] + far[p[1]] > 0} <= pairs and len(pairs) < 4000


def test_fingerprints_are_majorities_of_the_shingles_bits():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 254, 255, 256, 700):
        shingles = rng.integers(0, 2**63, n).astype(np.uint64)
        hashes = [[int(x) for x in mixed(shingles ^ seed)] for seed in nearness._SEEDS]
        want = [2 * sum(h >> bit & 1 for h in column) > n for column in hashes for byte in range(8) for bit in range(8 * byte + 7, 8 * byte - 1, -1)]
        assert np.unpackbits(nearness.simhash(shingles)).tolist() == [int(x) for x in want]


@pytest.mark.parametrize(("own", "both"), [(0, 4), (1, 16), (6, 48), (33, 264)])
def test_simhash_bands_propose_pairs_at_the_least_likeness(spark, own, both):
    """Pairs that are barely alike meet in a band; of unlike sets hardly any do."""
    rng = np.random.default_rng(both)
    rows = []
    for n in range(150):
        shared, one, other = (rng.integers(0, 2**63, k).astype(np.uint64) for k in (both, own or 1, own))
        for k, x in enumerate((np.append(shared, one), np.append(shared, other))):
            rows.append((2 * n + k, len(x), bytearray(nearness.simhash(x).tobytes())))
    found = {tuple(sorted(r)) for r in nearness.near_pairs(spark.createDataFrame(rows, "fp long, size long, sim binary"), 0.8).collect()}
    want = {(2 * n, 2 * n + 1) for n in range(150)}
    assert want <= found and len(found - want) < 60  # of 44,700


def test_texts_that_share_little_go_no_further(spark):
    """Of long unlike texts none gets bands; both of a pair at the least likeness do."""
    rng = random.Random(11)
    texts = [" ".join(f"v{rng.randrange(10**6)}" for _ in range(600)) for _ in range(60)]
    half = [x.split() for x in texts[:20]]
    texts += [" ".join(w + [f"z{k}-{n}" for n in range(140)]) for k, w in enumerate(half)]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [nearness.shingle_set(t) for t in texts]
    names = nearness._names(sets).tolist()
    given = spark.createDataFrame([(n, bytearray(nearness.sampled(s).tobytes())) for n, s in zip(names, sets)], "fp long, sampled binary")
    found = {r["fp"] for r in nearness.likely_sets(frame.select("text"), given, 0.8).collect()}
    assert found == {names[k] for k in (*range(20), *range(60, 80))}
    got = {r["doc_id"]: r["component_id"] for r in nearness.near_duplicates(frame).collect()}
    assert got == exact(rows)[0] and len(set(got.values())) == 60


def test_near_duplicates_leave_no_tables_but_the_result(spark, documents):
    from pathlib import Path

    from seatflow.llm.common import shared_dir

    folder = Path(shared_dir(spark).removeprefix("file://").removeprefix("file:"))
    size = lambda: sum(p.stat().st_size for d in folder.glob("seatflow-*") for p in d.rglob("*.parquet"))
    before = size()
    out = nearness.near_duplicates(documents)
    held = sum(Path(f.removeprefix("file://").removeprefix("file:")).stat().st_size for f in out.inputFiles())
    assert 0 < held and size() - before == held
