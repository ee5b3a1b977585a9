"""The Merkle manifest against plain recursion over whole lists, its witnesses, and its edge cases."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from seatflow.llm import merkle


def h(*hexes):
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


def leaf(row):
    told = b"".join(b"-" if v is None else b"%d:%s" % (len(str(v).encode()), str(v).encode()) for v in row)
    return hashlib.sha256(told).hexdigest()


def brute_tree(leaves):
    """The root, and for each leaf its siblings level by level."""
    nodes, proofs, over = leaves, [[] for _ in leaves], [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        above, members = [], []
        for b in range(0, len(nodes), 16):
            run = nodes[b : b + 16]
            for k in range(len(run)):
                for i in over[b + k]:
                    proofs[i] += run[:k] + run[k + 1 :]
            above.append(h(*run))
            members.append([i for k in range(len(run)) for i in over[b + k]])
        nodes, over = above, members
    return nodes[0], proofs


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text) to sorted (leaf, subroot, root, proof)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([leaf(r) for r in sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for s in sources}
    root, tops = brute_tree([trees[s][0] for s in sources])
    out = []
    for s, top in zip(sources, tops):
        ordered = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        out += [(leaf(r), trees[s][0], root, "".join(p + top)) for r, p in zip(ordered, trees[s][1])]
    return sorted(out)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def ours(frame, **options):
    out = merkle.manifest(frame, **options).withColumn("folded", merkle.folded("leaf", "siblings", "shape")).collect()
    assert all(r["folded"] == r["root"] for r in out)
    return sorted((r["leaf"], r["subroot"], r["root"], bytes(r["siblings"]).hex()) for r in out)


def some(counts, seed=1):
    rng = random.Random(seed)
    rows = [(i, s, rng.choice(["en", None]), rng.choice([None, 3, 44]), rng.choice([None, "", f"Text {i}", "ünï 語"])) for s, n in counts for i in rng.sample(range(10 * n + 10), n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("counts", [[("a", 1)], [("a", 2), (None, 1)], [("b", 16), ("a", 17), ("", 1), (None, 33)], [(f"s{i}", 1 + i % 4) for i in range(40)]])
def test_manifest_against_recursion(spark, counts):
    rows = some(counts)
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


@pytest.mark.parametrize("height", [1, 2, 3])
def test_blocks_of_any_height_give_the_same_tree(spark, height):
    rows = some([("big", 700), ("mid", 256), ("next", 257), ("one", 1), (None, 20)] + [(f"s{i}", 1) for i in range(16)])
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(5), height=height) == brute(rows)


def test_manifest_of_more_than_a_block(spark):
    rows = [(i, "hot", "en", i, f"t{i}") for i in range(4097 + 16)] + [(1, "z", None, None, None)]
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(7)) == brute(rows)


def test_manifest_edges(spark, nothing, awkward):
    assert merkle.manifest(nothing).collect() == []
    rows = [(None, "s", None, 1, "a"), (None, "s", None, 1, "a"), (4, "s", "x", 1, "b"), (4, "s", "x", 1, "b"), (4, "s", "x", 1, "c"), (9, None, None, None, None), (2, "s", "y", 1, "z " * 200_000)]
    assert ours(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    clash = awkward.withColumns({c: F.lit("clash") for c in ("lang", "key", "digest", "total", "block", "siblings", "root")})
    out = merkle.manifest(clash.withColumn("mine", F.lit(7)), keep=["mine"]).collect()
    assert len(out) == 8 and {r["mine"] for r in out} == {7}


def test_frontier_extends_the_witnesses_of_what_came_before():
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(40)]
    tree = merkle.Frontier(2)
    for i, d in enumerate(digests):
        tree.append(d)
        if i == 5:
            assert tree.witness_so_far(2) == [digests[:2] + digests[3:6]]
        if i == 31:
            assert [len(x) for x in tree.witness_so_far(2)] == [15, 1]
    root = tree.closed()
    assert root == merkle.digest_of([merkle.digest_of(digests[:16]), merkle.digest_of(digests[16:32]), merkle.digest_of(digests[32:])])
    for i, d in enumerate(digests):
        assert merkle.fold(d.hex(), *tree.witness(i)) == root.hex()
        assert merkle.fold(digests[i - 1].hex(), *tree.witness(i)) != root.hex()


def test_a_changed_row_does_not_fold_to_the_root(spark):
    rows = some([("a", 40), ("b", 3)])
    out = merkle.manifest(spark.createDataFrame(rows, SCHEMA))
    other = out.withColumn("folded", merkle.folded(F.sha2("leaf", 256), "siblings", "shape"))
    assert other.where("folded = root").count() == 0
