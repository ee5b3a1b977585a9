"""Near-duplicates by SimHash: bands of fingerprint bits propose pairs, their distance selects, exact similarity decides.

Two texts are linked if their sets of five-word shingles share at least 0.8 of their union. So each has 0.8 or
more of its shingles in common with another text. A sketch counts a sample of the shingles, which their hashes
choose, once for each set, and never too low. A set of whose sampled shingles so few repeat that a linked one would have
as few less than once in a million goes no further; where few are sampled, none is left out. The others get a
fingerprint. It has BITS bits, each 1 if it is set in over half of the shingles' hashes; at 0.8 about 15 % of them
differ. Texts meet where all bits of a band agree. A band has a bit or two more than it takes to number the
texts, so that unlike texts meet rarely at any size, and there are as many bands as it takes to miss a
pair at 0.8 about once in 10,000, and more similar ones far less often. What meets is kept if CHECKED further
bits are near enough. Texts of one shingle set are one class and enter once.

Each member of a bucket is first compared with the bucket's centre: the one that shares the most buckets
with others. Where that leaves members out, the centre's group is looked at around its consensus, the set of
shingles that more than half of the members have. It needs no document of its own: it is the centre with
those of its members' changes that most of them share. How far a member is from it tells most:

* two members that are near enough to it together are alike for certain; all such links hang together through
  the member that is nearest, so only those to that one are written;
* any other two that are alike must share a number of changes against the consensus that grows with their
  distances, so the rarest of one's changes hold one of the rarest of the other's.

Only pairs that meet in such a change, and that no link joins yet, are compared. What members of a large group
share isn't a change, so it makes no pairs.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatflow.llm.common import dropped, lean, mixed, run_hashes, stored, word_hashes
from seatflow.llm.components import connected_components
from seatflow.llm.sketch import repeated, repeated_bits, width_for

SHINGLE, LEAST_LIKENESS = 5, 0.8
#: Bits of a fingerprint, and those of them that are compared where two texts meet.
BITS, CHECKED = 2048, 128
#: Share of the pairs at the least likeness that no band may find.
LOST = 1e-4
#: Least bits of a band.
BAND = 16
#: Bands that are looked at together, which bounds what lies on disk at a time.
ROUND = 32
#: One in 2**SAMPLED shingles is counted, and the share of linked sets that the counts may leave out.
SAMPLED, UNSEEN = 4, 1e-6
#: Sets of so few shingles differ in more bits at the same likeness, and get MORE times as many bands.
FEW, MORE = 5, 3


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; A-Z are lower-cased, and fewer words than a shingle make one shingle."""
    words = word_hashes(np.frombuffer((text or "").encode("utf-8").lower(), np.uint8))
    if not len(words):
        return words
    return np.unique(mixed(run_hashes(words, min(shingle, len(words))) + np.uint64(min(shingle, len(words)))))


def sampled(shingles: np.ndarray) -> np.ndarray:
    """The sketch's keys for those of a set's sorted shingles that are sampled."""
    return mixed(shingles[: np.searchsorted(shingles, np.uint64(1 << (64 - SAMPLED)))])


@functools.lru_cache(1 << 12)
def least_repeated(n: int, least: float) -> int:
    """Of n sampled shingles of a set that has a share of `least` or more in common with another one, so many at least are
    common but for a chance of UNSEEN: the sampled are drawn from all without regard to whether they are common."""
    below, k = 0.0, 0
    while k < n:
        below += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(least) + (n - k) * math.log(1 - least))
        if below > UNSEEN:
            break
        k += 1
    return k


_SEEDS = mixed(np.arange(1, BITS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def simhash(shingles: np.ndarray) -> np.ndarray:
    """The bits of a set, eight to a byte: each is 1 if it is set in over half of the shingles' hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(shingles), 255):  # so many counts fit in a byte
        hashes = mixed(shingles[at : at + 255, None] ^ _SEEDS)
        ones += np.add.reduce(np.unpackbits(hashes.view(np.uint8), axis=1), axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(shingles))


def agreement(least: float) -> float:
    """The chance that a bit is the same in two sets of that likeness: by the angle between them, which is widest for sets of one size."""
    return 1 - math.acos(2 * least / (1 + least)) / math.pi


def band_sizes(classes: int, least: float) -> tuple[int, int]:
    """Bits of a band and number of bands for so many sets."""
    width = min(32, max(BAND, math.ceil(math.log2(max(1, classes))) + 1))
    return width, math.ceil(math.log(LOST) / math.log1p(-(agreement(least) ** width)))


def band_bits(width: int, bands: int) -> np.ndarray:
    """The bits of each band (bands, width): all bits in one random order after the other, cut into bands."""
    rng, each = np.random.default_rng(42), BITS // width
    return np.concatenate([rng.permutation(BITS)[: each * width].reshape(each, width) for _ in range(-(-bands // each))])[:bands]


def entries(classes: DataFrame, bits: np.ndarray, first: int) -> DataFrame:
    """(key, fp, degree, home, s0, s1) for each class and band: bits are the bands', first is the number of the first; s0 and s1 are the checked bits."""
    bands, width = bits.shape
    at = np.full((bands, 32), BITS)  # bits past the width are the one after the last, which is 0
    at[:, :width] = bits
    high = np.arange(first, first + bands, dtype=np.int64) << 32

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            raw = np.frombuffer(b"".join(part["sim"]), np.uint8).reshape(len(part), BITS // 8)
            spread = np.zeros((len(part), BITS + 1), np.uint8)
            spread[:, :BITS] = np.unpackbits(raw, axis=1)
            keys = np.packbits(np.take(spread, at.ravel(), axis=1), axis=1).view(">u4").astype(np.int64) | high
            checked = np.ascontiguousarray(raw[:, : CHECKED // 8]).view(np.int64)
            yield pd.DataFrame({"keys": list(keys), "fp": part["fp"], "degree": part["degree"], "home": part["home"], "s0": checked[:, 0], "s1": checked[:, 1]})

    found = classes.select("fp", "degree", "home", "sim").mapInPandas(run, "keys array<long>, fp long, degree long, home long, s0 long, s1 long")
    return found.select(F.explode("keys").alias("key"), "fp", "degree", "home", "s0", "s1")


def _beside_centres(rows: DataFrame, most: int) -> DataFrame:
    """Rows with their bucket's centre, which is the home of highest degree, its degree, and whether `most` checked bits at most differ
    from the one at home there."""
    centre = F.max_by(F.struct("home", "degree", "s0", "s1"), F.struct("degree", "home", "fp")).over(Window.partitionBy("key"))
    near = F.expr(f"bit_count(s0 ^ c.s0) + bit_count(s1 ^ c.s1) <= {most}").alias("near")
    met = rows.withColumn("c", centre).select("key", "fp", "degree", "home", "s0", "s1", F.col("c.home").alias("centre"), F.col("c.degree").alias("most"), near)
    return met.where("fp <> centre")


def near_pairs(classes: DataFrame, least: float) -> DataFrame:
    """(centre, fp), distinct: the members of each bucket with a centre that all of them have; stored. classes: (fp, size, sim).

    The centre is the home of one of them: what meets most others among those that it meets in the first bands, and among
    those that this one meets. Buckets of a large group are many and small, but its homes are few, and so are the pairs.
    Only what may be alike is kept by the checked bits. Those of a bucket that are far from the one at home have a centre of their
    own, and those far from that too, which are few, meet each other.
    """
    width, many = band_sizes(classes.count(), least)
    p = agreement(least)
    most = math.ceil(CHECKED * (1 - p) + 6 * math.sqrt(CHECKED * p * (1 - p)))
    bits = band_bits(width, MORE * many)
    first = bits[:ROUND]
    company = entries(classes.withColumns({"degree": F.lit(0).cast("long"), "home": F.col("fp")}), first, 0).select("key", "fp")
    company = company.withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1")
    degrees = company.groupBy("fp").agg(F.sum("n").alias("degree"))
    ranked = plain = stored(classes.join(degrees, "fp", "left").withColumns({"degree": F.coalesce("degree", F.lit(0).cast("long")), "home": F.col("fp")}))
    met = _beside_centres(entries(ranked, first, 0), most).where("near")
    homes = near_by = stored(met.groupBy("fp").agg(F.max(F.struct(F.col("most").alias("degree"), F.col("centre").alias("home"))).alias("top")))
    far = homes.select(F.col("fp").alias("_home"), F.col("top").alias("far"))  # the home of the home
    homes = homes.join(far, F.col("top.home") == F.col("_home"), "left").select("fp", F.coalesce("far", "top").alias("top"))
    ranked = ranked.drop("home").join(homes, "fp", "left")
    centred = stored(ranked.select("fp", "size", "sim", F.coalesce("top.degree", "degree").alias("degree"), F.coalesce("top.home", "fp").alias("home")))
    dropped(plain, near_by)
    rounds = [(centred, at, min(at + ROUND, many)) for at in range(0, many, ROUND)] + [(centred.where(F.col("size") <= FEW), many, len(bits))]
    found = []
    for some, at, end in rounds:
        one = stored(_beside_centres(entries(some, bits[at:end], at), most))
        two = stored(_beside_centres(one.where("not near").drop("centre", "most", "near"), most))
        rest = two.where("not near").select("key", "fp", "s0", "s1")
        other = rest.select("key", *[F.col(c).alias(f"{c}_b") for c in ("fp", "s0", "s1")])
        each = rest.join(other, "key").where(f"fp < fp_b and bit_count(s0 ^ s0_b) + bit_count(s1 ^ s1_b) <= {most}")
        pairs = one.where("near").select("centre", "fp").unionAll(two.where("near").select("centre", "fp")).unionAll(each.select("fp", "fp_b"))
        found.append(stored(pairs.distinct()))
        dropped(one, two)
    out = found[0]
    for x in found[1:]:
        out = out.unionAll(x)
    out = stored(out.distinct())
    dropped(centred, *found)
    return out


def similarity(one: np.ndarray, other: np.ndarray) -> float:
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both / (len(one) + len(other) - both)


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of at least that similarity; sets: (fp, shingles)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            alike = [similarity(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= least for x, y in zip(part["x"], part["y"])]
            yield part.loc[np.array(alike, bool), ["a", "b"]]

    left, right = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("fp").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def changes(beside: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(centre, fp, alike, size, changed array<long>) for each pair: whether they are alike, the member's shingles, and those that only one of them has."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for centre, fp, x, y in zip(part["a"], part["b"], part["x"], part["y"]):
                c, own = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                out.append((centre, fp, similarity(c, own) >= least, len(own), np.setxor1d(c, own, assume_unique=True).view(np.int64)))
            yield pd.DataFrame(out, columns=["centre", "fp", "alike", "size", "changed"])

    left, right = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("fp").alias("b"), F.col("shingles").alias("y"))
    pairs = beside.select(F.col("centre").alias("a"), F.col("fp").alias("b")).join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return pairs.mapInPandas(run, "centre long, fp long, alike boolean, size long, changed array<long>")


def around_consensus(told: DataFrame, sets: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Members of the centres that have one not alike to them: (centre, fp, diff array<long>, far), and how many members
    differ from the consensus by each change: (centre, change, n), both stored.

    Sets x and y are alike if p / q of their sizes' sum at most differs. far is q * |diff| - p * size, so two
    members whose far values add up to 0 or less are alike, and two others that are alike share (far + far) / 2q changes
    or more.
    """
    p, q = _share(least)
    open_ = told.where("not alike").select("centre").distinct()
    own = sets.join(open_, F.col("fp") == F.col("centre")).select("centre", "fp", F.expr("length(shingles) div 8").alias("size"), F.lit(None).cast("array<long>").alias("changed"))
    members = plain = stored(told.join(open_, "centre", "left_semi").select("centre", "fp", "size", "changed").unionByName(own))
    members = members.withColumn("changed", F.coalesce("changed", F.array().cast("array<long>")))
    counts = members.select("centre", F.explode("changed").alias("change")).groupBy("centre", "change").agg(F.count("*").alias("n"))
    held = counts.join(members.groupBy("centre").agg(F.count("*").alias("all")), "centre").withColumn("common", F.expr("2 * n > all"))
    held = stored(held.select("centre", "change", F.expr("if(common, all - n, n)").alias("n"), "common"))
    # most members have each of these, so there are at most twice as many as one member has changes
    common = held.where("common").groupBy("centre").agg(F.collect_list("change").alias("common"))
    apart = members.join(common, "centre", "left").withColumn("common", F.coalesce("common", F.array().cast("array<long>")))
    apart = apart.select("centre", "fp", "size", F.array_union(F.array_except("changed", "common"), F.array_except("common", "changed")).alias("diff"))
    apart = apart.withColumn("far", q * F.size("diff") - p * F.col("size"))
    apart = stored(apart.select("centre", "fp", "diff", "far"))
    dropped(plain)
    return apart, held.drop("common")


def _share(least: float) -> tuple[int, int]:
    """p and q: sets are alike at a similarity of `least` if p / q of their sizes' sum at most differs."""
    share = (1 - Fraction(least).limit_denominator(10**6)) / (1 + Fraction(least).limit_denominator(10**6))
    return share.numerator, share.denominator


def nearest_links(apart: DataFrame) -> DataFrame:
    """(a, b): alike for certain, by their distances from the consensus; of all such pairs those with the nearest member."""
    nearest = apart.groupBy("centre").agg(F.min(F.struct("far", "fp")).alias("near"))
    sure = apart.join(nearest, "centre").where("fp <> near.fp and far + near.far <= 0")
    return sure.select(F.col("near.fp").alias("a"), F.col("fp").alias("b"))


def changed_alike(apart: DataFrame, held: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """(a, b): members of a centre's group that no link joins yet and that may be alike by their changes against the consensus; stored.

    Changes go by how many members have them, the rarest first. Two members with k changes in common have one in common that
    stands in both lists with k - 1 or more to its end (room of k or more, itself included).
    """
    _, q = _share(least)
    rows = apart.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    each = rows.select("centre", "fp", "root", "far", F.size("diff").alias("size"), F.explode("diff").alias("change")).join(held, ["centre", "change"])
    order = Window.partitionBy("centre", "fp").orderBy("n", "change")
    each = each.withColumn("room", 2 * q * (F.col("size") + 1 - F.row_number().over(order)))
    each = stored(each.where("n > 1").drop("n", "size"))
    one = each.where("2 * far <= room").select("centre", "change", *[F.col(c).alias(f"{c}_a") for c in ("fp", "root", "far", "room")])
    other = each.select("centre", "change", *[F.col(c).alias(f"{c}_b") for c in ("fp", "root", "far", "room")])
    near = F.expr("root_a <> root_b and (far_a < far_b or far_a = far_b and fp_a < fp_b) and far_a + far_b between 1 and least(room_a, room_b)")
    met = one.join(other, (one["centre"] == other["centre"]) & (one["change"] == other["change"]) & near)
    found = stored(met.select(F.least("fp_a", "fp_b").alias("a"), F.greatest("fp_a", "fp_b").alias("b")).distinct())
    dropped(each)
    return found


def _names(sets: list[np.ndarray]) -> np.ndarray:
    """A hash of each set, 0 of the empty one."""
    return np.array([xxhash.xxh3_64_intdigest(x.tobytes()) if len(x) else 0 for x in sets], np.uint64).view(np.int64)


def likely_sets(texts: DataFrame, rows: DataFrame, least: float) -> DataFrame:
    """(fp, size, sim, shingles) of the distinct sets that may be linked to another one, by their sampled shingles; stored.
    rows: (fp, sampled) for each text."""
    part, rest = Fraction(least).limit_denominator(10**6), 1 - Fraction(least).limit_denominator(10**6)
    alone = math.ceil(part / rest) if rest else math.inf  # smaller sets are like themselves only
    once = stored(rows.groupBy("fp").agg(F.first("sampled").alias("sampled")).select("sampled"))
    keys = once.agg(F.coalesce(F.sum(F.expr("length(sampled) div 8")), F.lit(0))).first()[0]
    bits = repeated_bits(once, lambda part: (np.frombuffer(x, np.uint64) for x in part["sampled"]), width_for(keys))
    dropped(once)

    def made(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            kept = []
            for text in part["text"]:
                shingles = shingle_set(text)
                own = sampled(shingles)
                if len(shingles) >= alone and np.count_nonzero(repeated(bits.value, own)) >= least_repeated(len(own), least):
                    kept.append(shingles)
            yield pd.DataFrame({"fp": _names(kept), "size": np.array([len(x) for x in kept], np.int64), "sim": [simhash(x).tobytes() for x in kept], "shingles": [x.tobytes() for x in kept]})

    found = texts.mapInPandas(made, "fp long, size long, sim binary, shingles binary")
    return stored(found.groupBy("fp").agg(*[F.first(c).alias(c) for c in ("size", "sim", "shingles")]))


def near_duplicates(documents: DataFrame, least: float = LEAST_LIKENESS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component_id) for each row: component_id is the smallest id that links reach, itself included.

    Null ids are never the smallest unless all are null; texts without words are alike. An empty
    table gives an empty result.
    """
    frame = lean(documents).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            sets = [shingle_set(text) for text in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"], "fp": _names(sets), "sampled": [sampled(x).tobytes() for x in sets]})

    rows = stored(frame.mapInPandas(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, fp long, sampled binary"))
    sets = likely_sets(frame.select("text"), rows.select("fp", "sampled"), least)
    beside = near_pairs(sets.select("fp", "size", "sim"), least)
    sets = sets.select("fp", "shingles")

    told = stored(changes(beside, sets, least))
    stars = stored(told.where("alike").select(F.col("centre").alias("a"), F.col("fp").alias("b")))
    apart, held = around_consensus(told, sets, least)
    sure = stored(stars.unionByName(nearest_links(apart)))
    joined = stored(connected_components(sure))
    rest = changed_alike(apart, held, joined, least)
    done = beside.select(F.least("centre", "fp").alias("a"), F.greatest("centre", "fp").alias("b"))
    links = sure.unionByName(verified(rest.join(done, ["a", "b"], "left_anti"), sets, least))

    roots = connected_components(links).select(F.col("node").alias("fp"), "root")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first")).join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    reached = classes.join(smallest, "root").select("fp", "component_id")
    out = stored(rows.select("doc_id", "fp").join(reached, "fp").select("doc_id", "component_id"))
    dropped(rows, sets, beside, told, stars, apart, held, sure, joined, rest)
    return out
