"""Phrase collocation mining: Misra-Gries summaries find what may be frequent, a second pass counts exactly that.

Texts are packed into blocks of one language, stored once. A block counts its distinct phrases of one
word up to the longest and sends each part of the key space a summary of those that fall there: keys of 48 bits and
counts. A part merges the blocks' summaries under a capacity that exceeds its mass divided by the
threshold: where more keys are held, the count of the first key beyond the capacity is taken off all
of them. Each unit so taken removes more than `capacity` units of mass, so less than the threshold is taken
in all and every phrase as frequent as that survives. Phrases that share a key are counted together, which
lets more survive and loses none.

The part tells each block which of its keys survived, a bit each. In the second pass blocks count these
phrases as words, and the sums are exact; a word is looked at byte by byte, never by its hash alone.
A part holds a bounded mass and a block a bounded size, so both grow in number with the input; a part
and a block that share no phrase exchange nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatflow.llm.common import lean, mixed, stored
from seatflow.llm.language import joined, packed, packed_keys, unpacked, unpacked_keys
from seatflow.llm.sketch import text_bytes

LEAST_COUNT, MOST_WORDS, TOP, SHARE = 10, 3, 2000, 50
#: Bytes of text to a block and to a part of the keys.
BLOCK_BYTES, PART_BYTES = 2_000_000, 2_000_000
LEAST_PARTS = 12
#: Capacity of a summary, times mass / threshold.
SPARE = 2
KEY_BITS = 48

#: Blanks as spaces, and what ends a piece as a line feed.
_CUTS = bytes(32 if c in b"\t " else 10 if c in b".,;:!?\n\v\f\r" else c for c in range(256))


# --- blocks -------------------------------------------------------------------------------


def text_blocks(frame: DataFrame) -> DataFrame:
    """(block, lang, texts) from (lang, text): lower-cased texts of one language, a line feed between them, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def done(lang: str) -> pa.RecordBatch:
            size.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([zstandard.compress(b"\n".join(held.pop(lang)), 3)], pa.binary())], ["lang", "texts"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, []).append(text.encode("utf-8").lower())
                size[lang] = size.get(lang, 0) + len(held[lang][-1]) + 1
                if size[lang] >= BLOCK_BYTES:
                    yield done(lang)
                elif len(size) > 4 and sum(size.values()) >= 4 * BLOCK_BYTES:
                    yield done(max(size, key=size.__getitem__))
        for lang in list(size):
            yield done(lang)

    rows = frame.mapInArrow(run, "lang string, texts binary")
    return stored(rows.select(F.monotonically_increasing_id().alias("block"), "*"))


class Phrases:
    """The distinct phrases of a block, by length: exact, from numbered words.

    words: the distinct words. tails[k]: for each phrase of k + 1 words its first k words, as the number of a
    phrase of k words, and its last word. counts[k], keys[k]: occurrences, and keys in the whole corpus.
    """

    def __init__(self, lang: str, texts: bytes, most: int) -> None:
        data = texts.translate(_CUTS)
        split = data.split()
        coded = pa.array(split, pa.binary()).dictionary_encode() if split else None
        self.words: list[bytes] = coded.dictionary.to_pylist() if coded is not None else []
        ids = coded.indices.to_numpy().astype(np.int64) if coded is not None else np.empty(0, np.int64)
        raw = np.frombuffer(data, np.uint8)
        word = (raw != 32) & (raw != 10)
        starts = np.flatnonzero(word & ~np.concatenate(([False], word[:-1])))
        piece = np.cumsum(raw == 10)[starts]
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        hashes = mixed(np.array([xxhash.xxh3_64_intdigest(w, seed) for w in self.words], np.uint64))
        self.total, self.most = len(ids), most
        of = ids
        self.counts = [np.bincount(ids, minlength=len(self.words))]
        self.hashes = [hashes]
        self.tails: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(1, most):
            n = max(0, len(ids) - k)
            on = np.flatnonzero(piece[:n] == piece[k : k + n])
            longer, which, c = np.unique(of[on] * max(1, len(self.words)) + ids[on + k], return_inverse=True, return_counts=True)
            head, tail = np.divmod(longer, max(1, len(self.words)))
            self.hashes.append(joined(self.hashes[-1][head], hashes[tail]))
            self.counts.append(c)
            self.tails.append((head, tail))
            of = np.zeros(len(ids), np.int64)
            of[on] = which

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of all phrases, by length, and the order that sorts them."""
        all_ = np.concatenate([mixed(h + np.uint64(k)) for k, h in enumerate(self.hashes)]) >> np.uint64(64 - KEY_BITS)
        return all_, np.argsort(all_, kind="stable")

    def told(self, kept: np.ndarray) -> tuple[list[str], list[int], list[int]]:
        """Texts, lengths and counts of the kept phrases; kept: for all phrases, by length."""
        at, texts, sizes, counts = 0, [], [], []
        for k in range(self.most):
            mine = np.flatnonzero(kept[at : at + len(self.counts[k])])
            at += len(self.counts[k])
            parts, of = [], mine
            for level in range(k, 0, -1):
                parts.append(self.tails[level - 1][1][of])
                of = self.tails[level - 1][0][of]
            columns = [[self.words[i] for i in ids.tolist()] for ids in (of, *reversed(parts))]
            texts += [b" ".join(x).decode("utf-8") for x in zip(*columns)]
            sizes += [k + 1] * len(mine)
            counts += self.counts[k][mine].tolist()
        return texts, sizes, counts


def phrases_of(lang: str, texts: bytes, most: int) -> Phrases:
    return Phrases(lang, zstandard.decompress(texts), most)


# --- summaries ----------------------------------------------------------------------------


class Summary:
    """A mergeable Misra-Gries summary: at most `capacity` keys. A key's count is between its counter and that plus `taken`."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.taken = capacity, 0
        self.keys, self.counters = np.empty(0, np.uint64), np.empty(0, np.int64)

    def merge(self, keys: np.ndarray, counters: np.ndarray, taken: int = 0) -> None:
        keys, counters = np.concatenate([self.keys, keys]), np.concatenate([self.counters, counters])
        self.keys, of = np.unique(keys, return_inverse=True)
        self.counters = np.bincount(of, counters, len(self.keys)).astype(np.int64)
        self.taken += taken
        if len(self.keys) > self.capacity:
            cut = int(np.partition(self.counters, len(self.keys) - self.capacity - 1)[len(self.keys) - self.capacity - 1])  # the first beyond the capacity
            on = self.counters > cut
            self.keys, self.counters, self.taken = self.keys[on], self.counters[on] - cut, self.taken + cut

    def survivors(self, least: int) -> np.ndarray:
        """Sorted keys that may come `least` times."""
        return self.keys[self.counters + self.taken >= least]


ASK = "part long, block long, keys binary, counts binary"
TELL = "block long, part long, kept binary"


def asked(blocks: DataFrame, parts: int, most: int) -> DataFrame:
    """Each block's summary for each part of the keys that it has phrases in: exact, as a block is small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, texts in zip(*(c.to_pylist() for c in batch.columns)):
                found = phrases_of(lang, texts, most)
                keys, by = found.keys()
                keys, counts = keys[by], np.concatenate(found.counts)[by]
                part = (keys >> np.uint64(KEY_BITS - 32)) * np.uint64(parts) >> np.uint64(32)
                cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else np.zeros(1, int)
                spans = list(zip(cuts[:-1], cuts[1:]))
                if spans:
                    columns = [pa.array([int(part[a]) for a, _ in spans]), pa.array([block] * len(spans)), pa.array([packed_keys(keys[a:b]) for a, b in spans]), pa.array([packed(counts[a:b]) for a, b in spans])]
                    yield pa.RecordBatch.from_arrays(columns, ["part", "block", "keys", "counts"])

    return blocks.mapInArrow(run, ASK)


def told(asks: DataFrame, least: int) -> DataFrame:
    """For each question, a bit for each key: whether it survived in its part."""

    def run(rows: pa.Table) -> pa.Table:
        keys = [unpacked_keys(x) for x in rows.column("keys").to_pylist()]
        counts = [unpacked(x).astype(np.int64) for x in rows.column("counts").to_pylist()]
        summary = Summary(SPARE * sum(int(c.sum()) for c in counts) // least + 1)
        held, n = [], 0
        for i in range(len(keys)):
            held.append(i)
            n += len(keys[i])
            if n >= summary.capacity or i == len(keys) - 1:
                summary.merge(np.concatenate([keys[j] for j in held]), np.concatenate([counts[j] for j in held]))
                held, n = [], 0
        kept = summary.survivors(least)
        bits = [np.packbits(kept[np.minimum(np.searchsorted(kept, k), len(kept) - 1)] == k if len(kept) else np.zeros(len(k), bool)).tobytes() for k in keys]
        return pa.Table.from_arrays([rows.column("block"), rows.column("part"), pa.array(bits, pa.binary())], ["block", "part", "kept"])

    return asks.groupBy("part").applyInArrow(run, TELL)


def counted(blocks: DataFrame, answers: DataFrame, parts: int, most: int) -> DataFrame:
    """(lang, phrase, words, f) of each block's phrases that survived, and a row without a phrase for all its words."""

    def run(rows: pa.Table) -> pa.Table:
        texts = rows.column("texts").to_pylist()
        (at,) = [i for i, t in enumerate(texts) if t is not None]
        lang = rows.column("lang")[at].as_py()
        found = phrases_of(lang, texts[at], most)
        keys, by = found.keys()
        bits = {p: b for p, b in zip(rows.column("part").to_pylist(), rows.column("kept").to_pylist()) if b is not None}
        part, n = np.unique((keys >> np.uint64(KEY_BITS - 32)) * np.uint64(parts) >> np.uint64(32), return_counts=True)
        sorted_ = [np.unpackbits(np.frombuffer(bits[p], np.uint8), count=c) for p, c in zip(part.tolist(), n.tolist())]
        kept = np.zeros(len(keys), bool)
        kept[by] = np.concatenate(sorted_ or [np.empty(0)]).astype(bool)
        phrase, words, f = found.told(kept)
        columns = [pa.array([lang] * (len(f) + 1)), pa.array([None, *phrase], pa.string()), pa.array([0, *words], pa.int32()), pa.array([found.total, *f], pa.int64())]
        return pa.Table.from_arrays(columns, ["lang", "phrase", "words", "f"])

    rows = blocks.unionByName(answers, allowMissingColumns=True)
    return rows.groupBy("block").applyInArrow(run, "lang string, phrase string, words int, f long")


def frequent_phrases(documents: DataFrame, least: int = LEAST_COUNT, most: int = MOST_WORDS, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, phrase, words, f): exact counts of all phrases of one to `most` words that come `least` times or more in a language, and for each
    language a row without a phrase (words 0) with the count of all words.

    A-Z are lower-cased, texts cut into pieces at any of ``.,;:!?`` and 0x0A-0x0D and pieces into words at spaces
    and tabs; phrases lie in one piece. A null language is `und`, a null text empty. Repeated rows count as often as they come.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    frame = lean(documents).select(lang.alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = max(LEAST_PARTS, -(-text_bytes(frame) // PART_BYTES))
    blocks = text_blocks(frame)
    answers = stored(told(asked(blocks, parts, most), least))
    sums = counted(blocks, answers, parts, most).groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return stored(sums.where((F.col("f") >= least) | (F.col("words") == 0)))


# --- scores -------------------------------------------------------------------------------


def _slice(first: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice("parts", first, size), " ")


def scored(frequent: DataFrame, share: int = SHARE) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words or more that no longer one stands for.

    Of the cuts into a first part and a rest the one of the lowest score counts, the first of equal
    ones. A phrase goes if one that holds it comes in `share` percent of its places or more.
    """
    phrases = frequent.where("words > 0").select("lang", "phrase", "f")
    candidates = frequent.where("words > 1").withColumn("parts", F.split("phrase", " "))
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "cut", _slice(1, F.col("cut")).alias("first"), _slice(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("rest"))
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("(1000000BD * cast(a as decimal(15, 0)) * cast(a as decimal(15, 0))) div (cast(l as decimal(15, 0)) * cast(r as decimal(15, 0)))")
    least = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "cut", "a", "l", "r")).alias("least"))

    inner = candidates.where("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    longer = inner.groupBy("lang", _slice(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("f").alias("longer"))
    out = least.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < share * F.col("least.a"), F.lit(True)))
    return out.select("lang", "phrase", "least.a", "least.l", "least.r", "least.score")


def collocations(documents: DataFrame, least: int = LEAST_COUNT, most: int = MOST_WORDS, top: int = TOP, share: int = SHARE, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of two to `most` words that come `least` times or more.

    By score descending, a descending, phrase ascending; rank starts at 1. Counts are exact, and so is floor(1000000 * a * a / (l * r)) for
    counts below 10 ** 15. For texts and nulls see frequent_phrases; languages without such phrases have no rows, and an empty
    table gives an empty result. Other columns are ignored.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    frequent = frequent_phrases(documents, least, most, lang_col, text_col)
    totals = frequent.where("words = 0").select("lang", F.col("f").alias("n"))
    out = scored(frequent, share)
    # the first of each of 64 shares of a language, so that the last sort holds 64 * top rows of one at most
    share_of = Window.partitionBy("lang", "share").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = out.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(share_of)).where(F.col("rank") <= top)
    out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).join(totals, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
