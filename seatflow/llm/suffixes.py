"""Suffix-array dedup of byte strings by difference-cover blockwise construction.

A byte is repeated if it is covered by a 200-byte string that also starts anywhere else. Each string
belongs to one anchor: the least hash among the 32-byte grams in it. Strings that are equal have
equal anchors, so anchors are the suffix buckets. A count-min sketch drops the anchors that occur
once; of the others, the run of strings around each occurrence (its context) goes to the anchor's
bucket, equal contexts once with their number.

A task reads its buckets in order and builds the order of one block of whole buckets at a time. The
ranks of all positions by their first 32 bytes come from doubling; positions in the difference cover
{0,1,3,8,12,18} mod 31 also get a rank by their first 170 bytes. Any two positions reach the cover
at a common shift k below 31. So two strings with equal first and last 32 bytes, whose long tie only
the cover can break, are equal if and only if the cover ranks at such a k are equal; the ties are
sorted by (tie, cover rank at k), one k after the other.

An anchor with more bytes of contexts than a block, such as one at the edge of a passage that a third
of all documents share, isn't given to one task: its contexts are cut into their strings, of which those
that a second sketch estimates to repeat are grouped by BLAKE2 digests (128 bits), wherever they are. So
memory is that of one block, or of one context where that is longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatflow.llm.common import CODES, mixed, row_mark, run_hashes, sliding_min, stored
from seatflow.llm.sketch import repeated, repeated_bits, text_bytes, width_for

WIDTH, GRAM = 200, 32
#: A difference cover mod 31.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
#: Bytes of context in a block.
BLOCK_BYTES = 1 << 20


def _rank(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of integer keys."""
    order = np.argsort(keys)
    step = np.empty(len(keys), np.int64)
    step[:1] = 0
    step[1:] = keys[order[1:]] != keys[order[:-1]]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(step)
    return out


def _shared(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def repeated_in_block(block: np.ndarray, starts: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Which of the strings block[s:s+width], for s in starts, occur at another start. width is 62 at least."""
    n = len(block)
    data = np.concatenate([block, np.zeros(width, np.uint8)]).astype(np.uint64)
    word, have = data, 1
    while have < 8:  # the next 8 bytes as a number
        word = (word[:-have] << np.uint64(8 * have)) | word[have:]
        have *= 2
    ranks, have = _rank(word), 8
    while have < 32:
        ranks = _rank(ranks[:-have] * len(ranks) + ranks[have:])
        have *= 2
    tie = _rank(ranks[starts] * len(ranks) + ranks[starts + width - 32])
    live = np.flatnonzero(_shared(tie))
    out = np.zeros(len(starts), bool)
    if not len(live):
        return out
    # ranks of the cover's positions by their first width - 30 bytes
    length = width - PERIOD + 1
    at = np.arange(n)
    at = at[np.isin(at % PERIOD, COVER) & (at + length <= n)]
    long = ranks[at]
    for step in [*range(32, length - 31, 32), length - 32]:
        long = _rank(long * len(ranks) + ranks[at + step])
    cover = np.full(n + PERIOD, -1, np.int64)
    cover[at] = long
    for k in range(PERIOD):
        here = starts[live] + k
        on = np.flatnonzero(cover[here] >= 0)
        pick = live[on]
        out[pick[_shared(tie[pick] * (n + 1) + cover[here[on]])]] = True
    return out


def _anchors(text: str, width: int) -> np.ndarray:
    """The anchor grams, once per place in the text: those that are the least in some string around them."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    if len(data) < width:
        return np.empty(0, np.uint64)
    span = width - GRAM + 1
    grams = mixed(run_hashes(CODES[data], GRAM))
    least = np.zeros(len(grams) + span - 1, np.uint64)
    least[span - 1 : len(grams)] = sliding_min(grams, span)
    return grams[grams == ~sliding_min(~least, span)]


def _contexts(text: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The text's bytes; anchor, first start and last start of each run of strings with one anchor."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    if len(data) < width:
        return data, np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    least = sliding_min(mixed(run_hashes(CODES[data], GRAM)), width - GRAM + 1)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    last = np.concatenate((first[1:], [len(least)])) - 1
    return data, least[first], first, last


def _intervals(marks: np.ndarray, width: int) -> list[list[int]]:
    """Starts to maximal covered runs, as pairs of begin and end."""
    if not len(marks):
        return []
    cut = np.flatnonzero(np.diff(marks) > width)
    return np.stack([marks[np.concatenate(([0], cut + 1))], marks[np.concatenate((cut, [len(marks) - 1]))] + width], axis=1).tolist()


def _digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def _string_hashes(context: bytes, width: int) -> np.ndarray:
    return mixed(run_hashes(CODES[np.frombuffer(context, np.uint8)], width))


def repeated_strings(contexts: DataFrame, width: int) -> DataFrame:
    """(anchor, m, spans) of contexts(anchor, m, context, count): strings that occur twice, grouped wherever they are."""

    def hashes(part: pd.DataFrame) -> Iterator[np.ndarray]:
        for context, count in zip(part["context"], part["count"]):
            found = _string_hashes(context, width)
            yield found if count == 1 else np.tile(found, 2)

    total = contexts.agg(F.coalesce(F.sum(F.length("context")), F.lit(0))).first()[0]
    if not total:
        return contexts.sparkSession.createDataFrame([], "anchor long, m binary, spans array<array<long>>")
    bits = repeated_bits(contexts.select("context", "count"), hashes, width_for(total))

    def strings(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for anchor, m, context, count in zip(part["anchor"], part["m"], part["context"], part["count"]):
                at = np.flatnonzero(repeated(bits.value, _string_hashes(context, width)))
                digests = [_digest(context[i : i + width]) for i in at.tolist()]
                yield pd.DataFrame({"string": digests, "anchor": anchor, "m": m, "at": at, "count": count})

    each = contexts.mapInPandas(strings, "string binary, anchor long, m binary, at long, count long")
    twice = stored(each.groupBy("string").agg(F.sum("count").alias("n")).where("n > 1").select("string"))
    marked = each.join(twice, "string").groupBy("anchor", "m").agg(F.collect_list("at").alias("at"))  # per context, so no longer than it
    return marked.select("anchor", "m", F.transform("at", lambda x: F.array(x, x + width)).alias("spans"))


def repeated_spans(documents: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, mark, at, spans array<array<long>>): per run of strings with one anchor, the bytes covered, from byte `at` of the document on.

    mark (128 bits of the text's hash) tells rows of one id apart; rows that are equal in both are listed together.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    frame = documents.where(F.octet_length(text_col) >= width).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def anchors(part: pd.DataFrame) -> Iterator[np.ndarray]:
        for text in part["text"]:
            yield _anchors(text, width)

    bits = repeated_bits(frame.select("text"), anchors, width_for(text_bytes(frame) / 80))

    names = ["anchor", "m", "context", "doc_id", "mark", "at"]

    def contexts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out: list[tuple] = []
            for doc_id, text, mark in zip(part["doc_id"], part["text"], part["mark"]):
                data, anchor, first, last = _contexts(text, width)
                raw = data.tobytes()
                for i in np.flatnonzero(repeated(bits.value, anchor)):
                    context = raw[first[i] : last[i] + width]
                    out.append((int(anchor[i].view(np.int64)), _digest(context), context, doc_id, mark, int(first[i])))
                if len(out) >= 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    found = frame.withColumn("mark", row_mark(F.col("text"))).mapInPandas(contexts, f"anchor long, m binary, context binary, doc_id {kind}, mark binary, at long")
    found = stored(found)
    buckets = stored(found.groupBy("anchor", "m").agg(F.first("context").alias("context"), F.count("*").alias("count")))
    hot = stored(buckets.groupBy("anchor").agg(F.sum(F.length("context")).alias("n")).where(F.col("n") > block_bytes).select("anchor"))
    plain = repeated_strings(buckets.join(hot, "anchor"), width)
    buckets = buckets.join(hot, "anchor", "left_anti").select("anchor", "m", "context", "count").repartition("anchor").sortWithinPartitions("anchor")

    def blocks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, bytes, bytes, int]] = []
        size = 0

        def done() -> pd.DataFrame:
            block = np.frombuffer(b"".join(c for _, _, c, _ in held), np.uint8)
            lengths = np.array([len(c) for _, _, c, _ in held])
            offsets = np.cumsum(lengths) - lengths
            n = lengths - width + 1
            owner = np.repeat(np.arange(len(held)), n)
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            marked = repeated_in_block(block, offsets[owner] + inside, width)
            marked |= np.array([c for *_, c in held])[owner] > 1
            at = np.flatnonzero(marked)
            own, inside = owner[at], inside[at]
            cuts = np.searchsorted(own, np.arange(len(held) + 1))
            out = [(held[i][0], held[i][1], _intervals(inside[cuts[i] : cuts[i + 1]], width)) for i in np.flatnonzero(np.diff(cuts))]
            return pd.DataFrame(out, columns=["anchor", "m", "spans"])

        for part in parts:
            for anchor, m, context, count in zip(part["anchor"], part["m"], part["context"], part["count"]):
                if size >= block_bytes and anchor != held[-1][0]:
                    yield done()
                    held, size = [], 0
                held.append((anchor, m, bytes(context), count))
                size += len(context)
        if held:
            yield done()

    spans = buckets.mapInPandas(blocks, "anchor long, m binary, spans array<array<long>>")
    spans = stored(spans.unionByName(plain))
    return found.select("anchor", "m", "doc_id", "mark", "at").join(spans, ["anchor", "m"]).select("doc_id", "mark", "at", "spans")


def without_repeats(documents: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds ``n_bytes``, ``spans`` (maximal removed runs, pairs of begin and end) and ``kept binary`` to all columns.

    Each byte of the UTF-8 text covered by a string of `width` bytes that also starts anywhere else
    goes, in every copy. Null texts count as empty; nothing shorter than `width` is touched. Strings
    are judged on the input. Rows that repeat, or share an id, are texts of their own and repeat each
    other. An empty table gives an empty result. block_bytes: the bytes of contexts to a block.
    """
    added = ("n_bytes", "spans", "kept")
    names = [x for x in documents.columns if x not in added]
    spans = repeated_spans(documents, width, id_col, text_col, block_bytes)
    spans = spans.select("doc_id", "mark", F.expr("transform(spans, s -> transform(s, x -> x + at))").alias("spans"))
    spans = spans.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.flatten(F.collect_list("spans")).alias("_spans"))
    rows = documents.withColumn("_row", F.struct(*names)).select("_row", F.col(id_col).alias("_own"), row_mark(F.col(text_col)).alias("_tag"))
    rows = rows.join(spans, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_tag") == F.col("_mark")), "left").select("_row", "_spans")

    @F.pandas_udf("n_bytes long, spans array<array<long>>, kept binary")
    def cut(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for text, spans in zip(texts, found):
            raw = (text or "").encode("utf-8")
            gone, kept, at = [], [], 0
            for a, b in sorted(map(tuple, spans)) if spans is not None else ():
                if gone and a <= gone[-1][1]:
                    gone[-1][1] = max(gone[-1][1], b)
                else:
                    gone.append([int(a), int(b)])
            for a, b in gone:
                kept.append(raw[at:a])
                at = b
            out.append((len(raw), gone, b"".join([*kept, raw[at:]])))
        return pd.DataFrame(out, columns=["n_bytes", "spans", "kept"])

    out = rows.select("_row", cut(F.col(f"_row.`{text_col}`"), F.col("_spans")).alias("_cut"))
    return out.select(*[F.col(f"_row.`{x}`") for x in names], "_cut.n_bytes", "_cut.spans", "_cut.kept")
