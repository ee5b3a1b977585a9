"""Language-model scoring with a weighted backoff automaton.

Tokens are lower-cased words and one end per text. The lowest order is add-half over the tokens seen
and one class for all unseen ones. Above it, every n-gram that occurs twice in training is kept, at
any size of corpus, up to order 3: a history with kept followers is a state, a kept n-gram is an arc out
of its history's state, and a state's failure arc leads to its suffix. With c the exact counts,

    p(w | h) = (c(hw) - D) / c(h) + weight(h) * p(w | suffix of h)    if hw is kept
             = weight(h) * p(w | suffix of h)                         else, along the failure arc

where weight(h) = 1 - (sum of c - D over the kept followers) / c(h), and 1 where h isn't a state.

Nothing of the model is held in one place. Texts are packed into blocks, stored once. From the highest
order down, each block asks for its distinct n-grams: keys are 64-bit hashes, dealt to parts by
their upper bits, sorted and packed. A part sums the blocks' counts and answers in the order asked,
so an answer is a few bits a key; of the blocks that asked for a kept n-gram it names one as its
owner. Owners add up their kept n-grams' counts by history and send these sums along when they ask for
the next lower order. With all answers a block builds the automaton of its own n-grams and walks it
over its texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatflow.llm.common import held_out, lean, mixed, span_word_hashes, stored, word_spans

ORDER, LEAST_COUNT, DISCOUNT = 3, 2, 0.5
#: Hashes in the place of words: of a text's start and end.
START, END = np.uint64(0x53D1C0FFEE5EED01), np.uint64(0x2E0D0FAB1E0DDE77)
#: Bytes of text to a block at least, and to a part of the keys.
BLOCK_BYTES, PART_BYTES = 6_000_000, 8_000_000
LEAST_PARTS = 12


# --- packing --------------------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as bytes: byte by byte of all values, compressed, so that upper bytes of zero take no room."""
    planes = np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as their differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw), dtype=np.uint64)


def text_blocks(frame: DataFrame) -> DataFrame:
    """(block, doc_id, held, lengths, texts): lists of rows, and their lower-cased texts in one compressed value."""
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, texts, size = [], [], [], 0

        def done() -> pa.RecordBatch:
            own = pa.concat_arrays(ids)
            row = [pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own), pa.array([held], pa.list_(pa.bool_())),
                   pa.array([[len(t) for t in texts]], pa.list_(pa.int32())), pa.array([zstandard.compress(b"\n".join(texts), 3)], pa.binary())]
            return pa.RecordBatch.from_arrays(row, ["doc_id", "held", "lengths", "texts"])

        for batch in batches:
            at = 0
            for i, text in enumerate(batch.column(2).to_pylist()):
                texts.append(text.encode("utf-8").lower())
                size += len(texts[-1]) + 1
                if size >= BLOCK_BYTES:
                    ids.append(batch.column(0).slice(at, i + 1 - at))
                    held += batch.column(1).slice(at, i + 1 - at).to_pylist()
                    yield done()
                    ids, held, texts, size, at = [], [], [], 0, i + 1
            if at < batch.num_rows:
                ids.append(batch.column(0).slice(at))
                held += batch.column(1).slice(at).to_pylist()
        if texts:
            yield done()

    rows = frame.select("doc_id", "held", "text").mapInArrow(run, f"doc_id array<{kind}>, held array<boolean>, lengths array<int>, texts binary")
    return stored(rows.select(F.monotonically_increasing_id().alias("block"), "*"))


# --- a block's n-grams ----------------------------------------------------------------------


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a pair of hashes."""
    return mixed(mixed(left) * np.uint64(0x9E3779B97F4A7C15) + right)


class Grams(NamedTuple):
    """The distinct n-grams of a block in the order of their keys.

    place: where each one first starts; of: which one starts at each place, -1 for none.
    """

    keys: np.ndarray
    place: np.ndarray
    of: np.ndarray


class Block(NamedTuple):
    """The tokens of all texts, each between its start and its end, and the text that each is of."""

    tokens: np.ndarray
    owner: np.ndarray

    def grams(self, order: int) -> Grams:
        """Distinct n-grams; none goes on after an end."""
        tokens, n = self.tokens, len(self.tokens) - order + 1
        keys = tokens[: max(n, 0)]
        for k in range(1, order):
            keys = joined(keys, tokens[k : k + n])
        on = np.ones(len(keys), bool)
        for k in range(order - 1):
            on &= tokens[k : k + n] != END
        at = np.flatnonzero(on)
        keys = keys[at]
        by = np.argsort(keys)
        ordered = keys[by]
        new = np.ones(len(keys), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        of = np.full(len(tokens), -1, np.int64)
        of[at[by]] = np.cumsum(new) - 1
        return Grams(ordered[new], at[by[new]], of)


def block_of(lengths: np.ndarray, texts: bytes) -> Block:
    data = np.frombuffer(zstandard.decompress(texts), np.uint8)
    starts, ends = word_spans(data)
    text_ends = np.cumsum(lengths + 1)
    of = np.searchsorted(text_ends, starts, side="right")
    n = np.bincount(of, minlength=len(lengths))
    tokens, begin = np.empty(len(starts) + 2 * len(lengths), np.uint64), np.cumsum(n + 2) - n - 2
    tokens[begin], tokens[begin + n + 1] = START, END
    tokens[np.arange(len(starts)) + 2 * of + 1] = span_word_hashes(data, starts, ends)
    return Block(tokens, np.repeat(np.arange(len(lengths)), n + 2))


def per_gram(grams: Grams, weights: np.ndarray) -> np.ndarray:
    """The sum of the places' weights for each n-gram."""
    on = np.flatnonzero(grams.of >= 0)
    return np.bincount(grams.of[on], weights[on], len(grams.keys))


# --- asking and answering -------------------------------------------------------------------

ASK = "part int, block long, keys binary, c binary, m binary, n binary"
ANSWER = "order int, block long, part int, c binary, own binary, m binary, n binary, tokens long, kinds long"
LISTS = ("doc_id", "held", "lengths", "texts")


class Answers(NamedTuple):
    """For each n-gram of a block: its count (0 if it isn't kept), whether this block owns it, and of its kept followers the counts' sum and the number."""

    c: np.ndarray
    own: np.ndarray
    m: np.ndarray
    n: np.ndarray


def answers_in(rows: list[dict], order: int) -> Answers:
    """One order's answers of all parts; parts go by the keys' upper bits, so they are in the order of the keys."""
    of = sorted((r for r in rows if r["order"] == order), key=lambda r: r["part"])
    return Answers(*[np.concatenate([unpacked(r[k]) for r in of] or [np.empty(0, np.uint64)]).astype(float) for k in ("c", "own", "m", "n")])


def gathered(blocks: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """Blocks and the answers to them, as rows of one frame to be grouped by block."""
    out = blocks
    for frame in answers:
        out = out.unionByName(frame.where("block is not null").drop("tokens", "kinds"), allowMissingColumns=True)
    return out


def opened(rows: pa.Table) -> tuple[dict, list[dict]]:
    """A group's one block and its answers."""
    kept = [c for c in rows.column_names if c not in LISTS]
    answers = rows.select(kept).to_pylist()
    (at,) = [i for i, x in enumerate(rows.column("texts")) if x.is_valid]
    row = {k: rows.column(k)[at] for k in LISTS}
    block = {"block": answers[at]["block"], "doc_id": row["doc_id"].values, "held": np.array(row["held"].values), "lengths": np.array(row["lengths"].values, np.int64), "texts": row["texts"].as_py()}
    return block, [r for i, r in enumerate(answers) if i != at]


def asked(row: dict, higher: list[dict], order: int, parts: int) -> Iterator[dict]:
    """One block's questions of an order to all parts."""
    block = block_of(row["lengths"], row["texts"])
    grams = block.grams(order)
    train = ~row["held"][block.owner] if len(block.owner) else np.zeros(0, bool)
    sums = [per_gram(grams, train)]
    if higher:
        longer, found = block.grams(order + 1), answers_in(higher, order + 1)
        mine = np.flatnonzero(found.own > 0)
        history = grams.of[longer.place[mine]]
        sums += [np.bincount(history, found.c[mine], len(grams.keys)), np.bincount(history, minlength=len(grams.keys))]
    else:
        sums += [np.zeros(len(grams.keys))] * 2
    part = ((grams.keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(part, np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cuts)):
        own = slice(cuts[p], cuts[p + 1])
        yield {"part": int(p), "block": row["block"], "keys": packed_keys(grams.keys[own]), **dict(zip("cmn", (packed(s[own]) for s in sums)))}


def answered(asks: DataFrame, order: int) -> DataFrame:
    """Each part's answers to all blocks, stored. For words also, without a block, the training tokens and how many differ."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        each = [unpacked_keys(r["keys"]) for r in rows]
        keys = np.concatenate(each)
        by = np.argsort(keys)
        ordered = keys[by]
        new = np.ones(len(keys), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        of = np.empty(len(keys), np.int64)
        of[by] = np.cumsum(new) - 1
        c, m, n = (np.bincount(of, np.concatenate([unpacked(r[k]) for r in rows])) for k in "cmn")
        if order > 1:
            c[c < LEAST_COUNT] = 0
        own = np.zeros(len(keys), bool)
        own[by[new]] = c > 0
        out, at = [], 0
        for r, k in zip(rows, each):
            mine = of[at : at + len(k)]
            told = (c[mine], own[at : at + len(k)], m[mine], n[mine])
            out.append({"order": order, "block": r["block"], "part": r["part"], **dict(zip(("c", "own", "m", "n"), map(packed, told)))})
            at += len(k)
        if order == 1:
            words = c[ordered[new] != START]
            out.append({"order": 1, "part": rows[0]["part"], "tokens": int(words.sum()), "kinds": int((words > 0).sum())})
        return pa.Table.from_pylist(out, ANSWER_ARROW)

    return stored(asks.groupBy("part").applyInArrow(run, ANSWER))


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))])


ASK_ARROW, ANSWER_ARROW = _arrow(ASK), _arrow(ANSWER)


def asks_of(blocks: DataFrame, higher: DataFrame | None, order: int, parts: int) -> DataFrame:
    """All blocks' questions of an order; higher: the answers of the order above."""
    if higher is None:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row, _ = opened(pa.Table.from_batches([batch.slice(i, 1)]))
                    yield from pa.Table.from_pylist(list(asked(row, [], order, parts)), ASK_ARROW).to_batches()

        return blocks.mapInArrow(run, ASK)

    def grouped(rows: pa.Table) -> pa.Table:
        row, answers = opened(rows)
        return pa.Table.from_pylist(list(asked(row, answers, order, parts)), ASK_ARROW)

    return gathered(blocks, [higher]).groupBy("block").applyInArrow(grouped, ASK)


# --- the automaton --------------------------------------------------------------------------


class Automaton(NamedTuple):
    """A block's share of the automaton, as arrays over its distinct words, pairs and triples.

    one, two, three: the probability on reaching the word, or the last word of the pair or triple, from
    the state of what stands before it; where that state has no such arc, along its failure arc.
    """

    words: Grams
    pairs: Grams
    triples: Grams
    one: np.ndarray
    two: np.ndarray
    three: np.ndarray
    known: np.ndarray


def failure(a: Answers) -> np.ndarray:
    """The weight of each history's failure arc; 1 where it has no kept followers and isn't a state."""
    return np.where(a.n > 0, 1 - (a.m - DISCOUNT * a.n) / np.maximum(a.c, 1), 1.0)


def arcs(kept: Answers, above: Answers, history: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Probabilities of n-grams from the counts of their histories and the probabilities of their suffixes."""
    return np.where(kept.c > 0, (kept.c - DISCOUNT) / np.maximum(above.c[history], 1), 0.0) + failure(above)[history] * below


def automaton(block: Block, found: dict[int, Answers], room: float) -> Automaton:
    words, pairs, triples = block.grams(1), block.grams(2), block.grams(3)
    one = (found[1].c + 0.5) / room
    two = arcs(found[2], found[1], words.of[pairs.place], one[words.of[pairs.place + 1]])
    three = arcs(found[3], found[2], pairs.of[triples.place], two[pairs.of[triples.place + 1]])
    return Automaton(words, pairs, triples, one, two, three, found[1].c > 0)


def walked(block: Block, a: Automaton, texts: int) -> tuple[np.ndarray, ...]:
    """Tokens, known tokens, and log10 probability by words alone and along the path, of each text.

    The walk enters a text at its start's state. The state after a token is that of the last pair, so the
    arc from place to place is the triple that ends there, and after the start the pair.
    """
    at = np.flatnonzero(block.tokens != START)
    owner, word = block.owner[at], a.words.of[at]
    path = np.log10(a.two)[a.pairs.of[at - 1]]
    inside = np.flatnonzero(block.tokens[at - 1] != START)
    path[inside] = np.log10(a.three)[a.triples.of[at[inside] - 2]]
    base = np.log10(a.one)[word]
    return np.bincount(owner, minlength=texts), np.bincount(owner, a.known[word], texts), np.bincount(owner, base, texts), np.bincount(owner, path, texts)


def scored(documents: DataFrame, remainder: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row.

    Learned from the rows whose id's crc32 as text mod 5 isn't `remainder` (null ids are learned
    from). Null and empty texts are an end alone. Repeated rows count as often as they come, and
    are scored alike. With nothing to learn from, every token has probability 1. An empty table gives
    an empty result.
    """
    frame = lean(documents).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    frame = frame.withColumn("held", held_out(F.col("doc_id"), remainder))
    kind = frame.schema["doc_id"].dataType.simpleString()
    size = frame.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(LEAST_PARTS, -(-size // PART_BYTES))
    blocks = text_blocks(frame)
    answers: list[DataFrame] = []
    for order in range(ORDER, 0, -1):
        answers.append(answered(asks_of(blocks, answers[-1] if answers else None, order, parts), order))
    sums = answers[-1].where("block is null").agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    total, room = sums[0], sums[0] + 0.5 * (sums[1] + 1)

    def scores(rows: pa.Table) -> pa.Table:
        row, told = opened(rows)
        block = block_of(row["lengths"], row["texts"])
        model = automaton(block, {k: answers_in(told, k) for k in range(1, ORDER + 1)}, room)
        n, known, base, path = walked(block, model, len(row["lengths"]))
        columns = [row["doc_id"], pa.array(row["held"], pa.bool_()), pa.array(n, pa.int64()), pa.array(known.astype(np.int64)), pa.array(base), pa.array(path)]
        return pa.Table.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    out = gathered(blocks, answers).groupBy("block").applyInArrow(scores, schema)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
