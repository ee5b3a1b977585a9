"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every byte prefix of a piece there is exactly one token that ends the prefix's encoding; it is
stored per prefix. It is the one token t that ends at the prefix, for which the token stored at the
start of t may stand before t (their bytes together encode to just the two). So appended bytes only
add entries, and after an edit the entries are recomputed until they agree with the old ones again.

Texts are cut by the tokenizer's pattern first; pieces never merge. A piece that is itself a token
is that token. A text whose white space is single spaces and line feeds is first cut into words at
these, since the pattern always cuts before them (CUTS_AT_SPACES); a word's tokens are remembered. Null
and empty texts encode to no tokens, repeated rows alike, and an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.llm.common import lean

#: What a worker remembers at most, in two generations: words after a space, words at a line's start, prefixes, pairs.
WORDS, FIRST_WORDS, PREFIXES, PAIRS = 300_000, 50_000, 500_000, 300_000
#: Bytes of a piece whose prefixes are remembered for others too; a longer one has a table of its own.
SHORT = 64
#: The pattern of the public tokenizers. It takes a space along with what follows, or by itself; and a line feed by itself.
CUTS_AT_SPACES = {r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"}
OTHER_SPACE = re.compile(r"[^\S \n]")
_CODERS: dict[tuple, BytePairs] = {}


class Remembered(dict):
    """Results by key; what wasn't asked for in the last half of the memory is forgotten."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):  # noqa: ANN001, ANN204
        if 2 * len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found


class BytePairs:
    """Ranks of a byte-level BPE vocabulary: encodes pieces and texts, decodes ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.cuts_at_spaces = pattern in CUTS_AT_SPACES
        self.longest = max(map(len, ranks), default=0)
        self._fits = Remembered(self._fit, PAIRS)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._tails = {token[k:] for token in ranks for k in range(len(token))}  # all that tokens end with
        self._prefixes = Remembered(self._prefix, PREFIXES)
        self.length_of = {i: len(token) for token, i in ranks.items()}
        self._first, self._next = Remembered(self._ids, FIRST_WORDS), Remembered(lambda word: self._ids(" " + word), WORDS)

    def merged(self, data: bytes, parts_left: int = 1) -> list[bytes]:
        """Merges by lowest rank, leftmost first, down to so many parts; used on one token's bytes only."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > parts_left:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, and for one that no merges lead to."""
        found = self._halves.get(token, 0)
        if found == 0:
            parts = self.merged(self.bytes_of[token], 2)
            found = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
            self._halves[token] = found
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens together encode to just these two."""
        return self._fits[left << 32 | right]

    def _fit(self, pair: int) -> bool:
        """Looks back in time at the tokens on either side of the boundary: while both stood there, a
        merge of the two would have come first if its rank is below that of the merge which ended
        this. Of equal ranks the leftmost merge comes first.
        """
        a, b, until = pair >> 32, pair & 0xFFFFFFFF, 1 << 60
        while True:
            if self.ranks.get(self.bytes_of[a] + self.bytes_of[b], 1 << 60) < until:
                return False
            ha, hb = self.halves(a), self.halves(b)
            if ha is None and hb is None:
                return True
            if hb is None or (ha is not None and a > b):
                until, a = a, ha[1]
            else:  # the merge on the right comes after one at the boundary of the same rank
                until, b = b + 1, hb[0]

    def whole(self, token: int) -> bool:
        """Whether the merges of a token's bytes lead to the token."""
        return len(self.bytes_of[token]) == 1 or self.halves(token) is not None

    def ending(self, data: bytes, end: int) -> list[int]:
        """The tokens that end at a place, the longest last."""
        tails, ranks, out, start = self._tails, self.ranks, [], end
        while start:
            start -= 1
            tail = data[start:end]
            if tail in ranks:
                out.append(ranks[tail])
            elif tail not in tails:
                break
        return out

    def last_token(self, data: bytes, end: int, last: list[int]) -> int:
        """The token that ends the encoding of data[:end], given those of all shorter prefixes."""
        for token in reversed(self.ending(data, end)):
            start = end - self.length_of[token]
            if self.fits(last[start], token) if start else self.whole(token):
                return token
        raise ValueError("a byte has no token in this vocabulary")

    def _prefix(self, data: bytes) -> int:
        """The token that ends the encoding of a prefix; pieces share their prefixes, and only those that a piece needs are filled."""
        fits, prefixes, length, end = self._fits, self._prefixes, self.length_of, len(data)
        for token in reversed(self.ending(data, end)):
            start = end - length[token]
            if fits[prefixes[data[:start]] << 32 | token] if start else self.whole(token):
                return token
        raise ValueError("a byte has no token in this vocabulary")

    def _short(self, data: bytes) -> tuple[int, ...]:
        """The ids of a piece of few bytes, read back from the prefix table."""
        out: list[int] = []
        while data:
            out.append(self._prefixes[data])
            data = data[: -self.length_of[out[-1]]]
        return tuple(reversed(out))

    def last_tokens(self, data: bytes) -> list[int]:
        """last[i] is the token that ends data[:i]."""
        last = [-1]
        for end in range(1, len(data) + 1):
            last.append(self.last_token(data, end, last))
        return last

    def read_back(self, last: list[int]) -> tuple[int, ...]:
        out, at = [], len(last) - 1
        while at > 0:
            out.append(last[at])
            at -= self.length_of[last[at]]
        return tuple(reversed(out))

    def _piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8")
        token = self.ranks.get(data)
        if token is not None:
            return (token,)
        return self._short(data) if len(data) <= SHORT else self.read_back(self.last_tokens(data))

    def _ids(self, text: str) -> bytes:
        """The ids of a text, four bytes each."""
        out: list[int] = []
        for p in self.pattern.findall(text):
            out += self._piece(p)
        return array("i", out).tobytes()

    def packed(self, text: str | None) -> bytes:
        """The ids of a text as 32-bit numbers, little end first."""
        if not text:
            return b""
        if not self.cuts_at_spaces or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n" or OTHER_SPACE.search(text):
            return self._ids(text)
        first, following, feed, out = self._first.__getitem__, self._next.__getitem__, self._first["\n"], []
        for line in text.split("\n"):
            words = line.split(" ")
            out.append(first(words[0]))
            out += map(following, words[1:])
            out.append(feed)
        out.pop()
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), "<i4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class EditedText:
    """A text that keeps its pieces and their prefix tables, for appends and edits.

    ``replace`` cuts anew from the piece before the edit until a cut falls on an old one past the
    edit; pieces outside keep their tables, and a changed piece keeps the entries before its change.
    """

    def __init__(self, coder: BytePairs, text: str = ""):
        self.coder, self.text, self.pieces, self.tables = coder, "", [], []
        self.recomputed = 0
        self.replace(0, 0, text)

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, end: int, new: str) -> None:
        shift = len(new) - (end - start)
        cuts = np.concatenate(([0], np.cumsum([len(p) for p in self.pieces]))).astype(int).tolist()
        first = max(0, int(np.searchsorted(cuts, start, side="left")) - 2)
        text = self.text[:start] + new + self.text[end:]
        old = {c + shift: i for i, c in enumerate(cuts) if c >= end}
        pieces, tables, at, keep = [], [], cuts[first], len(self.pieces)
        for match in self.coder.pattern.finditer(text, at):
            if match.start() in old and match.start() >= start + len(new):
                keep = old[match.start()]
                break
            pieces.append(match[0])
            before = self.pieces[first + len(pieces) - 1] if first + len(pieces) <= len(self.pieces) else ""
            table = self.tables[first + len(pieces) - 1] if before else [-1]
            tables.append(self._table(before.encode(), table, match[0].encode()))
        self.pieces[first:keep] = pieces
        self.tables[first:keep] = tables
        self.text = text

    def _table(self, old: bytes, table: list[int], new: bytes) -> list[int]:
        """Entries are kept up to the first changed byte, and again once `longest` entries agree."""
        same = 0
        while same < min(len(old), len(new)) and old[same] == new[same]:
            same += 1
        tail = 0
        while tail < min(len(old), len(new)) - same and old[-1 - tail] == new[-1 - tail]:
            tail += 1
        last, agree, shift = table[: same + 1], 0, len(old) - len(new)
        for end in range(len(last), len(new) + 1):
            last.append(self.coder.last_token(new, end, last))
            self.recomputed += 1
            agree = agree + 1 if end > len(new) - tail and last[end] == table[end + shift] else 0
            if agree >= self.coder.longest:
                return last + table[end + shift + 1 :]
        return last

    def ids(self) -> list[int]:
        out: list[int] = []
        for piece, table in zip(self.pieces, self.tables):
            token = self.coder.ranks.get(piece.encode())
            out += (token,) if token is not None else self.coder.read_back(table)
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def shared_coder(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """The vocabulary (a fixed file of about 1 MB) for all tasks; one coder is kept per worker."""
    return spark.sparkContext.broadcast((path, pattern, read_ranks(path)))


def _coder(shared: Broadcast) -> BytePairs:
    path, pattern, ranks = shared.value
    key = (path, pattern, len(ranks))
    if key not in _CODERS:
        _CODERS[key] = BytePairs(ranks, pattern)
    return _CODERS[key]


def encode(documents: DataFrame, shared: Broadcast, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) for each row, in tasks that see only these two columns.

    decoded: also the bytes that the ids decode to, by the same worker; decode() does it for ids at hand.
    Null and empty texts have no ids; repeated rows and ids are encoded row by row; texts of any length are
    encoded whole; an empty table gives an empty result.
    """
    frame = lean(documents).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                packed = [coder.packed(t) for t in part.column(1).to_pylist()]
                cuts = np.concatenate(([0], np.cumsum([len(x) // 4 for x in packed]))).astype(np.int32)
                ids = np.frombuffer(b"".join(packed), "<i4")
                columns = {"doc_id": part.column(0), "ids": pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids))}
                if decoded:
                    columns["decoded"] = pa.array([coder.decode(ids[a:b].tolist()) for a, b in zip(cuts, cuts[1:])], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(run, f"doc_id {kind}, ids array<int>" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, shared: Broadcast, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded binary``: the bytes of the ids; null ids decode to no bytes."""

    @F.pandas_udf("binary")
    def decoded(ids):  # noqa: ANN001, ANN202
        bytes_of = {i: token for token, i in shared.value[2].items()}
        return ids.map(lambda x: b"" if x is None else b"".join([bytes_of[i] for i in x.tolist()]))

    return encoded.withColumn("decoded", decoded(F.col(ids_col)))
