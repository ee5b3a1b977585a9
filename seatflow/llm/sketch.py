"""A count-min sketch built by partitions, merged by blocks, and used as a filter for repeated keys.

Each task counts its keys into two rows of saturating counters and sends, per block of counters, the
places that it has seen once and more than once. Blocks are merged one after the other from sorted
rows. What is kept of the merged sketch is one bit a counter, set where the count is two or more, so
a key's estimate is at least its count: no repeated key is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatflow.llm.common import lean

BLOCK = 1 << 16
ROWS = 2
#: Counters in a row: at least LEAST; at most MOST, at which the broadcast bits take 2 * 2**29 / 8 bytes = 128 MB.
LEAST, MOST = 1 << 20, 1 << 29
#: Counters for each expected key.
SPARE = 8
#: Keys that a task holds before it folds them into places.
FOLD = 1 << 20


def width_for(keys: float) -> int:
    """Counters in a row, a power of two; past MOST the sketch passes more keys on, and still loses none."""
    return int(min(MOST, max(LEAST, 1 << int(np.ceil(np.log2(max(1.0, keys * SPARE)))))))


def places(keys: np.ndarray, width: int) -> list[np.ndarray]:
    """The counter of each key in each row."""
    mask = np.uint64(width - 1)
    return [(keys & mask).astype(np.int64), ((keys >> np.uint64(33)) * np.uint64(0x9E3779B1) >> np.uint64(2) & mask).astype(np.int64)]


def repeated_bits(frame: DataFrame, keys_of: Callable[[pd.DataFrame], Iterator[np.ndarray]], width: int) -> Broadcast:
    """Counts the uint64 keys that keys_of yields from each part of the frame; returns the bits for repeated()."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, more, held, n = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def fold() -> None:
            nonlocal once, more, held, n
            at = np.concatenate([p + r * width for keys in held for r, p in enumerate(places(keys, width))] or [once[:0]])
            at, c = np.unique(np.concatenate([at, once, more, more]), return_counts=True)
            once, more, held, n = at[c == 1], at[c > 1], [], 0

        for part in parts:
            for keys in keys_of(part):
                held.append(keys)
                n += len(keys)
                if n >= FOLD:
                    fold()
        fold()
        out = []
        cuts = np.arange(0, ROWS * width + 1, BLOCK)
        a, b = np.searchsorted(once, cuts), np.searchsorted(more, cuts)
        for k in np.flatnonzero((np.diff(a) > 0) | (np.diff(b) > 0)):
            local = [(x[i:j] - k * BLOCK).astype(np.uint16).tobytes() for x, i, j in ((once, a[k], a[k + 1]), (more, b[k], b[k + 1]))]
            out.append((int(k), *local))
        yield pd.DataFrame(out, columns=["block", "once", "more"])

    def merge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, seen, twice = None, None, None

        def bits() -> pd.DataFrame:
            return pd.DataFrame([(at, np.packbits(twice).tobytes())], columns=["block", "bits"])

        for part in parts:
            for block, once, more in zip(part["block"], part["once"], part["more"]):
                if block != at:
                    if at is not None:
                        yield bits()
                    at, seen, twice = block, np.zeros(BLOCK, bool), np.zeros(BLOCK, bool)
                one, two = np.frombuffer(once, np.uint16), np.frombuffer(more, np.uint16)
                twice[one] |= seen[one]
                seen[one] = True
                twice[two] = seen[two] = True
        if at is not None:
            yield bits()

    counted = lean(frame).mapInPandas(count, "block long, once binary, more binary")
    merged = counted.repartition("block").sortWithinPartitions("block").mapInPandas(merge, "block long, bits binary")
    full = bytearray(ROWS * width // 8)
    for row in merged.toLocalIterator():  # of a fixed size: ROWS * width bits
        full[row["block"] * BLOCK // 8 : (row["block"] + 1) * BLOCK // 8] = row["bits"]
    return frame.sparkSession.sparkContext.broadcast(bytes(full))


def repeated(bits: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether each key's estimate is two or more."""
    table, width = np.frombuffer(bits, np.uint8), len(bits) * 8 // ROWS
    out = np.ones(len(keys), bool)
    for r, p in enumerate(places(keys, width)):
        p = p + r * width
        out &= (table[p >> 3] >> (7 - (p & 7)).astype(np.uint8) & 1).astype(bool)
    return out


def text_bytes(frame: DataFrame, text_col: str = "text") -> int:
    return frame.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
