"""Document fingerprints by one-permutation MinHash.

Each shingle is hashed once; the upper bits choose a bin, whose least hash is kept. An empty bin
takes the value of the first filled bin in a fixed pseudo-random order of its own (optimal
densification), which doesn't depend on the text. Of each value the low 8 bits are packed. Unequal
values agree in 8 bits once in 256; likeness() takes this bias out.

Shingles are five consecutive words, unchanged; fewer words make one shingle. A text without words
has the fingerprint of all zeros, which is like itself only.
"""

from __future__ import annotations

import numpy as np

from seatflow.llm.common import mixed, run_hashes, word_hashes

BINS = 256
BITS = 8
SHINGLE = 5
NOTHING = "00" * BINS


def densified(values: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Fills each empty bin from the first filled one in its own probing order."""
    out, empty, attempt = values.copy(), np.flatnonzero(~filled), 0
    while len(empty):
        attempt += 1
        probe = (mixed(empty.astype(np.uint64) * np.uint64(1 << 32) + np.uint64(attempt)) % np.uint64(len(values))).astype(np.int64)
        found = filled[probe]
        out[empty[found]] = values[probe[found]]
        empty = empty[~found]
    return out


def fingerprint(text: str | None) -> str:
    """256 bins of 8 bits each as lowercase hex."""
    data = np.frombuffer((text or "").encode("utf-8"), np.uint8)
    words = word_hashes(data)
    if not len(words):
        return NOTHING
    hashes = np.sort(mixed(run_hashes(words, min(SHINGLE, len(words)))))
    shift = np.uint64(64 - (BINS - 1).bit_length())
    bins = (hashes >> shift).astype(np.int64)
    first = np.concatenate(([True], bins[1:] != bins[:-1]))
    values, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    values[bins[first]], filled[bins[first]] = hashes[first], True
    return (mixed(densified(values, filled)) & np.uint64((1 << BITS) - 1)).astype(np.uint8).tobytes().hex()


def likeness(one: str, other: str) -> float:
    """The estimated Jaccard similarity of two fingerprints' shingle sets, from 0 to 1."""
    if one == other:
        return 1.0
    if NOTHING in (one, other):
        return 0.0
    a, b = (np.frombuffer(bytes.fromhex(x), np.uint8) for x in (one, other))
    chance = 2.0**-BITS
    return float(min(1.0, max(0.0, (np.count_nonzero(a == b) / BINS - chance) / (1 - chance))))
