"""SimHash near-duplicates: deletion-variant signatures joined on equality, then verified.

Fingerprints of 64 bits link at 3 or fewer differing bits. Cut in two halves, one half then differs
by at most one bit. Each distinct fingerprint is indexed under both exact halves, and under each
half with one bit as a wildcard; a wildcard entry joins only entries with the other value of that
bit, so a pair meets at the one bit where its halves differ, not at all 32. Every candidate's
distance is verified. Copies share a fingerprint and enter the join once, as its class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatflow.llm.common import WORD, checkpoint, lean
from seatflow.llm.components import connected_components

HALF = 32


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of a text: majority bits over its shingles' XXH64, repeats included.

    A-Z are lower-cased; fewer words than a shingle make one shingle; no words give 0.
    """
    words = WORD.findall((text or "").encode("utf-8").lower())
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, seed) for s in shingles], dtype=">u8")
    n, ones = len(hashes), np.zeros(64, np.int64)
    for at in range(0, n, 4096):  # bounds the memory of very long texts
        ones += np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp long: the 64 bits as a signed number) for each row; null and empty texts have 0."""
    frame = lean(documents).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            fp = np.array([simhash(t, shingle) for t in part["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": part["doc_id"], "fp": fp.view(np.int64)})

    return frame.mapInPandas(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, fp long")


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Distinct fingerprints (fp) to their links (a, b) at `distance` (3 at most) or fewer bits; a pair may come twice."""
    if not 0 <= distance <= 3:
        raise ValueError("two halves with one wildcard find links of at most 3 bits")
    # slot: 0-32 for the upper half and 33-65 for the lower; 32 and 65 are the exact halves
    entry = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(2 * HALF + 1))).alias("slot"))
    entry = entry.withColumns({"bit": F.expr("slot % 33"), "half": F.expr("if(slot < 33, shiftrightunsigned(fp, 32), fp & 4294967295L)")})
    entry = entry.withColumns({
        "side": F.expr("if(bit = 32, 2, cast(shiftright(half, bit) & 1 as int))"),
        "key": F.expr("shiftleft(cast(slot as bigint), 32) | if(bit = 32, half, half & ~shiftleft(1L, bit))"),
    })
    left = entry.where("side <> 1").select("key", F.col("fp").alias("a"), "side")
    right = entry.where("side <> 0").select("key", F.col("fp").alias("b"))
    near = F.expr(f"bit_count(a ^ b) <= {int(distance)} and (side = 0 or a < b)")
    return left.join(right, (left["key"] == right["key"]) & near).select("a", "b")


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for each row: component_id is the smallest id that links reach, itself included.

    Rows of one fingerprint are one class. Null ids are never the smallest unless all are null;
    texts without words share fingerprint 0. An empty table gives an empty result.
    """
    rows = checkpoint(fingerprints(documents, id_col, text_col, shingle))
    classes = checkpoint(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = connected_components(links(classes.select("fp"), distance)).select(F.col("node").alias("fp"), "root")
    classes = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    reached = classes.join(smallest, "root").select("fp", "component_id")
    return rows.join(reached, "fp").select("doc_id", "fp", "component_id")
