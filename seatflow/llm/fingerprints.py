"""One-permutation MinHash over tables: a fingerprint column, and documents paired with their neighbour by id."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatflow.llm.common import lean, stored
from seatflow.llm.minhash import fingerprint, likeness

LEAST_ID = -(1 << 63)
#: Bytes of text to a part of consecutive ids, and the least parts.
PART_BYTES, LEAST_PARTS = 12_000_000, 12


def with_fingerprint(documents: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of a text column; null texts count as empty."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(fingerprint)

    return documents.withColumn(out, of(F.coalesce(F.col(text_col), F.lit(""))))


def edited(text: str, after: str) -> str:
    """The last floor(n/2) code points give way to the first as many (or all) of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def with_next(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints each text and the text edited with the next document's, in descending order of id.

    The last document's next is the first. Texts move once, into ranges of (id, text), as many as their
    bytes need; within a range each row meets the one after it. The last row of a range then meets the first
    row of the next range that has any, by a join on the ranges' numbers. Rows that share an id follow
    each other by the hash of their text, then by text; a null id comes last, and null texts are empty. One
    row is its own next; an empty table gives an empty result.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST_ID))
    frame = lean(documents).select(F.col(id_col).alias("doc_id"), key.alias("place"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    digests = names[2:5]  # kept as bytes until the end
    schema = f"doc_id {kind}, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"

    size = frame.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(LEAST_PARTS, -(-size // PART_BYTES))
    order = [F.desc("place"), F.xxhash64("text")]  # no text: the ranges are found from a sample of these on the driver
    ranged = frame.repartitionByRange(int(parts), *order).sortWithinPartitions(*order, "text").select("doc_id", "text", F.spark_partition_id().alias("part"))

    def pair(doc_id, text: str, mark: str, after: str, after_mark: str) -> tuple:  # noqa: ANN001
        changed = edited(text, after)
        mark2 = mark if changed == text else fingerprint(changed)
        sha = hashlib.sha256(changed.encode("utf-8")).digest()
        return doc_id, len(text), sha, bytes.fromhex(mark), bytes.fromhex(mark2), likeness(mark, mark2), likeness(mark, after_mark)

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            out = []
            for doc_id, text, part in zip(batch["doc_id"], batch["text"], batch["part"]):
                mark = fingerprint(text)
                out.append((*pair(*held[:3], text, mark), None, part, None) if held else (doc_id, *[None] * 6, text, part, "first"))
                held = (doc_id, text, mark, part)
            yield pd.DataFrame(out, columns=[*names, "text", "part", "end"]).astype({"n_chars": "Int64"})
        if held:
            yield pd.DataFrame([(held[0], *[None] * 6, held[1], held[3], "last")], columns=[*names, "text", "part", "end"]).astype({"n_chars": "Int64"})

    told = stored(ranged.mapInPandas(inside, f"{schema}, text string, part int, end string"))
    first, last = (told.where(F.col("end") == end).select("doc_id", "text", "part") for end in ("first", "last"))
    filled = sorted(r["part"] for r in first.select("part").collect())  # the ranges' numbers
    follows = told.sparkSession.createDataFrame(list(zip(filled, filled[1:] + filled[:1])), "part int, next int")
    ends = last.join(follows, "part").join(first.select(F.col("part").alias("next"), F.col("text").alias("after")), "next").select("doc_id", "text", "after")

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [pair(i, t, fingerprint(t), a, fingerprint(a)) for i, t, a in zip(batch["doc_id"], batch["text"], batch["after"])]
            yield pd.DataFrame(rows, columns=names)

    out = told.where("end is null").select(*names).unionByName(ends.mapInPandas(across, schema))
    return out.select(*[F.lower(F.hex(c)).alias(c) if c in digests else c for c in names])
