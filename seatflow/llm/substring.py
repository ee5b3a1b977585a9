"""Substring dedup: repeated windows of words, found by a count-min prefilter and then exact grouping.

A window is a number of consecutive words of one document. The sketch counts, once per document,
the least hash among the 16-word grams inside each window (its anchor). Equal windows have equal
anchors, so the estimate is never below the number of documents that hold the window, and a
document adds one key for about 18 windows. Anchors are made once and stored beside the texts until the second pass
has read them. It groups only windows whose anchor is
estimated to repeat; none that repeats is lost.

It groups by BLAKE2 digests (128 bits) of the windows' words. Windows of one anchor in a row are a run; its digest
is that of its windows' digests. Runs are grouped first: where an earlier document has the same run, all its
windows repeat. Other runs are cut into pieces, at windows whose own digest says so, thus alike in texts that differ
nearby; pieces are grouped in the same way, those left cut finer, and the windows of those left one by one. The
first document of a window is always the first of the run and of the pieces that hold it there, so none
is missed. Copies and common passages so cost a row a run, and what stands beside an edit a row a piece. Each
grouping is stored before rows are joined to it, so that Spark can split the rows of a passage that many
documents have.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatflow.llm.common import WORD, dropped, lean, mixed, row_mark, run_hashes, sliding_min, stored, word_hashes
from seatflow.llm.sketch import repeated, repeated_bits, text_bytes, width_for

WINDOW, GRAM = 50, 16
#: Windows to a piece, about, in one cut after the other; each divides the one before, so that cuts stay cuts.
PIECES = (6, 2)
#: Bytes of a digest.
DIGEST = 16


def _words(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8"), np.uint8)


def _grams(words: np.ndarray, window: int) -> np.ndarray:
    """A hash of each gram, from the words' hashes."""
    return mixed(run_hashes(words, min(GRAM, window)))


def _anchors(grams: np.ndarray, window: int) -> np.ndarray:
    """The anchor of each window."""
    return sliding_min(grams, window - min(GRAM, window) + 1)


def _digest(raw: bytes | memoryview) -> bytes:
    return hashlib.blake2b(raw, digest_size=DIGEST).digest()


def _firsts(rows: DataFrame) -> DataFrame:
    """(digest, first): digests of several documents, and the smallest id of these; stored."""
    return stored(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("last > first").drop("last"))


def _judged(rows: DataFrame) -> DataFrame:
    """Adds to rows of (digest, doc_id) whether an earlier document has that digest; stored. What is judged needs its windows no more."""
    firsts = _firsts(rows)
    told = rows.join(firsts, "digest", "left").withColumn("earlier", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    out = stored(told.select("doc_id", "mark", "at", "n", "earlier", F.when(~F.col("earlier"), F.col("windows")).alias("windows")))
    dropped(firsts)
    return out


def _pieces(rows: DataFrame, every: int) -> DataFrame:
    """Rows of windows cut into pieces: a window whose digest's first byte `every` divides begins one."""
    byte = lambda i: F.conv(F.hex(F.substring("windows", i * DIGEST + 1, F.lit(1))), 16, 10).cast("int")
    begins = F.filter(F.sequence(F.lit(0), F.col("n").cast("int") - 1), lambda i: (i == 0) | (byte(i) % every == 0))
    rows = rows.withColumn("begins", begins).withColumn("ends", F.concat(F.slice("begins", 2, F.size("begins")), F.array(F.col("n").cast("int"))))
    each = rows.select("doc_id", "mark", "at", "windows", F.explode(F.arrays_zip("begins", "ends")).alias("cut"))
    many = F.col("cut.ends") - F.col("cut.begins")
    windows = F.substring("windows", F.col("cut.begins") * DIGEST + 1, many * DIGEST)
    out = each.select("doc_id", "mark", (F.col("at") + F.col("cut.begins")).alias("at"), many.cast("long").alias("n"), windows.alias("windows"))
    return out.withColumn("digest", F.when(F.col("n") == 1, F.col("windows")).otherwise(F.substring(F.unhex(F.sha2("windows", 256)), 1, DIGEST)))


def repeated_windows(documents: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, at, n): from window `at`, n windows in a row whose words also start in a document of a smaller id.

    mark is 128 bits of the text's hash. Null ids neither lose words nor count as smaller.
    """
    frame = lean(documents).where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, edges, keys = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                anchor = _anchors(_grams(word_hashes(_words(text)), window), window)
                if len(anchor):
                    begins = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
                    rows.append(i)
                    edges.append(np.append(begins, len(anchor)).tobytes())
                    keys.append(anchor[begins].tobytes())
            batch = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edges, pa.binary()), pa.array(keys, pa.binary())], names=["doc_id", "text", "mark", "edges", "anchors"])

    bytes_in = text_bytes(frame)
    kind = frame.schema["doc_id"].dataType.simpleString()
    # anchors are made once: the texts that have windows lie beside theirs until the runs are made
    texts = stored(frame.withColumn("mark", row_mark(F.col("text"))).mapInArrow(anchored, f"doc_id {kind}, text string, mark binary, edges binary, anchors binary"))

    def anchors(part: pd.DataFrame) -> Iterator[np.ndarray]:
        return (np.unique(np.frombuffer(found, np.uint64)) for found in part["anchors"])

    bits = repeated_bits(texts.select("anchors"), anchors, width_for(bytes_in / 100))  # about 18 words of 6 bytes a key

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, out = [], {k: [] for k in ("digest", "at", "n", "windows")}
            for i, (text, edges, keys) in enumerate(zip(*(batch.column(c) for c in ("text", "edges", "anchors")))):
                kept = repeated(bits.value, np.frombuffer(keys.as_buffer(), np.uint64))
                if not kept.any():
                    continue
                edges = np.frombuffer(edges.as_buffer(), np.int64)
                begins, ends = edges[:-1], edges[1:]
                words = text.as_buffer().to_pybytes().split()
                joined = memoryview(b" ".join(words))
                place = [0, *np.cumsum([len(w) + 1 for w in words]).tolist()]  # where each word begins
                for first, end in zip(begins[kept].tolist(), ends[kept].tolist()):
                    out["windows"].append(b"".join([_digest(joined[place[a] : place[a + window] - 1]) for a in range(first, end)]))
                    out["digest"].append(_digest(out["windows"][-1]))
                    out["at"].append(first)
                    out["n"].append(end - first)
                owner += [i] * int(kept.sum())
            if owner:
                ids, marks = (batch.column(c).take(pa.array(owner)) for c in ("doc_id", "mark"))
                kinds = {"digest": pa.binary(), "at": pa.int64(), "n": pa.int64(), "windows": pa.binary()}
                yield pa.RecordBatch.from_arrays([ids, marks, *[pa.array(out[k], kind) for k, kind in kinds.items()]], ["doc_id", "mark", *kinds])

    rows = stored(texts.mapInArrow(runs, f"doc_id {kind}, mark binary, digest binary, at long, n long, windows binary"))
    dropped(texts)
    told, found = _judged(rows), []
    dropped(rows)
    for every in PIECES:
        finer = _judged(_pieces(told.where("not earlier"), every))
        found.append(stored(told.where("earlier").select("doc_id", "mark", "at", "n")))
        dropped(told)  # with the windows of what is cut finer now
        told = finer
    each = _pieces(told.where("not earlier"), 1).drop("windows")
    firsts = _firsts(each)
    found += [stored(told.where("earlier").select("doc_id", "mark", "at", "n")), stored(each.join(firsts, "digest").where("doc_id > first").select("doc_id", "mark", "at", "n"))]
    dropped(told, firsts)
    out = found[0]
    for x in found[1:]:
        out = out.unionAll(x)
    return out


def without_repeats(documents: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds ``n_words``, ``n_removed`` and ``kept`` (the words left, joined by one space) to all columns.

    Each word covered by a repeated window (see repeated_windows) goes; windows are those of the
    input, not of what is left. Null and empty texts have no words and keep the empty text. Of equal
    texts the smallest id keeps its words; rows that share an id don't remove from each other.
    """
    names = documents.columns
    starts = repeated_windows(documents, window, id_col, text_col)
    starts = starts.select("doc_id", "mark", F.struct("at", "n").alias("at"))
    # per document, so a list is never longer than a text
    starts = starts.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_list("at").alias("_at"))
    rows = documents.withColumn("_row", F.struct(*names)).select("_row", F.col(id_col).alias("_own"), row_mark(F.col(text_col)).alias("_tag"))
    rows = rows.join(starts, (F.col("_own") == F.col("_id")) & (F.col("_tag") == F.col("_mark")), "left").select("_row", "_at")

    @F.pandas_udf("n_words long, n_removed long, kept string")
    def cut(texts: pd.Series, at: pd.Series) -> pd.DataFrame:
        out = []
        for text, found in zip(texts, at):
            words = WORD.findall((text or "").encode("utf-8"))
            n = len(words)
            if found is not None and len(found):
                edge = np.zeros(n + 1, np.int64)
                for start in found:
                    edge[start["at"]] += 1
                    edge[start["at"] + start["n"] + window - 1] -= 1
                words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:n]) == 0)]
            out.append((n, n - len(words), b" ".join(words).decode("utf-8")))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])

    added = rows.select("_row", cut(F.col(f"_row.`{text_col}`"), F.col("_at")).alias("_cut"))
    kept = [F.col(f"_row.`{x}`") for x in names if x not in ("n_words", "n_removed", "kept")]
    return added.select(*kept, "_cut.n_words", "_cut.n_removed", "_cut.kept")
