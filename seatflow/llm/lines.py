"""Line dedup in SQL functions: lines are exploded, hashed and counted by document, and texts are put together again by position.

A line's key is the line without blanks (space, 0x09-0x0D) at its ends and with A-Z lower-cased. Keys
travel as 128 bits of their SHA-256, with the document and the line's position. Documents are counted
distinct per hash: once per document first, so that a line that every document has is counted where it
lies before it meets its like. Hashes over the threshold are stored, and the lines joined to them are
plain shuffles on both sides, which adaptive execution splits where one line is very frequent.

A document gets back the positions that go, each with its hash. What to drop hangs on (id, key) alone,
so rows that share an id but not a text can't lose a line of one another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatflow.llm.common import stored

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS, LEAST_DOCUMENTS = 10, 2


def keys_of(text: Column) -> Column:
    """The lower-cased lines of a text, with the blanks at their ends."""
    return F.split(F.translate(text, UPPER, LOWER), "\n", -1)


def key_hash(line: Column) -> Column:
    """The first 128 bits of the SHA-256 of a lower-cased line's key, in hex."""
    return F.substring(F.sha2(F.trim(line, F.lit(BLANKS)).cast("binary"), 256), 1, 32)


def key_chars(line: Column) -> Column:
    return F.length(F.trim(line, F.lit(BLANKS)))


def repeated_lines(documents: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, pos, hash binary): the lines to drop. Their keys have `least_chars` code points or more, are found in
    `least_documents` documents or more, and a smaller id holds them too. Rows without an id are left alone and don't count."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    each = documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.posexplode(keys_of(text)).alias("pos", "line"))
    lines = each.where(key_chars(F.col("line")) >= least_chars).select("doc_id", "pos", F.unhex(key_hash(F.col("line"))).alias("hash"))
    held = lines.groupBy("hash").agg(F.count_distinct("doc_id").alias("n"), F.min("doc_id").alias("first"))
    held = stored(held.where(F.col("n") >= least_documents).select("hash", "first"))
    return lines.join(held, "hash").where("doc_id > first").select("doc_id", "pos", "hash")


def without_repeated_lines(documents: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds ``n_lines`` (before dropping), ``n_dropped`` and ``kept`` (the lines left, joined by \\n) to all columns.

    Texts are split at \\n. A null or empty text is one empty line. A line repeated within one document
    only stays; the smallest id that holds a key keeps all its lines of it. Rows that share an id are one
    document: they don't drop one another's lines, and lose the same ones. Rows without an id lose
    nothing. A text of any length is split where it lies; an empty table gives an empty result.
    """
    names = documents.columns
    found = repeated_lines(documents, least_chars, least_documents, id_col, text_col)
    # per document, so a list is never longer than the lines of the rows of one id
    gone = found.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list(F.concat_ws(" ", "pos", F.lower(F.hex("hash")))).alias("_gone"))
    rows = documents.select(F.struct(*names).alias("_row"), F.col(id_col).alias("_own"))
    rows = rows.join(gone, F.col("_own") == F.col("_id"), "left").select("_row", "_gone", F.coalesce(F.col(f"_row.`{text_col}`"), F.lit("")).alias("_text"))
    places = F.transform(keys_of(F.col("_text")), lambda line, i: F.concat_ws(" ", i, F.when(key_chars(line) >= least_chars, key_hash(line))))
    left = F.transform(F.array_except(places, F.col("_gone")), lambda place: F.substring_index(place, " ", 1).cast("int"))
    lines = F.split(F.col("_text"), "\n", -1)
    # a list of one, so that both lists are made once and not once for each line
    both = F.array(F.struct(lines.alias("lines"), left.alias("left")))
    cut = F.transform(both, lambda x: F.struct(
        (F.size(x["lines"]) - F.size(x["left"])).alias("n"), F.array_join(F.transform(x["left"], lambda i: F.element_at(x["lines"], i + 1)), "\n").alias("kept"),
    ))
    whole = F.struct(F.lit(0).alias("n"), F.col("_text").alias("kept"))
    rows = rows.select("_row", F.size(lines).cast("long").alias("_n"), F.when(F.col("_gone").isNull(), whole).otherwise(F.element_at(cut, 1)).alias("_cut"))
    kept = [F.col(f"_row.`{x}`") for x in names if x not in ("n_lines", "n_dropped", "kept")]
    return rows.select(*kept, F.col("_n").alias("n_lines"), F.col("_cut.n").cast("long").alias("n_dropped"), F.col("_cut.kept").alias("kept"))
