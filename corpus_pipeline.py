"""From raw documents to token ids in five stages; each is one of the text operators.

1. quality classifier: documents that score below 0.3 go
2. SimHash near-dedup: documents whose five-word shingles agree to 0.8 or more are linked; of each group the smallest id stays
3. substring dedup: words in windows of 50 that an earlier document holds go
4. mixing: documents are repeated or left out so that sources come near their target weights
5. byte-level BPE: each text as token ids, with the digest of the bytes they decode to

A stage's result is written as Parquet in the shared folder and reread as the next one's documents.
Null texts count as empty throughout; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatflow.llm import bpe, mixing, nearness, quality, substring
from seatflow.llm.common import stored, table
from seatflow.llm.queries import VOCABULARY, sha256


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, learned from the labels without the held-out ids. Null and empty texts are
    scored as empty ones, repeated rows alike; without labels all score 0.5 and stay."""
    model = quality.learned(quality.statistics_table(docs), table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share an id are one document, of which the first by text stays. Rows without an id can't be
    told apart by one and all stay."""
    found = nearness.near_duplicates(docs)
    stay = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(stay, "doc_id", "left_semi").withColumn("_copy", F.row_number().over(Window.partitionBy("doc_id").orderBy("text", "lang", "source", "n_chars")))
    return kept.where("_copy = 1").select(*docs.columns).unionAll(docs.where("doc_id is null"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A text that loses words becomes those left, joined by one space; other texts stay as they are."""
    out = substring.without_repeats(docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("_doc")))
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept")).otherwise(F.col("text")), "n_chars": F.when(changed, F.length("kept").cast("long")).otherwise(F.col("_doc.n_chars"))}
    return out.select(*[(new[c] if c in new else F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select("doc_id", "source", mixing.sizes("text").alias("size"), F.struct(*docs.columns).alias("_doc"))
    mixed = mixing.mixed_copies(rows).where("copies > 0")
    return mixed.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_doc.*")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) for each row; null and empty texts have no tokens, and repeated rows stay rows."""
    coder = bpe.shared_coder(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    out = bpe.encode(docs, coder, decoded=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", sha256("decoded").alias("decoded_sha256"))


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("mixing", mix_sources),
    ("byte-level bpe", encode_tokens),
]

#: The classifier, SimHash and BPE can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
