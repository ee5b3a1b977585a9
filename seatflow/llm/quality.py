"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are those of the whole text alone. Labels come from a bounded sample of the labelled rows
that aren't held out: where there are more than SAMPLE, those with the least hashes of their ids.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatflow.llm.common import WORD, held_out, lean, stored
from seatflow.llm.trees import boosted

#: About how many labelled rows the trees learn from at most.
SAMPLE = 40_000
ACCEPT = 0.3
LETTERS = np.array([(65 <= b <= 90) or (97 <= b <= 122) or b >= 0xC0 for b in range(256)])
FEATURES = [
    "log_bytes", "log_words", "mean_word", "sd_word", "longest_word", "distinct_words", "top_word", "lines", "mean_line", "repeated_lines", "short_lines",
    "upper", "lower", "digit", "space", "newline", "comma", "period", "pipe", "exclaim", "symbol", "other_mark", "high_bytes", "capital_words",
    "plain_words", "marked_words", "one_letter_words", "word_pairs", "entropy", "ends_well",
]


def statistics(text: str | None) -> list[float]:
    """The FEATURES of a text; an empty one has zeros."""
    raw = (text or "").encode("utf-8")
    words = WORD.findall(raw)
    if not words:
        return [0.0] * len(FEATURES)
    n, w = len(raw), len(words)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / n
    lengths = np.fromiter(map(len, words), np.int64, w)
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    marks = hist[33:48].sum() + hist[58:65].sum() + hist[91:97].sum() + hist[123:127].sum()
    full = hist[hist > 0]
    ends = np.fromiter((x[-1] for x in words), np.int64, w)
    starts = np.fromiter((x[0] for x in words), np.int64, w)
    return [
        np.log1p(n), np.log1p(w), lengths.mean(), lengths.std(), lengths.max(), len(counts) / w, counts.most_common(1)[0][1] / w,
        np.log1p(len(lines)), n / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)), sum(len(x) < 30 for x in lines) / max(1, len(lines)),
        hist[65:91].sum(), hist[97:123].sum(), hist[48:58].sum(), hist[32], hist[10], hist[44], hist[46], hist[124], hist[33],
        hist[[35, 36, 37, 38, 42]].sum(), marks, hist[128:].sum(), ((starts >= 65) & (starts <= 90)).mean(),
        LETTERS[ends].mean(), (~LETTERS[ends] & (ends != 44) & (ends != 46)).mean(), (lengths == 1).mean(), pairs / max(1, w - 1), -(full * np.log2(full)).sum(),
        float(raw.rstrip()[-1:] in b".!?"),
    ]


def document_statistics(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, features array<double>) for each row."""
    frame = lean(documents).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"doc_id": part["doc_id"], "features": [list(map(float, statistics(t))) for t in part["text"]]})

    return frame.mapInPandas(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, features array<double>")


def statistics_table(documents: DataFrame, remainder: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, features, held_out), written to the shared folder: training and scoring both read it."""
    return stored(document_statistics(documents, id_col, text_col).withColumn("held_out", held_out(F.col("doc_id"), remainder)))


def learned(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Broadcast:
    """The model from a statistics table and labels(doc_id, quality), without the rows that are held out.

    An id with several labels counts with their mean's nearest; null labels and ids are skipped. Without
    any label all scores are 0.5.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    learn = rows.where(~F.col("held_out")).join(known, "doc_id")
    total = learn.count()
    if total > sample:
        learn = learn.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample / total))
    got = learn.select("doc_id", "features", "label").toPandas().sort_values("doc_id", kind="stable")  # about `sample` rows at most
    x = np.array(got["features"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return rows.sparkSession.sparkContext.broadcast(boosted(x, got["label"].to_numpy(dtype=float)))


def scored(documents: DataFrame, labels: DataFrame, remainder: int = 0, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row; held out are ids whose crc32 as text mod 5 is `remainder`.

    Null and empty texts have statistics of zero and are scored like any other. Repeated rows, and rows that
    share an id, are scored each by its own text. Texts are read whole, whatever their length. A null id is
    never held out and has no label. An empty table gives an empty result.
    """
    rows = statistics_table(documents, remainder, id_col, text_col)
    model = learned(rows, labels, sample)

    @F.pandas_udf("double")
    def score(features: pd.Series) -> pd.Series:
        return pd.Series(model.value.score(np.array(features.tolist(), dtype=float).reshape(-1, len(FEATURES))))

    return rows.select("doc_id", "held_out", score("features").alias("score")).withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def accepted(documents: DataFrame, model: Broadcast, text_col: str = "text", least: float = ACCEPT) -> DataFrame:
    """The rows whose text scores at least `least`, with all their columns; null and empty texts are scored as empty ones."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.value.score(np.array([statistics(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))))

    return lean(documents).where(score(F.col(text_col)) >= least)
