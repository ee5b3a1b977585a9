"""Media columns: texts stored as Matroska files, read back through packet tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatflow.llm.common import lean
from seatflow.llm.matroska import FRAME, parsed, samples, written


def payload_of(text: str | None) -> bytes:
    """UTF-8 bytes and zeros up to a positive multiple of 64; null counts as empty."""
    raw = (text or "").encode("utf-8")
    return raw + bytes(-len(raw) % FRAME or (0 if raw else FRAME))


def stored_media(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media binary): each text's payload as the samples of a Matroska file."""
    frame = lean(documents).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    @F.pandas_udf("binary")
    def media(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: written(payload_of(t)))

    return frame.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), media("text").alias("media"))


def packet_tables(media: DataFrame, media_col: str = "media", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and each file's tables: tracks, packets, cues, the payload, and ``error`` where it isn't well-formed.

    packets: array of (track, timestamp, begin, end, keyframe); cues: array of (timestamp, track,
    cluster_at). A null or broken file has empty tables, no payload and its error. Repeated rows are
    read alike, and an empty table gives an empty result.
    """
    schema = ", ".join([f"{k} {media.schema[k].dataType.simpleString()}" for k in keep]) + (
        ", tracks array<struct<track:long,codec:string,rate:double,channels:long,depth:long>>, packets array<struct<track:long,timestamp:long,begin:long,end:long,keyframe:boolean>>"
        ", cues array<struct<timestamp:long,track:long,cluster_at:long>>, payload binary, error string"
    )

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), 256):
                rows = []
                for raw in part[media_col].iloc[at : at + 256]:
                    try:
                        if raw is None:
                            raise ValueError("no file")
                        m = parsed(bytes(raw))
                        tracks = [dict(track=n, codec=t[0], rate=t[1], channels=t[2], depth=t[3]) for n, t in m.tracks.items()]
                        packets = [dict(track=p[0], timestamp=p[1], begin=p[2], end=p[3], keyframe=p[4]) for p in m.packets]
                        rows.append((tracks, packets, [dict(timestamp=a, track=b, cluster_at=c) for a, b, c in m.cues], samples(raw, m, next(iter(m.tracks), 1)), None))
                    except ValueError as e:
                        rows.append(([], [], [], None, str(e)))
                out = part[list(keep)].iloc[at : at + 256].reset_index(drop=True)
                yield pd.concat([out, pd.DataFrame(rows, columns=["tracks", "packets", "cues", "payload", "error"])], axis=1)

    return media.select(*keep, media_col).mapInPandas(run, schema)
