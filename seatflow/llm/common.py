"""What several of the text operators share: tables, shared folders and hashing.

Words are maximal runs of bytes other than space and 0x09-0x0D in the UTF-8 text.
"""

from __future__ import annotations

import functools
import hashlib
import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Texts to an Arrow batch at most: whole texts are long, and a Python worker holds a batch several times over.
BATCH_ROWS = 1_000


def lean(frame: DataFrame) -> DataFrame:
    """The same frame; lowers its session's Arrow batch size to BATCH_ROWS, so that workers stay small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(frame.sparkSession.conf.get(key)) > BATCH_ROWS:
        frame.sparkSession.conf.set(key, str(BATCH_ROWS))
    return frame


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it.

    Only in local mode, where one process does all, a folder of our own takes its place if it is unset.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="seatflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Removes a statement's shuffle files once it has run.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint(frame: DataFrame) -> DataFrame:
    """Cuts lineage with a reliable checkpoint in the shared folder."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint()


def stored(frame: DataFrame) -> DataFrame:
    """Writes a frame as Parquet in the shared folder and reads it back: compressed, and pruned by column.

    The shuffle files that made it are removed when it is written; if a reader loses an executor, the
    table is still there.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/seatflow-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing will read again; what was made of them must be stored itself."""
    for frame in tables:
        spark = frame.sparkSession
        for folder in {f.rpartition("/")[0] for f in frame.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if path.getName().startswith("seatflow-"):
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_mark(text: Column) -> Column:
    """128 bits of the text's SHA-256. With the id it tells apart rows that share an id; rows equal in both are alike."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def held_out(doc_id: Column, remainder: int) -> Column:
    """crc32 of the id as text, mod 5, equals the remainder; a null id is never held out."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % 5 == remainder, F.lit(False))


# --- vectorised hashing ----------------------------------------------------------------

_MULTIPLIER = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse mod 2**64, at least n of them."""
    if _POWERS.get(0) is None or len(_POWERS[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for key, base in ((0, _MULTIPLIER), (1, pow(_MULTIPLIER, -1, 1 << 64))):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _POWERS[key] = np.multiply.accumulate(out)
    return _POWERS[0], _POWERS[1]


def byte_codes(seed: int) -> np.ndarray:
    """A random 64-bit code for each byte value."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 0x632BE59BD9B4E019))


CODES = byte_codes(1)
#: The low bytes of eight that a word fills, by its length.
LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Words longer than this aren't remembered.
LONG_WORD = 256


_SPACE = np.zeros(256, np.int8)
_SPACE[[32, 9, 10, 11, 12, 13]] = 1


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of bytes."""
    space = np.ones(len(data) + 2, np.int8)
    np.take(_SPACE, data, out=space[1:-1])
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word in an array of bytes."""
    return span_word_hashes(data, *word_spans(data))


def _long_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


_remembered_hash = functools.lru_cache(1 << 16)(_long_hash)


def span_word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words that lie between these starts and ends.

    Words of up to seven bytes never collide: their bytes and their length are one number, mixed by a
    bijection. Longer ones are hashed by BLAKE2, so no one can choose words that do.
    """
    lengths = ends - starts
    eight = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    out = mixed((eight[starts] & LOW[np.minimum(lengths, 8)]) | lengths.astype(np.uint64) << np.uint64(56))
    long = np.flatnonzero(lengths > 7)
    raw = data.tobytes()
    spans = zip(starts[long].tolist(), ends[long].tolist())
    out[long] = np.array([(_remembered_hash if b - a <= LONG_WORD else _long_hash)(raw[a:b]) for a, b in spans], np.uint64)
    return out


def run_hashes(values: np.ndarray, width: int, doubled: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """A polynomial hash of each run of `width` consecutive values, by doubling. doubled keeps the powers of two."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    doubled = {1: values} if doubled is None else doubled
    doubled.setdefault(1, values)
    out, at, bit = None, 0, 1 << (width.bit_length() - 1)
    while bit:
        if width & bit:
            have = max(k for k in doubled if k <= bit)
            while have < bit:
                h = doubled[have]
                step = np.uint64(pow(_MULTIPLIER, have, 1 << 64))
                doubled[2 * have] = h[:-have] * step + h[have:]
                have *= 2
            part = doubled[bit][at : at + n]
            out = part if out is None else out * np.uint64(pow(_MULTIPLIER, bit, 1 << 64)) + part
            at += bit
        bit >>= 1
    return out


def span_hashes(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of values, of any length."""
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of `width` values, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:n], values[rest : rest + n])
