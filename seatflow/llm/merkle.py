"""A Merkle manifest of a dataset: a digest of every row, a root of every source, one root of all, and each row's witness.

Nodes of a level in runs of 16 become the digest of the run, until one is left. A witness is what a
verifier needs to fold a leaf up to the root: the other digests of each run on the way.

Witnesses grow as leaves are appended. A frontier takes the nodes of one aligned block (16 ** 3 places)
in order and keeps only the runs that are still open; a node gets its place in the open run of each
level at once, and each sibling that comes later, completed from below, extends the witnesses of all that
are in the run. Blocks are built by different tasks; their roots are then further appends to the
frontier of the next blocks up, and so on to the source's root. The sources' roots are the leaves of one
more such tree. On the way down each block is built again along with the witness of its root, which
its nodes' witnesses end in, so a task holds one block of 4,096 nodes and nothing is collected.

Places in a source come from counts: leaves are dealt to ranges of (source, order) and numbered inside,
and the ranges' counts give where each begins, so a source of any size spreads over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatflow.llm.common import lean, stored

#: Nodes to a run, and levels that a block spans.
ARITY, HEIGHT = 16, 3
#: What a leaf is the digest of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(digests: Iterable[bytes]) -> bytes:
    """The digest of digests as hex text, one after the other."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def leaf_of(*fields: Column) -> Column:
    """A leaf in hex: each field is `-` if null, else its UTF-8 byte count, `:` and itself."""
    told = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.sha2(F.concat(*told).cast("binary"), 256)


def height_of(nodes: int) -> int:
    """Levels above so many nodes."""
    height = 0
    while nodes > 1:
        nodes, height = -(-nodes // ARITY), height + 1
    return height


class Frontier:
    """An append-only tree of a given height: the open run of each level, and every node's place in its run."""

    def __init__(self, height: int) -> None:
        self.height = height
        self.open: list[list[bytes]] = [[] for _ in range(height + 1)]
        #: For each level and node there: the run it is in, which later siblings extend, and its place.
        self.places: list[list[tuple[list[bytes], int]]] = [[] for _ in range(height + 1)]

    def append(self, digest: bytes, level: int = 0) -> None:
        if len(self.open[level]) == ARITY:
            self.open[level] = []
        run = self.open[level]
        self.places[level].append((run, len(run)))
        run.append(digest)
        if len(run) == ARITY and level < self.height:
            self.append(digest_of(run), level + 1)

    def closed(self) -> bytes:
        """Completes the open runs from below; returns the root."""
        for level in range(self.height):
            if 0 < len(self.open[level]) < ARITY:
                self.append(digest_of(self.open[level]), level + 1)
        return self.open[self.height][0]

    def witness_so_far(self, node: int) -> list[list[bytes]]:
        """The siblings that are known by now, level by level, of a node that was appended."""
        runs = [self.places[level][node // ARITY**level] for level in range(self.height) if node // ARITY**level < len(self.places[level])]
        return [run[:place] + run[place + 1 :] for run, place in runs]

    def witness(self, node: int) -> tuple[bytes, bytes]:
        """The siblings on the node's way up, and (place, size) of each run on it, a byte each."""
        siblings, shape = [], bytearray()
        for level in range(self.height):
            run, place = self.places[level][node // ARITY**level]
            siblings += run[:place] + run[place + 1 :]
            shape += bytes((place, len(run)))
        return b"".join(siblings), bytes(shape)


def grown(digests: Iterable[bytes], nodes: int, height: int) -> Frontier:
    """The frontier of one block, of a group that has so many nodes in all."""
    tree = Frontier(min(height, height_of(nodes)))
    for digest in digests:
        tree.append(digest)
    return tree


def fold(leaf: str, siblings: bytes, shape: bytes) -> str:
    """The root, in hex, that a leaf in hex leads to with these siblings."""
    told, at = siblings.hex(), 0
    for place, size in zip(shape[::2], shape[1::2]):
        end = at + 64 * (size - 1)
        leaf = hashlib.sha256((told[at : at + 64 * place] + leaf + told[at + 64 * place : end]).encode()).hexdigest()
        at = end
    return leaf


def folded(leaf: str | Column, siblings: str | Column = "siblings", shape: str | Column = "shape") -> Column:
    """The root, in hex, that each leaf folds to with its siblings."""

    @F.pandas_udf("string")
    def run(leaves: pd.Series, siblings: pd.Series, shapes: pd.Series) -> pd.Series:
        return pd.Series([fold(*row) for row in zip(leaves, siblings, shapes)], dtype=object)

    return run(leaf, siblings, shape)


# --- places -----------------------------------------------------------------------------------


def placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``at`` (a node's place in its key by that order) and ``total`` (the key's nodes); key isn't null."""
    ranges = nodes.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    ranges = stored(ranges.withColumn("_row", F.monotonically_increasing_id())).withColumn("_range", F.shiftright("_row", 33))
    counts = ranges.groupBy("key", "_range").agg(F.count("*").alias("n"), F.min("_row").alias("first"))
    of = Window.partitionBy("key")
    before = F.coalesce(F.sum("n").over(of.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stored(counts.select("key", "_range", (before - F.col("first")).alias("_shift"), F.sum("n").over(of).alias("total")))
    return ranges.join(starts, ["key", "_range"]).withColumn("at", F.col("_row") + F.col("_shift")).drop("_row", "_range", "_shift")


def in_blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("at") / ARITY**height))


# --- up and down ------------------------------------------------------------------------------


def block_roots(nodes: DataFrame, height: int) -> DataFrame:
    """nodes (key, at, digest, total) to the same of their blocks."""
    size = ARITY**height

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        total = rows.column("total")[0].as_py()
        root = grown(rows.column("digest").to_pylist(), total, height).closed()
        out = {"key": [rows.column("key")[0].as_py()], "at": [rows.column("block")[0].as_py()], "digest": [root], "total": [-(-total // size)]}
        return pa.table(out, pa.schema([("key", pa.string()), ("at", pa.int64()), ("digest", pa.binary()), ("total", pa.int64())]))

    kept = in_blocks(nodes, height).select("key", "block", "at", "digest", "total")
    return stored(kept.groupBy("key", "block").applyInArrow(run, "key string, at long, digest binary, total long"))


def climbed(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The nodes, their blocks' roots, the roots of blocks of these, and so on to one root a key."""
    levels, most = [nodes], nodes.agg(F.coalesce(F.max("total"), F.lit(1))).first()[0]
    while most > 1:
        levels.append(block_roots(levels[-1], height))
        most = -(-most // ARITY**height)
    return levels


def witnessed(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """Adds to nodes the witnesses up to the last root, ``siblings`` and ``shape``; above: (key, at, siblings, shape) of their blocks' roots, and
    columns that are handed down."""
    handed = [c for c in above.columns if c not in ("key", "at", "siblings", "shape")]
    schema = nodes.drop(*handed).select("*", *[F.lit(None).cast(above.schema[c].dataType).alias(c) for c in handed], F.lit(b"").alias("siblings"), F.lit(b"").alias("shape")).schema
    own = [c for c in nodes.columns if c not in handed]

    def run(rows: pa.Table, roots: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        tree = grown(rows.column("digest").to_pylist(), rows.column("total")[0].as_py(), height)
        tree.closed()
        up, shape = roots.column("siblings")[0].as_py(), roots.column("shape")[0].as_py()
        told = [tree.witness(i) for i in range(rows.num_rows)]
        out = rows.select(own)
        for c in handed:
            value = roots.column(c)
            out = out.append_column(c, pa.array([value[0].as_py()] * rows.num_rows, value.type))
        out = out.append_column("siblings", pa.array([s + up for s, _ in told], pa.binary()))
        return out.append_column("shape", pa.array([s + shape for _, s in told], pa.binary()))

    left = in_blocks(nodes.select(*own), height).groupBy("key", "block")
    right = above.withColumn("block", F.col("at")).groupBy("key", "block")
    return left.cogroup(right).applyInArrow(run, schema)


def descended(levels: list[DataFrame], top: DataFrame, height: int) -> DataFrame:
    """The witnesses of the lowest level; top: those of the keys' roots, as for witnessed."""
    for nodes in levels[-2::-1]:
        top = witnessed(nodes, top, height)
        if nodes is not levels[0]:
            top = stored(top.drop("digest", "total"))
    return top


def manifest(documents: DataFrame, keep: Sequence[str] = (), fields: Sequence[str] = FIELDS, id_col: str = "doc_id", source_col: str = "source", height: int = HEIGHT) -> DataFrame:
    """(doc_id, source, leaf, subroot, root: hex, siblings, shape: binary) and the columns `keep` for each row.

    A source's leaves go by id (null first), rows of one id by their leaf; equal rows are leaves of their
    own. Sources go by their bytes, null first; a null source is one of its own. A source of one leaf has
    that leaf for its subroot, and a table of one source the subroot for its root. Texts of any length are
    only hashed. An empty table has no root and gives an empty result. Other columns are ignored, whatever
    their names; those in `keep` must not be named as columns above or key, at, total, digest.
    """
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit(""))  # in the order of sources, null first
    leaf = leaf_of(*[F.col(c) for c in fields])
    leaves = stored(lean(documents).select(key.alias("key"), F.col(id_col).alias("doc_id"), F.unhex(leaf).alias("digest"), *keep))
    rows = climbed(placed(leaves, ("doc_id", "digest")), height)
    subroots = rows[-1].select(F.lit("").alias("key"), F.col("key").alias("name"), "digest")
    sources = climbed(placed(subroots, ("name",)), height)
    # the one root, then the sources' witnesses up to it
    top = sources[-1].select("key", "at", F.lit(b"").alias("siblings"), F.lit(b"").alias("shape"), F.col("digest").alias("root"))
    tops = descended(sources, top, height) if len(sources) > 1 else sources[0].join(top, ["key", "at"])
    tops = stored(tops.select(F.col("name").alias("key"), F.lit(0).cast("long").alias("at"), "siblings", "shape", "root", F.col("digest").alias("subroot")))
    out = descended(rows, tops, height) if len(rows) > 1 else rows[0].join(tops, ["key", "at"])
    source = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).cast(documents.schema[source_col].dataType)
    told = [F.lower(F.hex(c)).alias(name) for c, name in (("digest", "leaf"), ("subroot", "subroot"), ("root", "root"))]
    return out.select("doc_id", source.alias("source"), *told, "siblings", "shape", *keep)
