"""Snapshots without MERGE: keyed, conditional upserts as joins, and versioned folders with a pointer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Reasons under which a rejected draft may still be replaced.
REPLACEABLE = ["DUPLICATE", "HERESY", "CLOSED"]


def safe_to_replace(touched: Column, status: Column, link: Column, reason: Column) -> Column:
    return F.when(touched, False).when(status == "PENDING", True).when(status == "APPROVED", link.isNull()).otherwise(F.coalesce(reason.isin(REPLACEABLE), F.lit(False)))


def upserted(old: DataFrame, new: DataFrame, key: str, carried: list[str], replaceable: Column) -> DataFrame:
    """The next snapshot and ``outcome``: inserted, replaced, skipped or kept.

    An existing row is replaced only if `replaceable` (over the old columns) holds, and then keeps its
    carried columns. old and new have the same columns.
    """
    o = old.withColumn("_can", replaceable).select(F.struct(*old.columns).alias("o"), F.col(key).alias("_ok"), "_can")
    n = new.select(F.struct(*old.columns).alias("n"), F.col(key).alias("_nk"))
    both = o.join(n, F.col("_ok") == F.col("_nk"), "full_outer")
    outcome = F.when(F.col("o").isNull(), "inserted").when(F.col("n").isNull(), "kept").when(F.col("_can"), "replaced").otherwise("skipped")
    both = both.withColumn("outcome", outcome)
    pick = lambda c: F.when(F.col("outcome") == "inserted", F.col(f"n.{c}")).when((F.col("outcome") == "replaced") & F.lit(c not in carried), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    return both.select(*[pick(c).alias(c) for c in old.columns], "outcome")


def with_updates(rows: DataFrame, updates: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the updates' columns and ``changed``, updates whose key is unknown). Only real differences count as changes."""
    columns = [c for c in updates.columns if c != key]
    u = updates.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    out = rows.join(u, rows[key] == u["_key"], "left")
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = out.withColumn("changed", F.col("_key").isNotNull() & differs)
    out = out.withColumns({c: F.when(F.col("_key").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)) for c in columns})
    return out.drop("_key", *[f"_{c}" for c in columns]), updates.join(rows.select(key), key, "left_anti")


def state_updated(rows: DataFrame, updates: DataFrame) -> DataFrame:
    """updates(id, structured_at, structure_attempts, structure_error) on rows: evidence stays, a verdict is never
    taken back and attempts never fall. ``refused`` says which rule an update broke; its row stays as it was."""
    names = ["structured_at", "structure_attempts", "structure_error"]
    u = updates.select(F.col("id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in names])
    out = rows.join(u, rows["id"] == u["_id"], "left")
    refused = F.when(F.col("_id").isNull(), None).when(F.col("structured_at").isNotNull() & F.col("_structured_at").isNull(), "the verdict would be lost").when(F.col("_structure_attempts") < F.col("structure_attempts"), "attempts would fall")
    out = out.withColumn("refused", refused.cast("string"))
    take = F.col("_id").isNotNull() & F.col("refused").isNull()
    return out.withColumns({c: F.when(take, F.col(f"_{c}")).otherwise(F.col(c)) for c in names}).drop("_id", *[f"_{c}" for c in names])


def attempted(attempts: Column, error: Column, at: Column) -> Column:
    """struct of the next state: success sets the time and clears the error; either way one attempt more."""
    return F.struct(F.when(error.isNull(), at).alias("structured_at"), (attempts + 1).alias("structure_attempts"), error.alias("structure_error"))


def linked(drafts: DataFrame, wanted: DataFrame, taken_back: DataFrame) -> DataFrame:
    """wanted(id, job_id) sets a link only where there is none; taken_back(id, job_id) clears one only if it is still that job's."""
    w = wanted.select(F.col("id").alias("_w"), F.col("job_id").alias("_new"))
    b = taken_back.select(F.col("id").alias("_b"), F.col("job_id").alias("_old"))
    out = drafts.join(w, drafts["id"] == w["_w"], "left").join(b, drafts["id"] == b["_b"], "left")
    link = F.col("published_job_id")
    return out.withColumn("published_job_id", F.when(link.isNull(), F.col("_new")).when(link.eqNullSafe(F.col("_old")), None).otherwise(link)).drop("_w", "_new", "_b", "_old")


def preview(rows: DataFrame, volatile: list[str]) -> DataFrame:
    """Without what changes from run to run, columns by name and rows in order, for a diff."""
    kept = sorted(c for c in rows.columns if c not in volatile)
    return rows.select(*kept).orderBy(*kept)


def compared(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """(key, field, left_value, right_value) for each differing field of shared keys, and rows that only one side has."""
    fields = [c for c in one.columns if c != key]
    pairs = lambda p: F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"{p}.{c}").cast("string").alias("v")) for c in fields])
    both = one.alias("a").join(other.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    both = both.withColumns({"_a": F.col(f"a.{key}").isNotNull(), "_b": F.col(f"b.{key}").isNotNull()})
    met = both.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), "_a", "_b", F.explode(F.arrays_zip(pairs("a").alias("l"), pairs("b").alias("r"))).alias("x"))
    out = met.select(key, F.col("x.l.field").alias("field"), F.col("x.l.v").alias("left_value"), F.col("x.r.v").alias("right_value"), "_a", "_b")
    return out.where(F.col("_a") & F.col("_b") & ~F.col("left_value").eqNullSafe(F.col("right_value")) | ((F.col("_a") != F.col("_b")) & (F.col("field") == fields[0]))).drop("_a", "_b")


class Snapshots:
    """A table as folders v=0, v=1, …, and a CURRENT table that names the one to read. Writers are one at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def version(self) -> int | None:
        fs = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/CURRENT").getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/CURRENT")):
            return None
        return self.spark.read.schema("v long").json(f"{self.path}/CURRENT").agg(F.max("v")).first()[0]

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v={self.version()}")

    def write(self, frame: DataFrame) -> int:
        """A whole new version first; the pointer moves only once it is complete."""
        v = (self.version() if self.version() is not None else -1) + 1
        frame.write.parquet(f"{self.path}/v={v}")
        self.spark.range(1).select(F.lit(v).cast("long").alias("v")).coalesce(1).write.mode("append").json(f"{self.path}/CURRENT")
        return v


class Release:
    """Several tables that change together: PATH/<name>/v=N, and one manifest, PATH/RELEASES, whose last row names the version of each.

    A pass checks all schemas, writes all new versions, and then adds one row to the manifest. Readers go by the manifest, so until
    that row is there they see the old tables, all of them; whatever stops a pass before leaves versions that nobody reads.
    Writers are one at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schemas: dict[str, str]):
        self.spark, self.path, self.schemas = spark, path.rstrip("/"), schemas

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def versions(self) -> dict[str, int]:
        """Of the last release; empty before the first."""
        if not self._exists(f"{self.path}/RELEASES"):
            return {}
        rows = self.spark.read.schema("release long, tables map<string,long>").json(f"{self.path}/RELEASES")
        last = rows.agg(F.max_by(F.struct("release", "tables"), "release").alias("last")).first()["last"]
        return {} if last is None else {**last["tables"], "": last["release"]}

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}/v={self.versions()[name]}")

    def faults(self, tables: dict[str, DataFrame]) -> list[str]:
        """What keeps these tables from going out: unknown names, and columns that are missing, unknown or of another type."""
        out = [f"{name} is no table of this release" for name in tables if name not in self.schemas]
        for name in set(tables) & set(self.schemas):
            wanted = {f.name: f.dataType for f in StructType.fromDDL(self.schemas[name]).fields}
            given = {f.name: f.dataType for f in tables[name].schema.fields}
            out += [f"{name}.{c} is missing" for c in wanted.keys() - given.keys()] + [f"{name}.{c} is unknown" for c in given.keys() - wanted.keys()]
            out += [f"{name}.{c} is {given[c].simpleString()}, not {wanted[c].simpleString()}" for c in wanted.keys() & given.keys() if wanted[c] != given[c]]
        return sorted(out)

    def write(self, tables: dict[str, DataFrame]) -> int:
        """All of these tables or none; tables that aren't named stay at their version. Returns the release's number."""
        if faults := self.faults(tables):
            raise ValueError("; ".join(faults))
        held = self.versions()
        release = held.pop("", -1) + 1
        for name, frame in tables.items():
            # a folder that a stopped pass left is written anew
            frame.select(*[f.name for f in StructType.fromDDL(self.schemas[name]).fields]).write.mode("overwrite").parquet(f"{self.path}/{name}/v={release}")
            held[name] = release
        row = self.spark.range(1).select(F.lit(release).cast("long").alias("release"), F.create_map(*[x for k, v in held.items() for x in (F.lit(k), F.lit(v).cast("long"))]).alias("tables"))
        row.coalesce(1).write.mode("append").json(f"{self.path}/RELEASES")
        return release
