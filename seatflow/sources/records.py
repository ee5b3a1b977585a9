"""Reading records by declared schemas: JSON files with quarantine, and rules on board configurations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as t

from seatflow.vocab import REGION

SOURCE_ROW = t.StructType([
    t.StructField("id", t.StringType()), t.StructField("source_key", t.StringType()), t.StructField("external_id", t.StringType()), t.StructField("source_url", t.StringType()),
    t.StructField("title", t.StringType()), t.StructField("posted_on", t.DateType()), t.StructField("raw_text", t.StringType()), t.StructField("raw_html", t.StringType()),
    t.StructField("image_urls", t.ArrayType(t.StringType())), t.StructField("attachments", t.ArrayType(t.StructType([t.StructField("name", t.StringType()), t.StructField("url", t.StringType())]))),
    t.StructField("raw_meta", t.MapType(t.StringType(), t.StringType())), t.StructField("run_id", t.StringType()), t.StructField("fetched_at", t.TimestampType()),
    t.StructField("structured_at", t.TimestampType()), t.StructField("structure_attempts", t.IntegerType()), t.StructField("structure_error", t.StringType()),
])
BOARD = t.StructType([
    *[t.StructField(n, t.StringType()) for n in ("key", "board_name", "denomination_hint", "fetch_tier", "encoding", "list_url", "detail_pattern", "fetch_note", "disabled_reason")],
    t.StructField("enabled", t.BooleanType()), t.StructField("list_has_dates", t.BooleanType()), t.StructField("list_page_limit", t.IntegerType()),
])


def require_columns(frame: DataFrame, schema: t.StructType) -> DataFrame:
    """The frame in the schema's order; a missing or an extra column is an error."""
    have, want = set(frame.columns), set(schema.names)
    if have != want:
        raise ValueError(f"missing {sorted(want - have)}, unknown {sorted(have - want)}")
    return frame.select(*schema.names)


def json_records(spark: SparkSession, path: str, schema: t.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, corrupt lines) of a file with one record a line."""
    full = t.StructType([*schema.fields, t.StructField("_corrupt", t.StringType())])
    lines = spark.read.text(path).where("trim(value) <> ''")
    rows = lines.select("value", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    return rows.where("r._corrupt is null").select("r.*").drop("_corrupt"), rows.where("r._corrupt is not null").select(F.col("value").alias("line"))


def listed_records(spark: SparkSession, path: str, list_key: str, schema: t.StructType, required: list[str], version: int | None = None) -> DataFrame:
    """The records of a file of one JSON object that holds them as a list: the schema's fields and ``faults``.

    Nothing is left out in silence: a field that the schema doesn't know, or a required one that is missing,
    is a fault of its record; an unknown field of the object, another version, or no list is one row of faults alone.
    """
    top = spark.read.text(path, wholetext=True).select("value", F.from_json("value", "map<string,string>").alias("top"))
    allowed = [list_key] + (["version"] if version is not None else [])
    entries = F.from_json(F.try_element_at("top", F.lit(list_key)), "array<string>")
    wrong = F.array(
        F.when(F.col("top").isNull(), "no JSON object"), F.when(F.size(F.array_except(F.map_keys("top"), F.array(*map(F.lit, allowed)))) > 0, "unknown field"),
        F.when(F.coalesce(F.size(entries), F.lit(0)) < 1, "no records"), *([] if version is None else [F.when(~F.coalesce(F.try_element_at("top", F.lit("version")) == str(version), F.lit(False)), "another version")]),
    )
    told = top.select(entries.alias("entries"), F.filter(wrong, lambda x: x.isNotNull()).alias("wrong"))
    rows = told.where(F.size("wrong") == 0).select(F.explode("entries").alias("row"))
    keys = F.map_keys(F.from_json("row", "map<string,string>"))
    names = lambda xs: F.array(*map(F.lit, xs)) if xs else F.array().cast("array<string>")
    faults = F.concat(
        F.transform(F.array_except(keys, names(schema.names)), lambda k: F.concat(F.lit("unknown "), k)), F.transform(F.array_except(names(required), keys), lambda k: F.concat(F.lit("missing "), k)))
    good = rows.select(F.from_json("row", schema).alias("r"), F.coalesce(faults, F.array(F.lit("no JSON object"))).alias("faults")).select("r.*", "faults")
    alone = told.where(F.size("wrong") > 0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], F.col("wrong").alias("faults"))
    return good.unionByName(alone)


def with_faults(records: DataFrame, rules: dict[str, Column], unique: str | None = None) -> DataFrame:
    """Adds the names of broken rules to ``faults``, and ``not unique`` to all records that share a key."""
    more = F.filter(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())
    out = records.withColumn("faults", F.concat("faults", more))
    if unique:
        several = F.count("*").over(Window.partitionBy(unique)) > 1
        out = out.withColumn("faults", F.when(several & F.col(unique).isNotNull(), F.array_append("faults", F.lit("not unique"))).otherwise(F.col("faults")))
    return out


def refused(records: DataFrame) -> DataFrame:
    """The records without ``faults``; reading any that has one is an error that names it."""
    first = records.columns[0]
    said = F.concat_ws(", ", F.lit("faulty record"), F.col(first).cast("string"), "faults")
    return records.withColumn(first, F.when(F.size("faults") > 0, F.raise_error(said).cast(records.schema[first].dataType)).otherwise(F.col(first))).drop("faults")


def flag_rules() -> dict[str, Column]:
    """Flags that contradict the address of the list; without flags the address is secure."""
    url, http = F.col("list_url"), F.coalesce(F.col("flags.http_only"), F.lit(False))
    return {
        "flags against scheme": F.when(http, url.startswith("http://")).otherwise(url.startswith("https://")),
        "flags against host": ~F.coalesce(F.col("flags.www_required"), F.lit(False)) | url.rlike("^https?://www[.]"),
    }


def enabled(boards: DataFrame) -> DataFrame:
    return boards.where("enabled")


def by_key(boards: DataFrame, key: str) -> DataFrame:
    """The board of a key, however it is capitalised."""
    return boards.where(F.col("key") == key.strip().upper())


#: A restricted list: names, their other names, who ruled on them, and where they are.
LISTED = t.StructType([t.StructField("name", t.StringType()), t.StructField("aliases", t.ArrayType(t.StringType())), t.StructField("ruled_by", t.ArrayType(t.StringType())), t.StructField("region", t.StringType())])
LISTED_VERSION = 2


def restricted_list(spark: SparkSession, path: str) -> DataFrame:
    """The restricted list of version LISTED_VERSION, with ``faults``: each has a name and a known region or none."""
    rows = listed_records(spark, path, "entries", LISTED, ["name"], LISTED_VERSION)
    whole = F.array_contains("faults", "no records") | F.array_contains("faults", "another version") | F.array_contains("faults", "unknown field") | F.array_contains("faults", "no JSON object")
    return with_faults(rows, {"blank name": whole | (F.trim("name") != ""), "unknown region": F.col("region").isNull() | F.col("region").isin(REGION)})


def board_rules() -> dict[str, Column]:
    c = F.col
    return {
        "key": c("key").rlike("^[A-Z][A-Z0-9_]*$"), "tier": c("fetch_tier").isin("static", "json", "browser"), "encoding": c("encoding").isin("utf-8", "euc-kr"),
        "list_url": c("list_url").rlike("^https?://[^@/]+/"), "detail_pattern": F.coalesce(F.length("detail_pattern") - F.length(F.replace(c("detail_pattern"), F.lit("{id}"), F.lit(""))) == 4, F.lit(True)),
        "disabled": c("enabled") | F.coalesce(F.trim("disabled_reason") != "", F.lit(False)), "page_limit": F.coalesce(c("list_page_limit") > 0, F.lit(True)),
    }


def detail_url(pattern: Column, list_url: Column, external_id: Column) -> Column:
    """The template's address, on the list's host."""
    origin = F.regexp_extract(list_url, r"^(https?://[^/]+)", 1)
    return F.concat(F.when(pattern.startswith("/"), origin).otherwise(F.lit("")), F.replace(pattern, F.lit("{id}"), external_id))
