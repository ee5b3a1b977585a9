"""Rows of JSON decoded by the kinds of their values; a row with a fault is set apart with its reason, and the others go on.

Nothing is turned into what it isn't: a truth value is no number, a number no text, a text no number, and a time must
carry its offset. A field that isn't declared is a fault too.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Field(NamedTuple):
    """kind: text, whole, number, truth, day, time, texts or any (kept as its JSON). needed: neither missing nor null."""

    kind: str
    needed: bool = True


#: The SQL type of a kind, and what is said of a value that isn't one.
TYPES = {
    "text": ("string", "no text"), "whole": ("long", "no whole number"), "number": ("double", "no number"), "truth": ("boolean", "no truth value"), "day": ("date", "no day"), "time": ("timestamp", "no time with an offset"),
    "texts": ("array<string>", "no list of texts"), "any": ("string", ""),
}
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})$"


def _value(row: Column, name: str, kind: str) -> Column:
    """The value, null if it isn't of its kind."""
    at = f"$.{name}"
    if kind == "any":
        return F.to_json(F.try_variant_get(row, at, "variant"))
    if kind == "texts":
        return F.try_variant_get(row, at, "array<string>")
    if kind in ("day", "time"):
        said = F.try_variant_get(row, at, "string")
        return F.when(said.rlike(DAY if kind == "day" else TIME), said.try_cast(TYPES[kind][0]))
    return F.try_variant_get(row, at, TYPES[kind][0])


def _fits(kind: str, told: Column, value: Column) -> Column:
    """Whether a JSON kind, as schema_of_variant tells it, is that of a field."""
    whole = told.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | told.rlike(r"^DECIMAL\([0-9]+,0\)$")
    return {
        "text": told == "STRING", "whole": whole & value.isNotNull(), "number": whole | told.startswith("DECIMAL(") | told.isin("DOUBLE", "FLOAT"), "truth": told == "BOOLEAN", "day": (told == "STRING") & value.isNotNull(),
        "time": (told == "STRING") & value.isNotNull(), "texts": told.isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists(F.coalesce(value, F.array(F.lit(None).cast("string"))), lambda x: x.isNull()) if kind == "texts" else None, "any": F.lit(True),
    }[kind]


def decoded(rows: DataFrame, payload: str, fields: dict[str, Field]) -> DataFrame:
    """The rows with one column for each field, and ``fault``: the first reason for which a row can't be taken, null if it can.

    In the order: no JSON object, a field that isn't declared, then the fields as declared. With a fault all fields are null.
    Columns of a field's name are replaced.
    """
    out = rows.withColumn("_row", F.try_parse_json(payload))
    names = F.map_keys(F.from_json(F.when(F.schema_of_variant("_row").startswith("OBJECT"), F.col(payload)), "map<string,string>"))
    other = F.array_sort(F.array_except(names, F.array(*map(F.lit, fields))))
    fault = F.when(F.coalesce(~F.schema_of_variant("_row").startswith("OBJECT"), F.lit(True)), "no JSON object").when(F.size(other) > 0, F.concat(F.get(other, F.lit(0)), F.lit(" is unknown")))
    for name, field in fields.items():
        told, value = F.schema_of_variant(F.try_variant_get("_row", f"$.{name}", "variant")), _value(F.col("_row"), name, field.kind)
        empty = told.isNull() | (told == "VOID")
        if field.needed:
            fault = fault.when(told.isNull(), f"{name} is missing").when(told == "VOID", f"{name} is null")
        fault = fault.when(~empty & ~_fits(field.kind, told, value), f"{name} is {TYPES[field.kind][1]}")
    out = out.withColumn("_fault", fault)
    kept = [F.col(c) for c in rows.columns if c not in fields and c != "fault"]
    return out.select(*kept, *[F.when(F.col("_fault").isNull(), _value(F.col("_row"), n, f.kind)).alias(n) for n, f in fields.items()], F.col("_fault").alias("fault"))


def quarantined(rows: DataFrame, payload: str, fields: dict[str, Field]) -> tuple[DataFrame, DataFrame]:
    """(rows that were decoded, the others as they came with their ``fault``)."""
    told = decoded(rows.withColumn("_came", F.col(payload)), payload, fields)
    good = told.where("fault is null").drop("fault", "_came")
    return good, told.where("fault is not null").select(*[c for c in rows.columns if c not in fields and c != payload], F.col("_came").alias(payload), "fault")
