"""Model answers: parsed strictly from JSON, and the prompt's label lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a form's value says when the value is elsewhere, and labels that aren't told to the model.
POINTERS = ["-", "--", ".", "..", "0", "0명", "없음", "해당없음", "아래", "아래참조", "아래참고", "본문참조", "본문참고", "하단참조", "상기참조"]
NOISE = ["views", "display_no", "has_attachment", "thumbnail", "list_title", "list_date", "board"]


def parsed(payload: Column, required: dict[str, str]) -> Column:
    """struct<value map, error>: every required key must be there with its JSON type; anything else fails the whole answer."""
    good = F.try_parse_json(payload)
    error = F.when(good.isNull(), "not JSON")
    value = []
    for key, kind in required.items():
        at = F.try_variant_get(good, f"$.{key}", "string")
        typed = {"int": at.rlike(r"^-?\d+$"), "string": at.isNotNull()}[kind]
        error = error.when(at.isNull(), F.lit(f"{key} is missing")).when(~typed, F.lit(f"{key} is no {kind}"))
        value += [F.lit(key), at]
    return F.struct(F.create_map(*value).alias("value"), error.alias("error"))


def enumerated(c: Column, names: list[str]) -> Column:
    """Upper-cased; an unknown value is null."""
    up = F.upper(F.trim(c))
    return F.when(up.isin(names), up)


def meta_lines(meta: Column, labels: dict[str, str]) -> Column:
    """array of 'label: value' in key order, without noise, blanks and values that only point elsewhere."""
    kept = F.map_filter(meta, lambda k, v: ~k.isin(NOISE) & ~k.startswith("_") & F.coalesce(F.trim(v) != "", F.lit(False)) & ~F.regexp_replace(v, r"(?U)\s", "").isin(POINTERS))
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    lines = F.transform(F.map_entries(kept), lambda e: F.concat(F.coalesce(F.try_element_at(names, e["key"]), e["key"]), F.lit(": "), F.trim(e["value"])))
    return F.array_sort(lines)
