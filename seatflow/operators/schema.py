"""The whole answer of a model: every key must be there and of its kind, or the answer fails.

Values may be null. Texts are trimmed and blank ones null, whatever their length. Enumerated values are
upper-cased, and one that isn't known is null. Lists hold texts, at most MOST_ITEMS of MOST_CHARS;
blank ones go. Pairs hold a known value and the evidence for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatflow.vocab import DEPARTMENT, EMPLOYMENT, GATE, JOB_KIND, POSITION, QUALIFICATION, REGION

# The keys of an answer by their kind, and the caps on lists.
GATES = {"is_church_recruitment": (GATE, "UNCERTAIN")}
ENUMS = {"job_kind": JOB_KIND, "department": DEPARTMENT, "employment_type": EMPLOYMENT, "qualification": QUALIFICATION, "region": REGION}
PAIRS = {"position": POSITION}
BOOLS = ["housing_provided"]
LISTS = ["requirements", "preferred", "required_docs", "optional_docs", "process_steps"]
TEXTS = [
    "role", "headcount", "start_timing", "housing_note", "pay_amount", "pay_note", "benefit_note", "work_days", "description", "deadline", "church_name", "city", "address", "raw_denomination",
    "contact_email", "contact_tel", "contact_link", "contact_post", "department_evidence", "employment_type_evidence", "qualification_evidence", "region_evidence",
]
MOST_ITEMS, MOST_CHARS = 20, 300
KEYS = [*GATES, *ENUMS, *PAIRS, *BOOLS, *LISTS, *TEXTS]
#: What a key's value is read as, and an answer's values as they are in JSON: a missing key is null there, a JSON null isn't.
TYPES = dict.fromkeys(KEYS, "string") | dict.fromkeys(PAIRS, "array<struct<value:string,evidence:string>>") | dict.fromkeys(BOOLS, "boolean") | dict.fromkeys(LISTS, "array<string>")
SHAPE = f"struct<{', '.join(f'{key}: variant' for key in KEYS)}>"


def _values(payload: Column) -> Column:
    """Of SHAPE, null if the payload is no JSON object."""
    return F.try_variant_get(F.try_parse_json(payload), "$", SHAPE)


def _typed(values: Column) -> dict[str, Column]:
    """Each key's value as its type, null if it is none."""
    return {key: F.try_variant_get(values[key], "$", kind) for key, kind in TYPES.items()}


def _bare(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def _member(text: Column, names: list[str], unknown: str | None = None) -> Column:
    up = F.upper(text)
    return F.when(up.isin(names), up).otherwise(F.lit(unknown))


def _fault(values: Column, typed: dict[str, Column]) -> Column:
    """The first reason for which an answer fails, null if it is good."""
    out = F.when(values.isNull(), "no JSON object")
    for key in KEYS:
        said, kind = ~F.is_variant_null(values[key]), F.schema_of_variant(values[key])
        out = out.when(values[key].isNull(), f"{key} is missing")
        if key in BOOLS:
            out = out.when(said & (kind != "BOOLEAN"), f"{key} is no truth value")
        elif key in LISTS:
            kept = F.filter(typed[key], lambda x: F.trim(x) != "")
            out = out.when(said & (~kind.isin("ARRAY<STRING>", "ARRAY<VOID>") | F.exists(typed[key], lambda x: x.isNull())), f"{key} is no list of texts")
            out = out.when(F.size(kept) > MOST_ITEMS, f"{key} has too many items").when(F.exists(kept, lambda x: F.length(F.trim(x)) > MOST_CHARS), f"{key} has an item that is too long")
        elif key in PAIRS:
            named = F.coalesce(F.forall(typed[key], lambda x: x["value"].isNotNull()), F.lit(True))
            out = out.when(said & ~(kind.startswith("ARRAY<OBJECT<") | (kind == "ARRAY<VOID>")) | ~named, f"{key} is no list of values with evidence")
        else:
            out = out.when(said & (kind != "STRING"), f"{key} is no text")
    return out


def _columns(fault: Column, typed: dict[str, Column]) -> dict[str, Column]:
    """The columns of parsed."""
    out: dict[str, Column] = {"fault": fault}

    def put(name: str, value: Column) -> None:
        out[name] = F.when(fault.isNull(), value)

    for key, (names, unknown) in GATES.items():
        put(key, _member(_bare(typed[key]), names, unknown))
    for key, names in ENUMS.items():
        put(key, _member(_bare(typed[key]), names))
    for key, names in PAIRS.items():
        known = F.filter(F.coalesce(typed[key], F.array().cast(TYPES[key])), lambda x: F.upper(F.trim(x["value"])).isin(names))  # noqa: B023  called at once
        put(key, F.transform(known, lambda x: F.upper(F.trim(x["value"]))))
        put(f"{key}_items", F.transform(known, lambda x: F.trim(F.coalesce(x["evidence"], F.lit("")))))
    for key in BOOLS:
        put(key, typed[key])
    for key in LISTS:
        put(key, F.filter(F.transform(F.coalesce(typed[key], F.array().cast(TYPES[key])), lambda x: F.trim(x)), lambda x: x != ""))
    for key in TEXTS:
        put(key, _bare(typed[key]))
    return out


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), where value is computed once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def parsed(payload: Column) -> dict[str, Column]:
    """Columns by key, and ``fault``; where there is a fault the others are null. Pairs become <key> and <key>_items: values and their evidence, by position.

    Each column is a field of one expression that parses the payload once; a table is read by answered, faster.
    """
    told = _once(_values(payload), lambda v: _once(_fault(v, _typed(v)), lambda bad: F.struct(*[c.alias(n) for n, c in _columns(bad, _typed(v)).items()])))
    return {name: told[name] for name in ["fault", *[n for key in KEYS for n in ([key, f"{key}_items"] if key in PAIRS else [key])]]}


def answered(rows: DataFrame, payload: str) -> DataFrame:
    """The rows with the columns of parsed in the payload's place. Columns of those names are replaced.

    Values, their types and the fault are columns of their own before they are used, so a payload is parsed once. Values are the one
    element of a generator's array, since Spark would put their expression in the place of each use where a later filter is on a column.
    """
    typed = {key: F.col(f"_typed_{key}") for key in KEYS}
    out = rows.withColumn("_values", F.explode(F.array(_values(F.col(payload)))))
    out = out.withColumns({f"_typed_{key}": c for key, c in _typed(F.col("_values")).items()})
    out = out.withColumn("_fault", _fault(F.col("_values"), typed))
    told = _columns(F.col("_fault"), typed)
    return out.select(*[F.col(c) for c in rows.columns if c != payload and c not in told], *[c.alias(n) for n, c in told.items()])
