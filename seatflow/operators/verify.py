"""An answer held against its posting, field by field: one table says how each field is tested.

A value that the posting doesn't bear out is emptied and told with its evidence; where media were sent
nothing is emptied, only counted, as text in an image can't be looked up. Fields that a model is asked to put together from several
places are counted only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatflow.functions.text import squeeze
from seatflow.operators import checks

#: (field, test). evidence: its own column <field>_evidence; each: <field>_items by position; source: the column that it was derived from.
TESTS = [
    ("church_name", "text"), ("raw_denomination", "text"), ("city", "text"), ("address", "text"), ("contact_email", "mail"), ("contact_tel", "digits"), ("contact_link", "link"),
    ("position", "each"), ("department", "evidence"), ("employment_type", "evidence"), ("qualification", "evidence"), ("region", "evidence"), ("pay_amount", "source"), ("deadline_text", "source"), ("housing_provided", "told"),
]
#: What goes with a field that is emptied; a source stays itself and takes what was derived from it along.
ALONG = {"pay_amount": ["pay_min", "pay_max", "pay_period"], "deadline_text": ["deadline"], "housing_provided": ["housing_note"]}
COUNTED = ["role", "start_timing", "work_days", "headcount", "pay_note", "benefit_note", "contact_post", "housing_note"]
COUNTED_ITEMS = ["requirements", "preferred", "required_docs", "optional_docs", "process_steps"]
# Words that tell of housing.
HOUSING = ["사택", "숙소", "아파트", "거주"]

#: Between the parts of a posting; no value holds it.
BOUNDARY = "\x00"
DROPPED = "array<struct<field:string,value:string,evidence:string>>"


def verified(answers: DataFrame, parts: Column, title: Column, media_sent: Column) -> DataFrame:
    """The answers with emptied fields, and ``dropped`` (field, value, evidence), ``unverifiable`` (values kept only since media were sent)
    and ``unchecked`` (counts by field of values that are put together and stand nowhere as they are).

    parts: the posting's parts without white space, as checks.haystack makes them. Of a list of positions each is judged by its
    own evidence and goes alone. Null values are never at fault, nor is a derived value without a source. Housing counts as told if the posting
    speaks of it; only a yes is doubted.
    """
    out = answers.withColumns({"_parts": parts, "_title": title, "_free": ~F.coalesce(media_sent, F.lit(False))})
    out = out.withColumn("_whole", F.array_join("_parts", BOUNDARY))
    # a number must lie in one part: digits alone would run on from one part to the next
    out = out.withColumns({"_signs": checks.signs(F.col("_whole")), "_digits": F.transform("_parts", checks.source_digits), "_numbers": checks.phone_numbers(F.col("contact_tel"))})
    whole, frees, title = F.col("_whole"), F.col("_free"), F.col("_title")
    stands = lambda v: F.coalesce((squeeze(v) != "") & F.contains(whole, squeeze(v)), F.lit(False))
    signed = lambda v: F.coalesce(F.contains(F.col("_signs"), v), F.lit(False))
    told = lambda name, value, evidence: F.struct(F.lit(name).alias("field"), value.cast("string").alias("value"), evidence.cast("string").alias("evidence"))
    none = F.lit(None).cast("string")
    mails = lambda v: (F.size(checks.mail_signs(v)) > 0) & F.forall(checks.mail_signs(v), signed)
    numbers = F.coalesce((F.size("_numbers") > 0) & F.forall("_numbers", lambda n: F.exists("_digits", lambda p: F.contains(p, n))), F.lit(False))
    bad, lists = {}, []
    for field, test in TESTS:
        c = F.col(field)
        if test == "each":
            pairs = F.zip_with(F.coalesce(c, F.array().cast("array<string>")), F.coalesce(F.col(f"{field}_items"), F.array().cast("array<string>")), lambda v, e: F.struct(v.alias("v"), e.alias("e")))
            pairs = F.filter(pairs, lambda p: p["v"].isNotNull())
            good = lambda p: stands(p["e"]) & checks.supports(p["v"], p["e"], title)
            out = out.withColumn(f"_{field}", F.transform(pairs, lambda p: F.struct(p["v"].alias("v"), p["e"].alias("e"), good(p).alias("ok"))))
            lists.append(F.transform(F.filter(f"_{field}", lambda p: ~p["ok"]), lambda p: told(field, p["v"], p["e"])))  # noqa: B023  called at once
            continue
        evidence = F.col(f"{field}_evidence") if test == "evidence" else none
        ok = {
            "text": stands(c), "mail": mails(c), "digits": numbers, "link": signed(checks.link_signs(c)), "source": stands(c),
            "told": ~F.coalesce(c.cast("string") == "true", F.lit(False)) | F.greatest(*[F.contains(whole, F.lit(w)) for w in HOUSING]),
            "evidence": (stands(evidence) & checks.supports(c, evidence, title)) if test == "evidence" else None,
        }[test]
        bad[field] = c.isNotNull() & ~ok
        lists.append(F.when(bad[field], F.array(told(field, c, evidence))).otherwise(F.array().cast(DROPPED)))
    out = out.withColumn("_doubted", F.concat(*lists))
    # what is counted only; a note that goes with its field isn't counted too
    counts = [(f, F.when(F.col(f).isNotNull() & ~stands(F.col(f)), 1).otherwise(0)) for f in COUNTED]
    counts = [(f, F.when(frees & bad["housing_provided"], 0).otherwise(n) if f == "housing_note" else n) for f, n in counts]
    counts += [(f, F.coalesce(F.size(F.filter(f, lambda x: ~stands(x))), F.lit(0))) for f in COUNTED_ITEMS]
    unchecked = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(f).alias("f"), n.cast("int").alias("n")) for f, n in counts]), lambda x: x["n"] > 0))
    out = out.withColumns({
        "_gone": F.when(frees, F.transform("_doubted", lambda d: d["field"])).otherwise(F.array().cast("array<string>")), "dropped": F.when(frees, F.col("_doubted")).otherwise(F.array().cast(DROPPED)),
        "unverifiable": F.when(frees, 0).otherwise(F.size("_doubted")), "unchecked": unchecked,
    })
    gone = lambda field: F.array_contains("_gone", field)
    new: dict[str, Column] = {}
    for field, test in TESTS:
        if test == "each":
            kept = F.filter(f"_{field}", lambda p: p["ok"] | ~frees)
            new[field], new[f"{field}_items"] = F.transform(kept, lambda p: p["v"]), F.transform(kept, lambda p: p["e"])
        elif test != "source":
            new[field] = F.when(~gone(field), F.col(field))
        for other in ALONG.get(field, []):
            new[other] = F.when(~gone(field), F.col(other))
    return out.withColumns(new).select(*answers.columns, "dropped", "unverifiable", "unchecked")


def tally(checked: DataFrame) -> DataFrame:
    """(field, outcome, n): how many values of each field were dropped, and how many went unchecked."""
    dropped = checked.select(F.lit("dropped").alias("outcome"), F.explode("dropped.field").alias("field"), F.lit(1).alias("n"))
    counted = checked.select(F.lit("unchecked").alias("outcome"), F.explode("unchecked").alias("field", "n"))
    return dropped.unionByName(counted).groupBy("field", "outcome").agg(F.sum("n").alias("n"))
