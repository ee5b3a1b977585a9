"""From a model's answer to a draft: repair, checks against the source, confidence, screening, constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatflow.functions.text import name_key, squeeze

PROMOTION = ["church_name", "title", "job_kind", "position_or_role", "description", "contact"]
CONTACTS = ["contact_email", "contact_phone", "contact_link", "contact_post"]


def _filled(c: Column) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


# --- repair and grades -------------------------------------------------------------------


def repaired(answers: DataFrame) -> DataFrame:
    """The kind stays; positions and role are made to match it, and a pay range is put in order."""
    ministry, general = F.col("job_kind") == "MINISTRY", F.col("job_kind") == "GENERAL"
    none = F.array().cast("array<string>")
    positions = F.coalesce("positions", none)
    return answers.withColumns({
        "positions": F.when(ministry, F.when(F.size(positions) > 0, positions).otherwise(F.array(F.lit("ETC")))).otherwise(none),
        "role": F.when(general, F.when(_filled(F.col("role")), F.col("role")).otherwise(F.lit("기타"))),
        "pay_min": F.when(F.col("pay_min").isNotNull() & F.col("pay_max").isNotNull(), F.least("pay_min", "pay_max")).otherwise(F.col("pay_min")),
        "pay_max": F.when(F.col("pay_min").isNotNull() & F.col("pay_max").isNotNull(), F.greatest("pay_min", "pay_max")).otherwise(F.col("pay_max")),
    })


def gaps() -> Column:
    """What a draft lacks to go out by itself, in a fixed order."""
    said = {
        "church_name": _filled(F.col("church_name")), "title": _filled(F.col("title")), "job_kind": F.col("job_kind").isNotNull(),
        "position_or_role": (F.size(F.coalesce("positions", F.array())) > 0) | _filled(F.col("role")), "description": _filled(F.col("description")),
        "contact": F.greatest(*[_filled(F.col(c)) for c in CONTACTS]),
    }
    return F.filter(F.array(*[F.when(~said[name], F.lit(name)) for name in PROMOTION]), lambda x: x.isNotNull())


def graded(drafts: DataFrame) -> DataFrame:
    """Adds gaps, confidence and review_status. Expects media_sent, media_missed, can_compare, heresy_flag, reject_reason."""
    post_only = _filled(F.col("contact_post")) & ~F.greatest(*[_filled(F.col(c)) for c in CONTACTS if c != "contact_post"])
    low = (F.size("gaps") > 0) | (F.col("gate") != "YES") | F.col("media_missed") | ~F.col("can_compare")
    confidence = F.when(low, "low").when(F.col("media_sent") | post_only | F.col("heresy_flag"), "medium").otherwise("high")
    status = F.when(F.col("reject_reason").isNotNull(), "REJECTED").when(F.col("confidence") == "high", "APPROVED").otherwise("PENDING")
    return drafts.withColumn("gaps", gaps()).withColumn("confidence", confidence).withColumn("review_status", status)


# --- checks against the source -----------------------------------------------------------


def grounded(value: Column, sources: Column) -> Column:
    """Whether a value, without white space, stands in any of the sources; a blank one never does."""
    bare = squeeze(value)
    return F.coalesce((bare != "") & F.exists(sources, lambda s: F.contains(squeeze(s), bare)), F.lit(False))


def choices_grounded(chosen: Column, evidence: Column, sources: Column) -> Column:
    """The choices whose evidence, by position, stands in a source; a choice without evidence goes."""
    pairs = F.arrays_zip(chosen.alias("c"), evidence.alias("e"))
    return F.transform(F.filter(pairs, lambda p: p["c"].isNotNull() & grounded(p["e"], sources)), lambda p: p["c"])


def supported(value: Column, evidence: Column, words: dict[str, list[str]], against: dict[str, list[str]]) -> Column:
    """Whether the evidence has a word that speaks for the value and none that speaks against it; values without words are taken as they are."""
    out = F.lit(True)
    for name, good in words.items():
        bare = F.coalesce(squeeze(evidence), F.lit(""))
        yes = bare.rlike("|".join(good))
        bad = against.get(name)
        out = F.when(value == name, yes & ~bare.rlike("|".join(bad)) if bad else yes).otherwise(out)
    return out


def verified(answers: DataFrame, fields: list[str], sources: Column, media_sent: Column, tests: dict[str, Column] | None = None) -> DataFrame:
    """Ungrounded values are emptied and named in ``scrubbed``; where media were sent they stay and are named in ``unchecked``.

    A field is grounded if it stands in a source, or as its own test in `tests` says.
    """
    bad = {f: _filled(F.col(f)) & ~(tests[f] if tests and f in tests else grounded(F.col(f), sources)) for f in fields}
    names = F.filter(F.array(*[F.when(b, F.lit(f)) for f, b in bad.items()]), lambda x: x.isNotNull())
    none = F.array().cast("array<string>")
    out = answers.withColumn("_bad", names).withColumns({"scrubbed": F.when(media_sent, none).otherwise(F.col("_bad")), "unchecked": F.when(media_sent, F.col("_bad")).otherwise(none)})
    return out.withColumns({f: F.when(~F.array_contains("scrubbed", f), F.col(f)) for f in fields}).drop("_bad")


def tally(checked: DataFrame) -> DataFrame:
    """(field, outcome, n): how often each field was scrubbed or went unchecked."""
    both = checked.select(F.explode(F.array(F.struct(F.lit("scrubbed").alias("outcome"), F.col("scrubbed").alias("f")), F.struct(F.lit("unchecked").alias("outcome"), F.col("unchecked").alias("f")))).alias("x"))
    return both.select("x.outcome", F.explode("x.f").alias("field")).groupBy("field", "outcome").agg(F.count("*").alias("n"))


def verdict(has_evidence: Column, waits: Column, error: Column, gate: Column) -> Column:
    return F.when(~has_evidence, "EMPTY").when(waits, "DEFERRED").when(error.isNotNull(), "FAILED").when(gate == "NO", "EXCLUDED").otherwise("DRAFTED")


def within_budget(rows: DataFrame, most: int) -> DataFrame:
    """Rows whose verdict costs nothing (EMPTY, DEFERRED), and of the others the first `most` by date and id."""
    free = F.col("verdict").isin("EMPTY", "DEFERRED")
    return rows.where(free).unionByName(rows.where(~free).orderBy("posted_on", "id").limit(most))


def review_queue(drafts: DataFrame) -> DataFrame:
    """What waits for a person, the oldest first."""
    return drafts.where("review_status = 'PENDING'").orderBy("posted_on", "id")


def report(drafts: DataFrame) -> DataFrame:
    """(what, value, n): how many drafts have each review status, confidence and reason of rejection."""
    kinds = ["review_status", "confidence", "reject_reason"]
    each = F.array(*[F.struct(F.lit(k).alias("what"), F.col(k).alias("value")) for k in kinds])
    return drafts.select(F.explode(each).alias("x")).where("x.value is not null").groupBy("x.what", "x.value").agg(F.count("*").alias("n"))


# --- screening and dictionaries ----------------------------------------------------------


def screened(drafts: DataFrame, reference: DataFrame) -> DataFrame:
    """Adds ``match`` and ``screen``: conclusive, review, cleared, or null without a match.

    The church's name is looked up first, then the denomination as stated; of an entry's namesakes one
    in the same region comes first, then list order. The list is joined by key; it is broadcast only if Spark finds it small.
    """
    names = reference.select(F.col("entry").alias("_entry"), F.explode(F.array_union(F.array("name"), "aliases")).alias("_name"), F.col("region").alias("_region"), "pastor")
    names = names.select("_entry", name_key(F.col("_name")).alias("_key"), "_region", F.col("pastor").alias("_pastor")).where("_key <> ''").distinct()
    asked = drafts.select("id", "region", F.explode(F.array(F.struct(F.lit(0).alias("o"), name_key(F.col("church_name")).alias("k")), F.struct(F.lit(1).alias("o"), name_key(F.col("raw_denomination")).alias("k")))).alias("q"))
    found = asked.select("id", "region", "q.o", F.col("q.k").alias("_key")).join(names, "_key")
    rank = F.struct(F.col("o"), F.when(F.col("_region") == F.col("region"), 0).otherwise(1), F.col("_entry"))
    best = found.groupBy("id").agg(F.min_by(F.struct(F.col("_entry").alias("entry"), "_key", "_region", "_pastor", "o"), rank).alias("match"))
    out = drafts.join(best, "id", "left")
    pastor, listed = F.col("senior_pastor"), F.col("match._pastor")
    both_regions = F.col("region").isNotNull() & F.col("match._region").isNotNull()
    same_region = F.coalesce(F.col("region") == F.col("match._region"), F.lit(False))
    single = F.col("match._key").endswith("교회") & ~F.col("match._key").endswith("선교회")
    conclusive = F.when(both_regions, same_region).otherwise(F.coalesce(pastor == listed, F.lit(False)) | ~single)
    cleared = F.coalesce(pastor != listed, F.lit(False))
    return out.withColumn("screen", F.when(F.col("match").isNotNull(), F.when(cleared, "cleared").when(conclusive, "conclusive").otherwise("review")))


def screen_evidence(entry: Column, ruled_by: Column, field: Column, region: Column) -> Column:
    """What is told to the reviewer, in four parts."""
    return F.concat_ws(" · ", entry, ruled_by, field, F.coalesce(region, F.lit("지역 미상")))


def reject_reason(screen: Column, closed: Column) -> Column:
    return F.when(screen == "conclusive", "HERESY").when(closed, "CLOSED")


# --- constraints -------------------------------------------------------------------------


def violations(rules: dict[str, Column]) -> Column:
    """The names of the rules that a row breaks; a rule that is null holds."""
    return F.filter(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())


def draft_rules() -> dict[str, Column]:
    c = F.col
    return {
        "C1 source key": c("source_key").rlike("^[A-Z][A-Z0-9_]*$"),
        "C2 blank": F.least(*[_filled(c(x)) for x in ("external_id", "title")]),
        "C3 gate": (c("gate") != "NO") & ((c("gate") != "UNCERTAIN") | (c("confidence") == "low")),
        "C4 pay": F.coalesce(c("pay_min") >= 0, F.lit(True)) & F.coalesce(c("pay_max") >= 0, F.lit(True)) & F.coalesce(c("pay_min") <= c("pay_max"), F.lit(True)),
        "C5 denomination": (c("denomination_source") == "unknown") | F.coalesce(c("denomination") != "UNKNOWN", F.lit(False)),
        "C6 kind": F.when(c("job_kind").isNull(), (F.size("positions") == 0) & c("role").isNull()).otherwise(((c("job_kind") == "MINISTRY") == (F.size("positions") > 0)) & ((c("job_kind") == "GENERAL") == c("role").isNotNull())),
        "C7 evidence": ~c("heresy_flag") | _filled(c("heresy_evidence")),
        "C8 rejected": (c("review_status") == "REJECTED") == c("reject_reason").isNotNull(),
        "C9 duplicate": F.coalesce(c("reject_reason") == "DUPLICATE", F.lit(False)) == F.coalesce(c("dedup_state") == "DUPLICATE", F.lit(False)),
    }


def quarantined(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep all rules, the others with ``violations``)."""
    told = rows.withColumn("violations", violations(rules))
    return told.where(F.size("violations") == 0).drop("violations"), told.where(F.size("violations") > 0)
