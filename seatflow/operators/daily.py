"""The passes of a day over snapshots: drafts from answers, verdicts of the whole corpus, publication.

Order matters: what is gone leaves its seat before the others are judged, and all steps of publication
read the same snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatflow.functions import dates as D
from seatflow.functions import text as T
from seatflow.functions.names import senior_pastor_of
from seatflow.operators import checks, dedup, denominations, drafts, publish, schema, store, verify
from seatflow.vocab import GATE, JOB_KIND, POSITION, REGION, canonical

#: The form fields that tell a posting's status.
STATUS_FIELDS = ["status", "category", "classification"]
#: Answer fields that must stand in the source, and are emptied where they don't.
CHECKED = ["church_name", "city", "address", "contact_email", "contact_phone", "raw_denomination"]


#: What an answer's keys are called in a draft.
NAMES = {"is_church_recruitment": "gate", "contact_tel": "contact_phone", "position": "positions", "deadline": "deadline_text", "unchecked": "counted"}


def answered(raw: DataFrame, payloads: DataFrame, labels: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(answers as built takes them, failed ones with their ``fault``) of a model's payloads(id, payload, media_sent, media_missed).

    An answer is whole or fails. Each field is held against the posting by the table of tests; what is dropped, what couldn't be looked up
    and what was only counted go along (``dropped``, ``unverifiable``, ``counted``), and so does the denomination that the posting bears out. labels: of
    the form's fields, as the model saw them. A payload without its posting fails.
    """
    told = schema.answered(payloads.select("id", "media_sent", "media_missed", "payload"), "payload")
    source = raw.select("id", F.lit(True).alias("_there"), F.col("title").alias("_title"), F.col("raw_text").alias("_text"), F.col("raw_meta").alias("_meta"),
        (F.col("attachments") if "attachments" in raw.columns else F.lit(None)).cast("array<string>").alias("_files"))
    told = told.join(source, "id", "left").withColumn("fault", F.coalesce("fault", F.when(F.col("_there").isNull(), "no posting")))
    good = told.where("fault is null").drop("fault", "_there").withColumnRenamed("deadline", "deadline_text")
    derived = {c: F.lit(None).cast("string") for along in verify.ALONG.values() for c in along if c not in good.columns}
    parts = checks.haystack(F.col("_text"), F.col("_title"), F.col("_meta"), labels, F.col("_files"))
    held = verify.verified(good.withColumns(derived), parts, F.col("_title"), F.col("media_sent"))
    gone = F.transform("dropped", lambda d: d["field"])
    held = held.withColumns({c: F.when(~F.array_contains(gone, c), F.col(c)) for c in ("pay_amount", "deadline_text")})
    said = denominations.confirmed(F.col("raw_denomination"), F.col("_text"), F.map_values("_meta"))
    held = held.withColumns({"denomination": said["key"], "denomination_source": said["source"], "denomination_word": said["word"]})
    names = {c: NAMES.get(c, c) for c in held.columns if c not in derived and not c.startswith("_")}
    return held.select(*[F.col(c).alias(n) for c, n in names.items()]), told.where("fault is not null").select("id", "fault")


def built(raw: DataFrame, answers: DataFrame, reference: DataFrame, today: Column) -> DataFrame:
    """raw(id, source_key, external_id, title, raw_text, raw_meta, posted_on) with a model's
    answers(id, gate, job_kind, positions, …, pay_amount, deadline_text, media_sent, media_missed) to drafts.

    Postings that the gate refuses make no draft. Values are checked against text, title and meta, then
    put into form; the screen, the board's own closing and the deadline decide on rejection; what is
    lacking decides on confidence.
    """
    # an answer without its posting is an error, not a row to leave out
    both = answers.join(raw.withColumn("_there", F.lit(True)), "id", "left").withColumn("id", F.when(F.col("_there"), F.col("id")).otherwise(F.raise_error(F.concat(F.lit("no posting for answer "), F.col("id").cast("string"))))).drop("_there")
    both = both.withColumn("gate", F.coalesce(F.when(F.upper("gate").isin(GATE), F.upper("gate")), F.lit("UNCERTAIN"))).where("gate <> 'NO'")
    none = F.array().cast("array<string>")
    sources = F.concat(F.array(F.coalesce("raw_text", F.lit("")), F.col("title")), F.coalesce(F.map_values("raw_meta"), none))
    whole = F.array_join(F.filter(sources, lambda x: x.isNotNull()), "|")
    own = {"contact_phone": checks.phones_grounded(F.col("contact_phone"), whole), "contact_email": checks.address_grounded(F.col("contact_email"), whole)}
    both = drafts.verified(both, CHECKED, sources, F.col("media_sent"), own)
    pay = T.pay_of(F.col("pay_amount"))
    both = both.withColumns({
        "region": F.when(F.upper("region").isin(REGION), F.upper("region")), "job_kind": F.when(F.upper("job_kind").isin(JOB_KIND), F.upper("job_kind")),
        "positions": canonical(F.transform(F.coalesce("positions", none), F.upper), POSITION), "pay_min": pay["low"], "pay_max": pay["high"],
    })
    shaped = drafts.repaired(both).withColumns({
        "title": T.clean_title(F.col("title")), "city": T.city_without_region(F.col("city"), F.col("region")), "address": T.address_or_none(F.col("address")), "contact_email": T.emails_only(F.col("contact_email")),
        "pay_period": T.period_of(F.col("pay_amount")), "pay_note": T.pay_note_of(F.col("pay_amount"), F.col("pay_note")), "deadline": D.deadline_in(F.col("deadline_text"), F.col("posted_on")),
        "senior_pastor": senior_pastor_of(F.coalesce("raw_text", F.lit("")), F.try_element_at("raw_meta", F.lit("senior_pastor"))), "posted_at": F.col("posted_on"),
    })
    told = drafts.screened(shaped, reference)
    closed = T.closed_by_board(F.col("title"), *[F.try_element_at("raw_meta", F.lit(k)) for k in STATUS_FIELDS]) | D.deadline_passed(F.col("deadline"), today)
    told = told.withColumns({"heresy_flag": F.col("screen").isin("conclusive", "review") & F.col("screen").isNotNull(), "reject_reason": drafts.reject_reason(F.col("screen"), closed)})
    seat = dedup.with_seat(told)
    ready = seat.withColumn("can_compare", F.col("church").isNotNull() & F.col("region").isNotNull() & F.col("role_key").isNotNull()).drop("church", "role_key")
    return drafts.graded(ready).drop("match")


def content(columns: list[str]) -> Column:
    """How many of the columns hold something: false, zero, empty texts and empty arrays don't count."""
    out = F.lit(0)
    for c in columns:
        text = F.col(c).cast("string")
        out = out + F.when(text.isNull() | text.isin("", "false", "0", "[]", "{}"), 0).otherwise(1)
    return out


def judged(rows: DataFrame, today: Column) -> tuple[DataFrame, DataFrame]:
    """(drafts with the verdicts of the whole corpus and ``changed``, verdicts without a draft)."""
    verdicts = dedup.planned(rows, today)
    base = rows
    for c in ("dedup_key", "dedup_state"):
        base = base if c in base.columns else base.withColumn(c, F.lit(None).cast("string"))
    return store.with_updates(base, verdicts, "id")


def published(rows: DataFrame, jobs: DataFrame) -> dict[str, DataFrame]:
    """The changes of a publication pass, all from the same snapshots: links to release, jobs to bump, jobs to insert."""
    ready = publish.candidates(rows)
    new = ready.where(F.size("lacks") == 0).select(
        F.xxhash64("id").alias("job_id"), "id", "church_name", "region", "title", "posted_at", "deadline", F.lit(None).cast("long").alias("church_id"), F.lit("OPEN").alias("status"))
    return {"release": publish.releases(rows, jobs), "bump": publish.bumps(rows, jobs), "insert": new.join(jobs.select("job_id"), "job_id", "left_anti")}
