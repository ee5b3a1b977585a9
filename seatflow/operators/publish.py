"""Publication and disappearance: what goes out, is bumped, released, closed, or gone.

Every step reads the same snapshot of drafts and jobs and returns frames of changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatflow.functions.dates import visible
from seatflow.operators.store import linked

REQUIRED = ["church_name", "title", "region"]
CONTACTS = ["contact_email", "contact_phone", "contact_link", "contact_post"]
BULK_SHARE, BULK_LEAST = 0.3, 3
#: Listed postings that a sweep must find alive on each board.
CONTROLS = 2


def anchors(jobs: DataFrame, ours: DataFrame, today: Column) -> DataFrame:
    """Visible open jobs that we didn't publish ourselves."""
    seen = jobs.where((F.col("status") == "OPEN") & visible(F.col("posted_at"), F.col("deadline"), today))
    return seen.join(ours.select("job_id").distinct(), "job_id", "left_anti")


def candidates(drafts: DataFrame) -> DataFrame:
    """Approved drafts without a link that have been judged, and what they lack to go out."""
    ready = drafts.where("review_status = 'APPROVED' and published_job_id is null and dedup_state is not null")
    blank = lambda c: F.coalesce(F.trim(F.col(c)) == "", F.lit(True))
    lacks = F.filter(F.array(*[F.when(blank(c), F.lit(c)) for c in REQUIRED], F.when(F.forall(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in CONTACTS]), lambda x: F.trim(x) == ""), F.lit("contact"))), lambda x: x.isNotNull())
    return ready.withColumn("lacks", lacks)


def counts(drafts: DataFrame) -> DataFrame:
    """One row: approved drafts without a link that go out, that lack something, and that the corpus pass hasn't judged yet."""
    waiting = drafts.where("review_status = 'APPROVED' and published_job_id is null")
    told = candidates(drafts).agg(F.count_if(F.size("lacks") == 0).alias("publishable"), F.count_if(F.size("lacks") > 0).alias("incomplete"))
    return told.join(F.broadcast(waiting.agg(F.count_if(F.col("dedup_state").isNull()).alias("unjudged"))))  # one row each


def newest_by_key(drafts: DataFrame) -> DataFrame:
    return drafts.where("dedup_key is not null").groupBy("dedup_key").agg(F.max("posted_on").alias("newest"))


def bumps(drafts: DataFrame, jobs: DataFrame) -> DataFrame:
    """(job_id, posted_at): masters' unclaimed jobs whose group has a newer posting."""
    masters = drafts.where("published_job_id is not null and dedup_state = 'MASTER'").select(F.col("published_job_id").alias("job_id"), "dedup_key")
    out = masters.join(newest_by_key(drafts), "dedup_key").join(jobs.where("church_id is null").select("job_id", "posted_at"), "job_id")
    return out.where("newest > posted_at").select("job_id", F.col("newest").alias("posted_at"))


def releases(drafts: DataFrame, jobs: DataFrame) -> DataFrame:
    """Drafts whose linked job is no more: the link is taken back if it is still the one that was read."""
    ours = drafts.where("published_job_id is not null")
    return ours.join(jobs.select(F.col("job_id").alias("published_job_id")), "published_job_id", "left_anti").select("id", "published_job_id")


def expired(jobs: DataFrame, ours: DataFrame, today: Column) -> DataFrame:
    """Our open, unclaimed jobs whose deadline has passed."""
    late = jobs.where((F.col("status") == "OPEN") & F.col("church_id").isNull() & (F.col("deadline") < today))
    return late.join(ours.select("job_id").distinct(), "job_id", "left_semi").select("job_id")


def gone_targets(raw: DataFrame, drafts: DataFrame, since: Column) -> DataFrame:
    """Postings to look for: dated since that day, whose draft isn't gone and is published or waits for review."""
    open_ = drafts.where(F.col("gone_at").isNull() & (F.col("published_job_id").isNotNull() | (F.col("review_status") == "PENDING")))
    return raw.where(F.col("posted_on") >= since).join(open_.select("id").distinct(), "id", "left_semi").select("id", "source_key", "external_id", "posted_on")


def detail_alive(text: Column, images: Column, attachments: Column, error: Column) -> Column:
    """Whether a posting's own page still shows anything: a text, an image or a file. A page that can't be read shows nothing."""
    shown = F.coalesce(F.trim(text) != "", F.lit(False)) | (F.coalesce(F.size(images), F.lit(0)) > 0) | (F.coalesce(F.size(attachments), F.lit(0)) > 0)
    return error.isNull() & shown


# Codes with which an interface answers for one posting.
PROBED = {"42004": "gone", "10000": "alive"}


def probed(body: Column) -> Column:
    """alive, gone, or unknown by the code of an interface's answer."""
    code = F.get_json_object(body, "$.code")
    out = F.when(F.lit(False), F.lit("unknown"))
    for key, said in PROBED.items():
        out = out.when(code == key, said)
    return out.otherwise("unknown")


def missing(targets: DataFrame, listing: DataFrame, boards: DataFrame) -> DataFrame:
    """Per target whether it is ``listed``, and the ``guard`` that its board fails, if any.

    boards: (source_key, check), check being `page` or `interface`: how one posting can be asked after, null if it can't.
    A target that isn't listed is a candidate and no more. Guards in this order: no second check, bulk (more than 30 %
    and more than three of the board's targets are missing), nothing listed.
    """
    key = ["source_key", "external_id"]
    listed = listing.select(*key).distinct().withColumn("_listed", F.lit(True))
    out = targets.join(listed, key, "left").withColumn("listed", F.coalesce("_listed", F.lit(False))).drop("_listed")
    sums = out.groupBy("source_key").agg(F.count("*").alias("n"), F.count_if(~F.col("listed")).alias("lost"))
    sums = sums.join(boards.select("source_key", "check"), "source_key", "left").join(listing.groupBy("source_key").agg(F.count("*").alias("shown")), "source_key", "left")
    bulk = (F.col("lost") > BULK_LEAST) & (F.col("lost") > BULK_SHARE * F.col("n"))
    guard = F.when(F.col("check").isNull(), "no second check").when(bulk, "bulk").when(F.col("shown").isNull(), "nothing listed")
    return out.join(sums.select("source_key", "check", guard.alias("guard")), "source_key")


def page_verdict(check: Column, answer: Column) -> Column:
    """alive, gone or unknown of one posting by its own page or its interface's code; what was never asked after is unknown.

    answer: a struct of text, images, attachments, error and body, null if there is none. A page that can't be read is gone, which
    holds only where pages known to be there can be read (see gone_sweep); an interface that can't be read tells nothing.
    """
    shown = detail_alive(answer["text"], answer["images"], answer["attachments"], answer["error"])
    by_page = F.when(shown, "alive").otherwise("gone")
    by_code = F.when(answer["error"].isNull(), probed(answer["body"])).otherwise("unknown")
    return F.when(answer.isNull(), "unknown").when(check == "page", by_page).when(check == "interface", by_code).otherwise("unknown")


def controls(listing: DataFrame) -> DataFrame:
    """The first rows of each board's first page, by position: postings that were just seen to be there."""
    order = Window.partitionBy("source_key").orderBy("pos", "external_id")
    first = listing.where("page = 1").select("source_key", "external_id", F.row_number().over(order).alias("nth"))
    return first.where(F.col("nth") <= CONTROLS).select("source_key", "external_id").distinct()


def gone_sweep(targets: DataFrame, listing: DataFrame, boards: DataFrame, pages: DataFrame) -> DataFrame:
    """Per target a ``verdict`` and the ``guard`` that held its board: listed, alive, gone, unknown, or held.

    pages: (source_key, external_id, text, images, attachments, error, body) as read for this sweep, one row a posting. Of a
    candidate its own page or interface decides, once the board's first two listed postings are asked in the same way and are
    alive: they are there by definition, so if they seem gone, the board has changed and no candidate of it is judged.
    Boards that fail a guard are held whole but for what is listed; a posting that is gone is found another day.
    """
    key = ["source_key", "external_id"]
    answers = pages.select(*key, F.struct("text", "images", "attachments", "error", "body").alias("answer")).dropDuplicates(key)
    out = missing(targets, listing, boards)
    seen = controls(listing).join(boards.select("source_key", "check"), "source_key").join(answers, key, "left")
    seen = seen.groupBy("source_key").agg(F.count_if(page_verdict(F.col("check"), F.col("answer")) != "alive").alias("dead"))
    out = out.join(seen, "source_key", "left").join(answers, key, "left")
    control = F.when(F.col("dead").isNull(), "no control").when(F.col("dead") > 0, "a control isn't alive")
    lost = out.groupBy("source_key").agg(F.count_if(~F.col("listed")).alias("lost"))  # a board without candidates asks no one
    out = out.join(lost, "source_key").withColumn("guard", F.when(F.col("lost") > 0, F.coalesce("guard", control)).otherwise(F.when(F.col("guard") == "no second check", F.col("guard"))))
    verdict = F.when(F.col("listed"), "listed").when(F.col("guard").isNotNull(), "held").otherwise(page_verdict(F.col("check"), F.col("answer")))
    return out.select(*targets.columns, verdict.alias("verdict"), "guard")


def marked_gone(drafts: DataFrame, found: DataFrame, at: Column) -> DataFrame:
    """gone_at is set once; a later sweep changes nothing."""
    now = found.where("verdict = 'gone'").select(F.col("id").alias("_id")).distinct()
    return drafts.join(now, drafts["id"] == now["_id"], "left").withColumn("gone_at", F.coalesce("gone_at", F.when(F.col("_id").isNotNull(), at))).drop("_id")


def closes(drafts: DataFrame, jobs: DataFrame, today: Column) -> DataFrame:
    """(job_id): our open, unclaimed jobs whose deadline has passed, or whose posting is gone."""
    ours = drafts.where("published_job_id is not null").select(F.col("published_job_id").alias("job_id"), "gone_at")
    open_ = jobs.where("status = 'OPEN' and church_id is null")
    over = open_.join(ours.groupBy("job_id").agg(F.max("gone_at").alias("gone_at")), "job_id")
    return over.where((F.col("deadline") < today) | F.col("gone_at").isNotNull()).select("job_id")


def applied(drafts: DataFrame, jobs: DataFrame, today: Column, job_id: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(drafts, jobs) after one pass of publication: releases, bumps, closes and inserts, all told from the same two snapshots.

    A job that is closed is also bumped if it is due; a link that is taken back in this pass isn't made anew before the next one.
    job_id: of a new job, from its draft.
    """
    ready = candidates(drafts).where(F.size("lacks") == 0)
    new = ready.select((F.xxhash64("id") if job_id is None else job_id).alias("job_id"), "id", "posted_at", "deadline", F.lit("OPEN").alias("status"), *[c for c in ("church_name", "region", "title") if c in jobs.columns])
    new = new.join(jobs.select("job_id"), "job_id", "left_anti")
    later = bumps(drafts, jobs).groupBy("job_id").agg(F.max("posted_at").alias("_newest"))
    over = closes(drafts, jobs, today).withColumn("_over", F.lit(True))
    kept = jobs.join(later, "job_id", "left").join(over, "job_id", "left").withColumns({
        "posted_at": F.coalesce("_newest", "posted_at"), "status": F.when(F.col("_over"), "CLOSED").otherwise(F.col("status")),
    }).select(*jobs.columns)
    back = releases(drafts, jobs).select("id", F.col("published_job_id").alias("job_id"))
    return linked(drafts, new.select("id", "job_id"), back), kept.unionByName(new.drop("id"), allowMissingColumns=True).select(*jobs.columns)
