"""The ledger of what has been read: new rows, page plans, where to stop, conflicts, and tallies.

A row's key is (source_key, external_id). No task sees more than its share of a key's rows; windows are
by board and page or by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatflow.functions.text import squeeze

KEY = ["source_key", "external_id"]


def new_postings(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose key the ledger lacks, one for each key (insert if absent): the first by time of reading, date, id and title.

    Blanks around an id are no part of the key."""
    known = ledger.select(F.col("source_key").alias("_board"), F.trim("external_id").alias("_id"))
    absent = rows.join(known, (F.col("source_key") == F.col("_board")) & (F.trim("external_id") == F.col("_id")), "left_anti")
    order = [F.col(c).asc_nulls_last() for c in ("fetched_at", "posted_on", "id", "title") if c in rows.columns] or [F.lit(0)]
    return absent.withColumn("_n", F.row_number().over(Window.partitionBy("source_key", F.trim("external_id")).orderBy(*order))).where("_n = 1").drop("_n")


def first_seen(listing: DataFrame) -> DataFrame:
    """A listing's rows by (page, pos), each key where it comes first; later ones have shifted between pages."""
    order = Window.partitionBy(*KEY).orderBy("page", "pos")
    return listing.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def page_plan(listing: DataFrame, ledger: DataFrame, cutoff) -> DataFrame:  # noqa: ANN001
    """Adds ``verdict``: stale (before the cutoff, told first; no date is never stale), fresh (not in the
    ledger), conflict (title and date both differ from the ledger's), or seen."""
    known = ledger.select("source_key", F.trim("external_id").alias("_id"), F.col("title").alias("_title"), F.col("posted_on").alias("_on"), F.lit(True).alias("_known"))
    out = listing.withColumn("_id", F.trim("external_id")).join(known, ["source_key", "_id"], "left").drop("_id").select(*listing.columns, "_title", "_on", "_known")
    differs = (squeeze(F.col("title")) != squeeze(F.col("_title"))) & (F.col("posted_on") != F.col("_on"))
    verdict = F.when(F.col("posted_on") < cutoff, "stale").when(F.col("_known").isNull(), "fresh").when(F.coalesce(differs, F.lit(False)), "conflict").otherwise("seen")
    return out.withColumn("verdict", verdict).drop("_title", "_on", "_known")


def stop_pages(planned: DataFrame) -> DataFrame:
    """(source_key, stop_page, last_page): reading goes on while a page has a row within the cutoff."""
    pages = planned.groupBy("source_key", "page").agg(F.count_if(F.col("verdict") != "stale").alias("live"))
    out = pages.groupBy("source_key").agg(F.min(F.when(F.col("live") == 0, F.col("page"))).alias("stop_page"), F.max("page").alias("last_page"))
    return out.withColumn("stop_page", F.coalesce("stop_page", "last_page"))


def gone_stop_pages(listing: DataFrame, targets: DataFrame, since) -> DataFrame:  # noqa: ANN001
    """(source_key, floor_page, stop_page): how far a list is read to see what is still there.

    Reading ends with a page that has no new id, or none dated since that day (no date counts as since) once
    the floor is reached: as many pages as the board's targets fill, at the first page's size. Else it ends with the last page.
    """
    first = F.row_number().over(Window.partitionBy(*KEY).orderBy("page", "pos")) == 1
    inside = F.coalesce(F.col("posted_on") >= since, F.lit(True))
    pages = listing.withColumn("_new", first).groupBy("source_key", "page").agg(F.count("*").alias("n"), F.count_if("_new").alias("new"), F.count_if(inside).alias("inside"))
    boards = pages.groupBy("source_key").agg(F.max("page").alias("last_page"), F.min_by("n", "page").alias("size"))
    boards = boards.join(targets.groupBy("source_key").agg(F.count("*").alias("targets")), "source_key", "left")
    boards = boards.withColumn("floor_page", F.greatest(F.lit(1), F.ceil(F.coalesce("targets", F.lit(0)) / F.col("size"))).cast("long"))
    ends = pages.join(boards, "source_key").where((F.col("new") == 0) | ((F.col("inside") == 0) & (F.col("page") >= F.col("floor_page"))))
    out = boards.join(ends.groupBy("source_key").agg(F.min("page").alias("stop_page")), "source_key", "left")
    return out.select("source_key", "floor_page", F.coalesce("stop_page", "last_page").alias("stop_page"))


#: No list is read further than this.
MOST_PAGES = 100


def page_limit(option, board):  # noqa: ANN001, ANN201
    """Pages to read of a board: the least of the run's option, the board's own limit, and MOST_PAGES; a null of these doesn't count."""
    return F.least(option, board, F.lit(MOST_PAGES))


def shifted(listing: DataFrame) -> DataFrame:
    """(source_key, shifted): rows of a run's lists whose posting had stood on an earlier page already."""
    first = F.row_number().over(Window.partitionBy(*KEY).orderBy("page", "pos")) == 1
    return listing.withColumn("_first", first).groupBy("source_key").agg(F.count_if(~F.col("_first")).alias("shifted"))


def tally(planned: DataFrame, limit: int) -> DataFrame:
    """Per board the counts of a run, and its guards: all rows stale, cut off at the page limit, conflicts."""
    n = lambda v: F.count_if(F.col("verdict") == v).cast("long")
    out = planned.groupBy("source_key").agg(
        F.countDistinct("page").alias("pages"), F.count("*").alias("n_rows"), n("fresh").alias("fresh"), n("seen").alias("seen"), n("stale").alias("stale"),
        n("conflict").alias("conflicts"), F.min("posted_on").alias("oldest"), F.max("posted_on").alias("newest"),
    )
    return out.withColumns({"nothing_live": F.col("stale") == F.col("n_rows"), "short_of_cutoff": (F.col("pages") >= limit) & (F.col("stale") == 0)})


#: Rows of a report that stand for all of their kind.
SAMPLES = 3


def first_of_board(rows: DataFrame, told: Column, name: str) -> DataFrame:
    """(source_key, name array): what is told of each board's first rows by page and position."""
    order = Window.partitionBy("source_key").orderBy("page", "pos", "external_id")
    few = rows.select("source_key", told.alias("told"), F.row_number().over(order).alias("nth")).where(F.col("nth") <= SAMPLES)
    return few.groupBy("source_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "told"))), lambda x: x["told"]).alias(name))


def accounts(planned: DataFrame, details: DataFrame, has_cutoff: Column) -> DataFrame:
    """A run's report for each board: rows by verdict, details read, rows saved, saved without content, failed, the first samples, and ``fault``.

    planned: a listing with its verdicts, each posting once; details(source_key, external_id, inserted, text, images, attachments, error) of the fresh
    ones that were read. A board fails as a whole, by the first of these: a conflict, a page without any date where a cutoff is asked
    for, details that all failed, and saved rows that are all empty. One failed or empty row is told and no more.
    """
    n = lambda v: F.count_if(F.col("verdict") == v)
    live = F.col("verdict").isin("fresh", "seen")
    out = planned.groupBy("source_key").agg(
        F.countDistinct("page").alias("pages"), n("fresh").alias("fresh"), n("seen").alias("seen"), n("stale").alias("stale"), n("conflict").alias("conflicts"),
        F.min(F.when(live, F.col("posted_on"))).alias("oldest"), F.max(F.when(live, F.col("posted_on"))).alias("newest"),
    )
    pages = planned.groupBy("source_key", "page").agg(F.count("posted_on").alias("dated")).groupBy("source_key").agg(F.count_if(F.col("dated") == 0).alias("undated_pages"))
    read = planned.where("verdict = 'fresh'").select("source_key", "external_id", "page", "pos").join(details, ["source_key", "external_id"])
    filled = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    content = F.coalesce(F.trim("text") != "", F.lit(False)) | filled("images") | filled("attachments")
    good, saved = F.col("error").isNull(), F.coalesce(F.col("inserted"), F.lit(False)) & F.col("error").isNull()
    sums = read.groupBy("source_key").agg(F.count_if(good).alias("details"), F.count_if(saved).alias("saved"), F.count_if(saved & ~content).alias("empty"), F.count_if(~good).alias("failed"))
    out = out.join(pages, "source_key").join(sums, "source_key", "left").fillna(0, ["details", "saved", "empty", "failed"])
    out = out.join(first_of_board(planned.where("verdict = 'fresh'"), F.col("title"), "samples"), "source_key", "left")
    out = out.join(first_of_board(read.where(~good), F.concat_ws(": ", "external_id", "error"), "failures"), "source_key", "left")
    fault = F.when(F.col("conflicts") > 0, "conflicts").when(has_cutoff & (F.col("undated_pages") > 0), "no dates for the cutoff").when((F.col("failed") > 0) & (F.col("saved") == 0), "nothing was saved")
    return out.withColumn("fault", fault.when((F.col("saved") > 0) & (F.col("empty") == F.col("saved")), "all that was saved is empty")).drop("undated_pages")


def requeue(rows: DataFrame, drafts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a verdict go back to be judged again, unless their draft is protected; returns (rows, drafts left)."""
    protected = drafts.where("protected").select("source_data_id").distinct()
    back = rows.where("structured_at is not null").join(protected, rows["id"] == protected["source_data_id"], "left_anti")
    state = back.select(F.col("id").alias("_back"))
    out = rows.join(state, rows["id"] == state["_back"], "left")
    cleared = F.col("_back").isNotNull()
    out = out.withColumns({
        "requeued": cleared, "structured_at": F.when(~cleared, F.col("structured_at")), "structure_attempts": F.when(cleared, 0).otherwise(F.col("structure_attempts")),
    }).drop("_back")
    return out, drafts.join(state, drafts["source_data_id"] == state["_back"], "left_anti")


def unstructured(rows: DataFrame, limit: int | None = None, board: str | None = None, most: int = 3) -> DataFrame:
    """Rows still to be judged, oldest first (a top-k if a limit is given): no verdict and attempts left."""
    out = rows.where(F.col("structured_at").isNull() & (F.col("structure_attempts") < most))
    out = out.where(F.col("source_key") == board) if board else out
    return out.orderBy("posted_on", "id").limit(limit) if limit else out


def has_evidence(text, images, attachments, meta_lines):  # noqa: ANN001, ANN201
    """A text, an image or a file, or at least one line of meta that says something."""
    return F.coalesce(squeeze(text) != "", F.lit(False)) | (F.size(images) > 0) | (F.size(attachments) > 0) | (F.size(meta_lines) > 0)
