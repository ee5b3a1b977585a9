"""Calendar rules on dates, as Columns; the day that counts as today is always given."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s 　]"


def months_before(day: Column, months: int) -> Column:
    """So many calendar months earlier; a day that the month lacks becomes its last."""
    return F.add_months(day, -months)


def deadline_passed(deadline: Column, today: Column) -> Column:
    """Past only from the next day on; no deadline never passes."""
    return F.coalesce(deadline < today, F.lit(False))


def visible(posted_at: Column, deadline: Column, today: Column, days: int = 90) -> Column:
    """Until the deadline, or for `days` after posting if there is none."""
    return F.when(deadline.isNotNull(), deadline >= today).otherwise(F.date_add(posted_at, days) >= today)


def listed_date(text: Column) -> Column:
    """A list's date with -, . or / between; anything else is null, to be quarantined."""
    parts = F.regexp_extract(F.trim(text), r"^(\d{4}[-./]\d{1,2}[-./]\d{1,2})\.?$", 1)
    return F.try_to_timestamp(F.nullif(F.regexp_replace(parts, "[./]", "-"), F.lit("")), F.lit("yyyy-M-d")).cast("date")


def short_date(text: Column, today: Column) -> Column:
    """HH:MM is today; month and day (with - or ., of one or two digits) are their latest occurrence up to
    today, in this year or the last; a full date is itself."""
    t = F.trim(text)
    parts = F.split(F.translate(t, ".", "-"), "-")
    month_day = (F.size(parts) == 2) & F.forall(parts, lambda x: x.rlike("^[0-9]{1,2}$"))
    of = lambda year: F.try_to_timestamp(F.concat_ws("-", year.cast("string"), F.get(parts, F.lit(0)), F.get(parts, F.lit(1))), F.lit("yyyy-M-d")).cast("date")
    this_year, last_year = of(F.year(today)), of(F.year(today) - 1)
    recent = F.when(this_year <= today, this_year).otherwise(last_year)
    return F.when(t.rlike(r"^\d{1,2}:\d{2}$"), today).when(month_day, recent).otherwise(listed_date(t))


def _latest(days: Column) -> Column:
    return F.array_max(F.filter(days, lambda d: d.isNotNull()))


def deadline_in(text: Column, posted_on: Column) -> Column:
    """The latest date that a phrase states: 2026.8.31, 20260831, the tail of a range in the same year,
    or else the day of a month without a year, which takes the year of posting and must not be before it.

    Years run from 2000 to 2100; days that don't exist are dropped.
    """
    day = lambda y, m, d: F.try_to_timestamp(F.concat_ws("-", y, m, d), F.lit("yyyy-M-d")).cast("date")
    full = r"(?<!\d)(20\d{2}|2100)\s*[-./年년]\s*(\d{1,2})\s*[-./월]\s*(\d{1,2})(?!\d)"
    n = lambda k: F.regexp_extract_all(text, F.lit(full), F.lit(k))
    separated = F.transform(F.arrays_zip(n(1).alias("y"), n(2).alias("m"), n(3).alias("d")), lambda x: day(x["y"], x["m"], x["d"]))
    compact = F.transform(
        F.regexp_extract_all(text, F.lit(r"(?<!\d)((?:20\d{2}|2100)\d{4})(?!\d)"), F.lit(1)), lambda x: F.try_to_timestamp(x, F.lit("yyyyMMdd")).cast("date"))
    ranged = full.removesuffix(r"(?!\d)") + r"\s*일?\s*[~∼〜–—]\s*(\d{1,2})\s*[-./월]\s*(\d{1,2})(?!\d)"
    r = lambda k: F.regexp_extract_all(text, F.lit(ranged), F.lit(k))
    tails = F.transform(F.arrays_zip(r(1).alias("y"), r(4).alias("m"), r(5).alias("d")), lambda x: day(x["y"], x["m"], x["d"]))
    stated = _latest(F.concat(separated, compact, tails))
    # a day of a month: the number that ends what stands before the word for month, and that before the word for day after it
    pieces = F.split(text, "월")
    month = lambda x: F.regexp_extract(F.rtrim(x), r"[0-9]+$", 0)
    of_month = lambda x: F.rtrim(F.when(F.contains(x, F.lit("일")), F.substring_index(F.ltrim(x), "일", 1)))
    pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(pieces) - 1), F.slice(pieces, F.lit(2), F.size(pieces)), lambda x, y: F.struct(month(x).alias("m"), of_month(y).alias("d")))
    told = F.filter(pairs, lambda x: x["m"].rlike("^[0-9]{1,2}$") & x["d"].rlike("^[0-9]{1,2}$"))
    yearless = _latest(F.transform(told, lambda x: day(F.year(posted_on).cast("string"), x["m"], x["d"])))
    return F.coalesce(stated, F.when(yearless >= posted_on, yearless))


def cutoff(today: Column, days: int | None = None, months: int | None = None, has_dates: Column | None = None) -> Column:
    """The first day that is read: so many days or calendar months back, one of the two and at least one; none where a list gives no dates."""
    if (days is None) == (months is None) or (days if months is None else months) < 1:
        raise ValueError("either days or months, at least one")
    first = F.date_sub(today, days) if days else months_before(today, months)
    return first if has_dates is None else F.when(has_dates, first)


#: The forms in which boards write a day, the longest first; two digits of a year are of this century.
BOARD_FORMS = ["yyyy-MM-dd HH:mm:ss", "yyyy-M-d", "yyyyMMdd", "yy-M-d"]


def board_date(text: Column) -> Column:
    """A board's day in any of the forms, with -, . or / between; null if it is in none."""
    plain = F.translate(F.rtrim(F.trim(text), F.lit(".")), "./", "--")
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(form)).cast("date") for form in BOARD_FORMS])


def date_in_path(path: Column) -> Column:
    """The day of upload that a file's name begins with (yyyymmdd); null without one that exists."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.try_to_timestamp(F.left(name, F.lit(8)), F.lit("yyyyMMdd")).cast("date")
