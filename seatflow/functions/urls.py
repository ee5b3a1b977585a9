"""Addresses: parts, ids, media worth fetching, and pages to ask for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def part(url: Column, name: str, key: str | None = None) -> Column:
    """A part of an address; null where it is malformed."""
    return F.try_parse_url(url, F.lit(name), F.lit(key)) if key else F.try_parse_url(url, F.lit(name))


def id_from_query(url: Column, key: str) -> Column:
    return F.nullif(F.trim(part(url, "QUERY", key)), F.lit(""))


def id_from_template(url: Column, template: str) -> Column:
    """What stands for {id} in a template such as https://host/view/{id}.html."""
    before, after = template.split("{id}")
    quote = lambda s: "\\Q" + s + "\\E" if s else ""
    return F.nullif(F.regexp_extract(url, f"^{quote(before)}([^/?#&]+){quote(after)}", 1), F.lit(""))


def worth_fetching(url: Column, receipts: list[str]) -> Column:
    """data: or http(s) addresses, but for hosts that only record a reading, in the host or behind the #."""
    host = F.lower(F.coalesce(part(url, "HOST"), F.lit("")))
    shown = F.coalesce(part(url, "REF"), F.lit(""))
    hidden = F.lower(F.regexp_extract(shown, r"^(?:[a-z]+:)?//([^/?#]+)", 1))
    return url.startswith("data:") | (url.rlike("^https?://") & ~host.isin(receipts) & ~hidden.isin(receipts))


def page_request(url: Column, key: str, page: Column) -> Column:
    """A list's address for a page; the first is the list's own."""
    mark = F.when(F.contains(url, F.lit("?")), "&").otherwise("?")
    return F.when(page <= 1, url).otherwise(F.concat(url, mark, F.lit(key + "="), page.cast("string")))
