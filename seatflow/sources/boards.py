"""Board pages by selector specs: one generic parser of lists and details, and a table of what differs.

A spec names the rows, the cells, how notices are told, how the id is found, and where body and files
are. Rows that can't be read go to an error column; a page whose rows are all filtered out, or that has
none, is an error and never an empty listing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatflow.functions.html import Node, absolute, attachments_of, images_of, structure_of, text_of, tree


@dataclass(frozen=True)
class Spec:
    """Selectors of a board; cells are selectors within a row, or numbers of its td."""

    rows: str
    link: str
    date: str | int | None
    number: str | int | None = None
    notice: str = ""
    badge: str = ""
    drop: str = ""
    identifier: str = r"[?&](?:no|idx|id|wr_id|seq|b_id)=(\d+)"
    body: str = "body"
    hidden: str = ""
    files: str = ""
    meta: dict[str, str | int] = field(default_factory=dict)
    empty: str = ""  # a mark that says that a page has no rows
    locked: str = ""  # rows that can't be opened
    encoded_body: bool = False  # the body is markup inside a field, read once more
    script_files: str = ""  # a call with (path or id, name) in scripts' links
    date_format: str = "yyyy-MM-dd"
    first_page: int = 1
    page_step: int = 1  # rows a page, for lists that page by offset


@dataclass(frozen=True)
class JsonSpec:
    """A list that comes as JSON: where its rows are, what each field is called, and the codes that say yes."""

    rows: str
    identifier: str
    title: str
    date: str
    body: str = ""
    keep: tuple[str, ...] = ()
    code: str = ""
    ok: tuple[str, ...] = ()


def _cell(row: Node, where: str | int) -> str:
    if isinstance(where, int):
        cells = [c for c in row.children if isinstance(c, Node) and c.tag in ("td", "th")]
        return cells[where].text() if where < len(cells) else ""
    found = row.first(where)
    return found.text() if found else ""


def _without(node: Node, selector: str) -> Node:
    for gone in node.select(selector) if selector else ():
        gone.parent.children.remove(gone)
    return node


def read_list(page: str | None, base: str, spec: Spec) -> tuple[list[dict], str | None]:
    """Rows of a list page, and an error."""
    root = tree(page)
    if spec.empty and root.first(spec.empty):
        return [], None
    rows = root.select(spec.rows)
    if not rows:
        return [], "no rows"
    out, problem = [], None
    for row in rows:
        if spec.notice and (row.first(spec.notice) or any(c.strip(".") in row.attrs.get("class", "").split() for c in spec.notice.split(","))):
            continue
        if spec.number is not None and not _cell(row, spec.number).isdigit():
            continue
        if any(mark and row.first(mark) for mark in (spec.drop, spec.locked)):
            continue
        link = row.first(spec.link)
        if link is None:
            problem = problem or "a row has no link"
            continue
        href = link.attrs.get("href", "") + " " + link.attrs.get("onclick", "")
        found = re.search(spec.identifier, href)
        if not found:
            problem = problem or "a row has no id"
            continue
        title = _without(link, spec.badge).text()
        out.append({
            "external_id": found[1], "url": absolute(base, link.attrs.get("href", "")) or base, "title": title,
            "date_text": _cell(row, spec.date) if spec.date is not None else None, "meta": {k: _cell(row, w) for k, w in spec.meta.items()},
        })
    if not out:
        problem = problem or "all rows were filtered out"
    elif len({r["external_id"] for r in out}) < len(out):
        problem = problem or "an id comes twice"
    return out, problem


def listings(pages: DataFrame, specs: dict[str, Spec]) -> DataFrame:
    """pages(source_key, page, url, html) to one row a posting, with ``error`` on pages that can't be trusted."""
    kind = "array<struct<external_id:string,url:string,title:string,date_text:string,meta:map<string,string>>>"

    @F.pandas_udf(f"refs {kind}, error string")
    def run(keys: pd.Series, urls: pd.Series, htmls: pd.Series) -> pd.DataFrame:
        out = []
        for key, url, page in zip(keys, urls, htmls):
            out.append(read_list(page, url or "", specs[key]) if key in specs else ([], "no spec"))
        return pd.DataFrame(out, columns=["refs", "error"])

    read = pages.select("source_key", "page", run("source_key", "url", "html").alias("r"))
    return read.select("source_key", "page", F.col("r.error").alias("error"), F.posexplode_outer("r.refs").alias("pos", "ref")).select("source_key", "page", "pos", "ref.*", "error")


def details(pages: DataFrame, specs: dict[str, Spec]) -> DataFrame:
    """pages(source_key, url, html) with raw_text, raw_html, image_urls, attachments and error."""

    @F.pandas_udf("raw_text string, raw_html string, image_urls array<string>, attachments array<struct<name:string,url:string>>, error string")
    def run(keys: pd.Series, urls: pd.Series, htmls: pd.Series) -> pd.DataFrame:
        out = []
        for key, url, page in zip(keys, urls, htmls):
            root = tree(page)
            body = root.first(specs[key].body) if key in specs else None
            if body is None:
                out.append((None, None, [], [], "no spec" if key not in specs else "no body"))
                continue
            if specs[key].encoded_body:
                body = tree(body.text())
            _without(body, specs[key].hidden)
            box = root.first(specs[key].files) if specs[key].files else None
            files = [{"name": n, "url": u} for n, u in attachments_of(box, url or "")] if box else []
            if box and specs[key].script_files:
                for a in box.select("a"):
                    found = re.search(specs[key].script_files, a.attrs.get("href", "") + " " + a.attrs.get("onclick", ""))
                    if found:
                        files.append({"name": found[2] if found.re.groups > 1 else a.text(), "url": absolute(url or "", found[1])})
            out.append((text_of(body), structure_of(body), images_of(body, url or ""), files, None))
        return pd.DataFrame(out, columns=["raw_text", "raw_html", "image_urls", "attachments", "error"])

    return pages.withColumn("_d", run("source_key", "url", "html")).select(*[c for c in pages.columns if c not in ("raw_text", "raw_html", "image_urls", "attachments", "error")], "_d.*")


def page_addresses(boards: DataFrame, pages: int) -> DataFrame:
    """boards(source_key, list_url, param, first_page, page_step) to an address for each page; the first is the list's own."""
    n = F.explode(F.sequence(F.lit(1), F.lit(pages))).alias("page")
    out = boards.select("*", n)
    number = F.col("first_page") + (F.col("page") - 1) * F.col("page_step")
    mark = F.when(F.contains("list_url", F.lit("?")), "&").otherwise("?")
    return out.withColumn("url", F.when(F.col("page") == 1, F.col("list_url")).otherwise(F.concat("list_url", mark, "param", F.lit("="), number.cast("string"))))


def json_listing(answers: DataFrame, spec: JsonSpec) -> DataFrame:
    """answers(source_key, page, body) to rows, by SQL functions alone. Only the named properties are kept; an
    answer without the rows, or whose code says no, is an error row. "None" and blanks are null."""
    v = F.try_parse_json("body")
    text = lambda at, path: F.nullif(F.nullif(F.trim(F.try_variant_get(at, f"$.{path}", "string")), F.lit("None")), F.lit(""))
    rows = F.try_variant_get(v, f"$.{spec.rows}", "array<variant>")
    error = F.when(v.isNull(), "not JSON").when(rows.isNull(), "no rows")
    if spec.code:
        error = error.when(~F.coalesce(F.try_variant_get(v, f"$.{spec.code}", "string").isin(list(spec.ok)), F.lit(False)), "the answer says no")
    out = answers.select("source_key", "page", error.alias("error"), F.posexplode_outer(F.when(error.isNull(), rows)).alias("pos", "row"))
    r = F.col("row")
    fields = [text(r, spec.identifier).alias("external_id"), text(r, spec.title).alias("title"), text(r, spec.date).alias("date_text"), (text(r, spec.body) if spec.body else F.lit(None).cast("string")).alias("body")]
    meta = F.map_filter(F.create_map(*[x for k in spec.keep for x in (F.lit(k), text(r, k))]), lambda k, x: x.isNotNull()) if spec.keep else F.lit(None).cast("map<string,string>")
    return out.select("source_key", "page", "pos", *fields, meta.alias("meta"), "error")
