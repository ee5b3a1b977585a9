"""The HTML queries over whole tables against plain loops over the markup's text."""

import html
import os
import re
import time
from urllib.parse import urljoin

import pyarrow.parquet as pq
import pytest

from seatflow.functions import html as H
from seatflow.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
ENDS = "dl dt dd p div br tr td th li h1 h2 h3 h4 table".split()


@pytest.fixture(scope="module")
def pages():
    if not os.path.exists(FOLDER):
        pytest.skip("no tables")
    return {r["page_id"]: r for r in pq.read_table(f"{FOLDER}/pages.parquet").to_pylist()}


def pieces(markup):
    """Tags and texts in order, without comments and what scripts and styles hold."""
    bare = re.sub(r"<!--.*?-->|<!DOCTYPE[^>]*>|<(script|style)\b.*?</\1>", "", markup, flags=re.S)
    return re.findall(r"<(/?)([a-z0-9]+)[^>]*>|([^<]+)", bare)


def plain_text(markup):
    """An end tag of a block is a line feed, and so is a paragraph's start tag while another is open."""
    out, open_p = [], False
    for end, tag, text in pieces(markup):
        if text:
            out.append(html.unescape(text))
        elif tag == "br" or (end and tag in ENDS and (tag != "p" or open_p)) or (tag == "p" and not end and open_p):
            out.append("\n")
        if tag == "p":
            open_p = not end
        elif end and tag not in ("b", "a", "i", "em", "strong", "span"):
            if open_p and tag in ("article", "div", "body", "td", "li"):
                out.append("\n")
            open_p = False
    lines = [re.sub("[ \t ]+", " ", x).strip() for x in "".join(out).split("\n")]
    return "\n".join(x for x in lines if x)


def test_text_of_all_pages(spark, pages):
    got = {r["page_id"]: r["text"] for r in QUERIES["html_text"](spark, FOLDER).collect()}
    assert len(got) == len(pages) > 20
    for i, r in pages.items():
        assert re.sub(r"\n+", "\n", got[i]) == plain_text(r["html"])


def test_structure_of_all_pages(spark, pages):
    got = {r["page_id"]: r["markup"] for r in QUERIES["html_structure"](spark, FOLDER).collect()}
    for i, r in pages.items():
        body = re.sub(r"<head>.*?</head>", "", r["html"], flags=re.S)
        want = [(tag, html.unescape(text)) for end, tag, text in pieces(body) if (text or not end) and tag not in H.DECORATIVE | {"html", "body"}]
        have = [(tag, html.unescape(text)) for end, tag, text in pieces(got[i]) if text or not end]
        assert [x for x, _ in have if x] == [x for x, _ in want if x] and "".join(t for _, t in have) == "".join(t for _, t in want).strip()
        assert not re.search(r"<[^>]+\s(class|style|id|charset|lang)=", got[i]) and re.findall('href="([^"]*)"', got[i]) == re.findall('href="([^"]*)"', body)


def test_links_of_all_pages(spark, pages):
    got = {r["page_id"]: r for r in QUERIES["html_links"](spark, FOLDER).collect()}
    for i, r in pages.items():
        bare = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>", "", r["html"], flags=re.S)
        links = re.findall(r'<a href="([^"]+)">([^<]*)</a>', bare)
        assert [(x["name"], x["url"]) for x in got[i]["attachments"]] == [(" ".join(html.unescape(t).split()), urljoin(r["url"], html.unescape(h))) for h, t in links]
        assert got[i]["images"] == [urljoin(r["url"], html.unescape(s)) for s in re.findall(r'<img[^>]*src="([^"]+)"', bare)]


@pytest.mark.parametrize("page", ["<div>" * 50_000 + "</p>" * 50_000, "<div>" * 100_000, "<p>x" * 100_000, "<span>" * 50_000 + "<p>y" * 50_000, "<ul>" * 30_000 + "<li>z" * 60_000, "<i>" * 50_000 + "</b>" * 50_000])
def test_odd_markup_takes_linear_time(page):
    began = time.process_time()
    H.tree(page)
    assert time.process_time() - began < 4


def test_what_a_start_tag_ends():
    """The outermost like element goes, up to the one that it can't reach past."""
    shape = lambda n: [n.tag, *[shape(c) if isinstance(c, H.Node) else c for c in n.children]]
    assert shape(H.tree("<ul><li>a<b>x<li>b<ul><li>c</ul>d</ul>")) == ["", ["ul", ["li", "a", ["b", "x"]], ["li", "b", ["ul", ["li", "c"]], "d"]]]
    assert shape(H.tree("<table><tr><td>1<td>2<tr><th>3<table><tr><td>4</table></table>")) == ["", ["table", ["tr", ["td", "1"], ["td", "2"]], ["tr", ["th", "3", ["table", ["tr", ["td", "4"]]]]]]]
    assert shape(H.tree("<p>a<div>b<p>c<p>d</div>e")) == ["", ["p", "a", ["div", "b", ["p", "c"], ["p", "d"]], "e"]]
    assert shape(H.tree("<div>a</p></x>b</div></div>c")) == ["", ["div", "a", "b"], "c"]
