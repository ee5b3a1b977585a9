"""HTML extraction: fixed pages with known main text."""

import html
import os
import re
import time

import numpy as np
import pytest

from seatflow.llm import pages
from seatflow.llm.trees import classified


@pytest.fixture(scope="module")
def tree():
    return pages.learned()


def text(n, start=0):
    return " ".join(f"word{i}" for i in range(start, start + n)) + "."


P1, P2, P3 = text(40), text(25, 100), text(60, 300)
NAV = "<nav><ul>" + "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(6)) + "</ul></nav>"

CASES = {
    "article": (f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>'</script></head><body>{NAV}<div class=ad>Buy now and save a lot of money.</div><article><h1>My title</h1><p>{P1}</p><p>{P2}</p></article><footer>&copy; me, some words here.</footer></body></html>", f"My title\n{P1}\n{P2}"),
    "unclosed": (f"<body><article><h1>Head</h1><p><b>Lead.<br><p>{P1}<p>{P2}</article>", f"Head\nLead.\n{P1}\n{P2}"),
    "comments": (f"<article><h2>Head</h2><p>{P1}</p></article><section id=comments><h3>3 comments</h3><div class=comment><p>{P2}</p></div><div class=comment><p>{P3}</p></div></section>", f"Head\n{P1}"),
    "comments inside": (f"<main><article><p>{P1}</p><p>{P2}</p><div class='comment-list'><p>{P3}</p></div></article></main>", f"{P1}\n{P2}"),
    "sidebar": (f"<div id=main><h1>Head</h1><p>{P1}</p></div><aside><p>{P2}</p></aside><div class='sidebar'><p>{P3}</p></div>", f"Head\n{P1}"),
    "cookie notice": (f"<div class='cookie-notice'>{P2}</div><article><p>{P1}</p></article>", P1),
    "form": (f"<article><p>{P1}</p><form><label>Name</label><input><p>{P2}</p><textarea>x</textarea><button>Send</button></form></article>", P1),
    "entities and spaces": ("<article><p>A &amp; B &lt;c&gt; caf&eacute;&nbsp;&#8212;  two\n\tlines " + P1 + "</p></article>", "A & B <c> café — two lines " + P1),
    "links in text": (f"<article><p>{P1} see <a href=/x>this page</a> and <a href=/y>that</a>.</p><ul><li>One point</li><li><a href=/z>Linked point</a></li></ul></article>", f"{P1} see this page and that.\nOne point\nLinked point"),
    "no hints": (f"<body><table><tr><td><a href=/1>Home</a></td><td><a href=/2>News</a></td></tr></table><div>{P1}</div><div>{P3}</div><p><a href=/a>Terms</a> <a href=/b>Privacy</a></p></body>", f"{P1}\n{P3}"),
    "header in article": (f"<header><h1>Site</h1></header><article><header><h1>Head</h1></header><p>{P1}</p><footer>Filed under x</footer></article>", f"Head\n{P1}"),
    "hidden and comments of markup": (f"<article><!-- <p>no</p> --><p>{P1}</p><p style='display:none'>secret words</p><p hidden>more</p></article>", P1),
    "nothing": ("<html><body></body></html>", ""),
    "plain": (P3, P3),
    "role": (f"<div role=navigation><p>{P2}</p></div><div role=main><p>{P1}</p></div>", P1),
    "stray quote in a value": (f"<article><p title='Bob's page'>{P1}</p><p>They don't and won't.</p><p>{P2}</p></article>", f"{P1}\nThey don't and won't.\n{P2}"),
    "quote in a bare value": (f"<article><p title=it's>{P1}</p><p>{P2}</p></article>", f"{P1}\n{P2}"),
    "stray quotes between attributes": (f"<article><p \" class=x'>{P1}</p><p>{P2}</p></article>", f"{P1}\n{P2}"),
    "attribute with a sign": (f"<article><p title='a > b'>{P1}</p></article>", P1),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name, tree):
    page, want = CASES[name]
    assert pages.main_text(page, tree) == want


def article_of(page):
    """A generated page's main text, by its article tag."""
    inner = re.search("<article>(.*)</article>", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(p for p in parts if p)


def all_pages(sf):
    path = f"/root/testdata/{sf}/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("no tables")
    return path


def test_pages_of_the_table(spark, tree):
    """On the generated pages, the article's blocks and nothing else."""
    rows = pages.extracted(spark.read.parquet(all_pages("sf0.01"))).collect()
    assert rows and all(r["text"] == article_of(r["html"]) for r in rows)


def test_pages_without_hints(tree):
    """Tags, classes and ids say nothing here: word counts and link densities alone find the article's blocks with F1 0.95 at least."""
    import pyarrow.parquet as pq

    hit = wrong = missed = 0
    for page in pq.read_table(all_pages("sf0.01"), columns=["html"]).column("html").to_pylist():
        found = pages.blocks(page)
        truth = np.array([bool(b.article) for b in found])
        chosen = pages.chosen([b._replace(article=0, furniture=0) for b in found], tree)
        hit, wrong, missed = hit + (chosen & truth).sum(), wrong + (chosen & ~truth).sum(), missed + (~chosen & truth).sum()
    assert 2 * hit / (2 * hit + wrong + missed) >= 0.95


def test_link_lists_are_no_text_in_an_article(tree):
    """A list of links isn't text, whatever its class says."""
    menu = "".join(f"<li><a href=/{i}>x{i}</a></li>" for i in range(9))
    assert pages.main_text(f"<ul class=article>{menu}</ul><div class=article><p>{P1}</p><p>{P3}</p></div>", tree) == f"{P1}\n{P3}"


def test_the_tree_decides(tree):
    """A tree of one leaf, all or nothing, has another outcome on every page that has furniture, or text."""
    import pyarrow.parquet as pq

    blocks = differ_all = differ_none = 0
    for page in pq.read_table(all_pages("sf0.01"), columns=["html"]).column("html").to_pylist():
        found = pages.blocks(page)
        chosen = pages.chosen(found, tree)
        blocks += len(found)
        for share, n in ((1.0, "all"), (0.0, "none")):
            leaf = classified(np.zeros((4, 8)), np.full(4, share), depth=1, least=1.0)
            other = pages.chosen(found, leaf)
            assert other.all() if n == "all" else not other.any()
            if n == "all":
                differ_all += int((other != chosen).sum())
            else:
                differ_none += int((other != chosen).sum())
    assert differ_all + differ_none == blocks and min(differ_all, differ_none) > blocks / 10


@pytest.mark.parametrize("page", ["<div>" * 100_000, "<div>" * 50_000 + "</p>" * 50_000, "<b>" * 50_000 + "<td></td>" * 50_000, "<a href='x" * 30_000, '<p title="x ' * 30_000, "<i>" * 50_000 + "</b>" * 50_000])
def test_odd_markup_takes_linear_time(tree, page):
    began = time.process_time()
    pages.main_text(page + "<p>" + P1, tree)
    assert time.process_time() - began < 3


def test_edges(spark):
    rows = spark.createDataFrame([(1, None, "clash"), (2, "", "clash"), (3, "<" * 2000, "x"), (4, "<p" * 3000, None), (5, "<div>" * 3000 + P1, "y")], "page_id long, html string, text string")
    got = {r["page_id"]: r["text"] for r in pages.extracted(rows).collect()}
    assert got[1] == got[2] == "" and got[5] == P1 and len(got) == 5
    assert pages.extracted(rows.limit(0)).collect() == []
