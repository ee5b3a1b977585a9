"""HTML extraction: flat text blocks, classified by a decision tree on word counts and link density of neighbours.

Block tags cut a page into a flat list of text blocks; inline tags and line breaks don't. Each block
has its number of words, the share of them inside links, and the same of the block before and after. Paragraphs
and readers' comments look alike by these numbers, so two more tell what the markup around the block
says, if anything: whether an element that encloses it is of the article kind, or of the furniture kind (by
tag, role, class or id). A tree learned from the small labelled table below decides on all blocks, by all
of these; nothing overrules it.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatflow.llm.common import lean
from seatflow.llm.trees import Tree, classified, walk

# Kinds of HTML elements.
BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th "
    "thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style noscript template iframe object svg math canvas audio video textarea select option button head title".split())
RAW = set("script style textarea title noscript iframe".split())
FURNITURE_TAGS = set("nav footer aside form header menu dialog".split())
ARTICLE_TAGS = set("article main".split())
ROLES = {"navigation": -1, "banner": -1, "contentinfo": -1, "complementary": -1, "search": -1, "dialog": -1, "alert": -1, "form": -1, "main": 1, "article": 1}
FURNITURE = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "footer foot header masthead topbar sidebar aside related recommended recommendations comment comments commentlist reply replies respond disqus "
    "share sharing social cookie cookies consent notice notification alert popup modal overlay newsletter subscribe subscription signup login search form "
    "widget pagination pager copyright legal disclaimer tags toc tooltip hidden teaser trending widgets reader".split()
)
ARTICLE = set("article articlebody content entry post story body main maincontent".split())

#: A quote opens a value only after an equals sign.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
PARTS = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    article: int
    furniture: int


#: The labelled table, by hand: the blocks of some pages in order, each with its words and + if it is of the main text, - if not.
#: L: all its words are links; a share of linked words stands after a stroke. learned() makes the tree's rows of it.
LABELLED = """
    1L 2L 1L 1L 9- 7+ 60+ 35+ 90+ 12-           1L 1L 1L 1L 1L 6- 12+ 80+ 5+ 30+ 14-        2L 1L 1L 11- 5+ 9+ 50+ 3+ 25+ 16-
    1L 1L 1L 8- 9+ 25+ 8+ 40+ 2+ 13-            1L 2L 1L 13- 10+ 14+ 120+ 9-                1L 1L 4- 3+ 40+ 15+ 6+ 11-
    1L 1L 1L 1L 10- 15+ 3+ 200+ 1+ 45+ 10-      1L 1L 7- 14+ 60+ 2+ 12-                     1L 1L 5- 9+ 22+ 4+ 4+ 15-
    2L 1L 1L 12- 8+ 300+ 12+ 90+ 14-            1L 2L 1L 8+ 55+ 40+ 70+ 1L 2L 2L            1L 1L 6+ 80+ 25+ 2L 2L
    1L 1L 1L 5+ 30+ 20+ 60+ 9-                  1L 1L 9+ 12+ 40+ 1L                         1L 1L 40+ 60+ 2L
    2L 90/0.1+ 50+ 70+                          9+ 100+ 60+ 35+                             8+ 55+ 9+
    12+ 40+                                     20+ 8+ 45+ 5+                               60+ 9+ 2+
    60+         25+         250+         3+     12/0.1+                                     1L 1L 8- 9+ 60+ 45+ 2- 9L 12L 8L 10L 14-
    1L 1L 9- 7+ 60+ 80+ 3- 35- 4- 25- 60- 10-   8+ 50+ 70+ 2- 9- 90- 30- 5-                 1L 1L 12- 6+ 45+ 120+ 2- 250- 60- 40- 13-
    1L 1L 7+ 70+ 40+ 30- 1L 1L 1L 11-           5- 2L 2L 2L 30- 8+ 60+ 90+ 12-              1L 1L 7+ 40+ 1- 25- 1- 12-
    7+ 40+ 2+ 2/1+ 9/1+ 30+                     6+ 60+ 35/0.3+ 6/0.5+ 30+                   25- 1L 1L 6+ 50+ 70+ 10-
    9+ 30+ 2+ 3/1+                              8+ 1/1+                                     1L 1L 2L 3+
"""


def labelled_rows() -> tuple[np.ndarray, np.ndarray]:
    """The labelled table as features and labels, in three markups: one that says nothing, furniture, and an article.

    What stands in furniture isn't main text, whatever it looks like. What stands in an article is, but for lists of links.
    """
    rows, labels = [], []
    for page in re.split(r"\s{2,}", LABELLED.strip()):
        found, said = [], []
        for block in page.split():
            words, share = re.match(r"(\d+)(?:/([\d.]+))?", block).groups()
            linked = float(share or (block[-1] == "L"))
            found.append(Block("", int(words), round(int(words) * linked), 0, 0))
            said.append(block[-1])
        text, links = np.array([x == "+" for x in said]), np.array([x == "L" for x in said])
        for article, furniture, label in ((0, 0, text), (0, 1, np.zeros(len(said), bool)), (1, 1, np.zeros(len(said), bool)), (1, 0, ~links)):
            rows.append(features([b._replace(article=article, furniture=furniture) for b in found]))
            labels.append(label.astype(float))
    return np.concatenate(rows), np.concatenate(labels)


def learned() -> Tree:
    return classified(*labelled_rows(), depth=7, least=6.0)


def _kind(tag: str, attributes: str, in_article: bool) -> int:
    """1 for an element of the article kind, -1 for furniture, -2 for one that isn't shown, 0 else."""
    if tag in UNSEEN:
        return -2
    kind = 1 if tag in ARTICLE_TAGS else -1 if tag in FURNITURE_TAGS and not (tag == "header" and in_article) else 0
    if attributes.strip(" /"):
        for name, *value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(value)
            if name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)) or (name == "aria-hidden" and value.lower() == "true"):
                return -2
            if name == "role" and value.lower() in ROLES and kind >= 0:
                kind = ROLES[value.lower()]
            elif name in ("class", "id") and tag not in ("html", "body"):
                words = {w.lower() for w in PARTS.split(value) if w}
                if words & FURNITURE and not (tag in ARTICLE_TAGS or (tag[0] == "h" and tag[1:].isdigit())):
                    kind = -1
                elif words & ARTICLE and kind == 0:
                    kind = 1
    return kind


def blocks(page: str | None) -> list[Block]:
    """The page's text blocks in order. Unclosed and stray tags are tolerated; white space inside a block is one space."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []
    pieces: list[str] = []
    link: list[str] = []
    counts = {1: 0, -1: 0, -2: 0, "a": 0}
    opened: dict[str, list[int]] = {}  # where in the stack each tag stands
    solid: list[int] = []  # where in the stack the block elements stand

    def close() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            linked = len(html.unescape("".join(link)).split())
            out.append(Block(text, len(text.split()), linked, int(counts[1] > 0), int(counts[-1] > 0)))
        pieces.clear()
        link.clear()

    def say(text: str) -> None:
        if text and not counts[-2]:
            pieces.append(text)
            if counts["a"]:
                link.append(text)

    def pop() -> None:
        tag, kind = stack.pop()
        opened[tag].pop()
        if tag in BLOCKS:
            solid.pop()
        if kind:
            counts[kind] -= 1
        if tag == "a":
            counts["a"] -= 1

    at = 0
    while True:
        match = TOKEN.search(page, at)
        if not match:
            say(page[at:])
            break
        say(page[at : match.start()])
        at = match.end()
        if match[0].startswith("<![CDATA["):
            continue
        if not match[1]:
            continue
        tag, attributes = match[1].lower(), match[2] or ""
        if match[0][1] == "/":
            if tag in BLOCKS:
                close()
            elif tag == "a":
                link.append(" ")
            depth = opened[tag][-1] if opened.get(tag) else None
            # an inline end tag doesn't reach past the block that it is in
            if depth is not None and (tag in BLOCKS or not solid or solid[-1] < depth):
                while len(stack) > depth:
                    pop()
            continue
        if tag in BLOCKS:
            close()
            if tag in ("p", "li", "dd", "dt", "td", "th", "tr", "option") or (tag[0] == "h" and tag[1:].isdigit()):
                # these end an open paragraph or a like element by themselves
                ended = {"p"} | ({tag} if tag in ("li", "option", "tr") else {"dd", "dt"} if tag in ("dd", "dt") else {"td", "th"} if tag in ("td", "th") else set())
                if solid and stack[solid[-1]][0] in ended:
                    depth = solid[-1]
                    while len(stack) > depth:
                        pop()
        if tag == "br":
            say(" ")
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in RAW and tag not in BLOCKS:
            continue
        kind = _kind(tag, attributes, counts[1] > 0)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        opened.setdefault(tag, []).append(len(stack))
        if tag in BLOCKS:
            solid.append(len(stack))
        stack.append((tag, kind))
        if kind:
            counts[kind] += 1
        if tag == "a":
            counts["a"] += 1
    close()
    return out


def features(found: list[Block]) -> np.ndarray:
    """Per block the columns of the labelled table: words and link density of the block before, its own and the next one's, and its markup's two hints."""
    words = np.array([0, *[b.words for b in found], 0], dtype=float)
    density = np.array([0, *[b.linked / b.words for b in found], 0], dtype=float)
    article, furniture = (np.array([getattr(b, k) for b in found], dtype=bool) for k in ("article", "furniture"))
    if (article & ~furniture).any():  # the page marks its article, so what stands outside is hinted too
        furniture = furniture | ~article
    return np.stack([words[:-2], density[:-2], words[1:-1], density[1:-1], words[2:], density[2:], article.astype(float), furniture.astype(float)], axis=1)


def chosen(found: list[Block], tree: Tree) -> np.ndarray:
    """Whether each block is of the main text."""
    return walk(tree, features(found)) >= 0.5


def main_text(page: str | None, tree: Tree) -> str:
    """The blocks that are chosen, joined by line feeds."""
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(b.text for b, c in zip(found, chosen(found, tree)) if c)


def extracted(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """Adds the main text of each page as `out`; a column of that name is replaced.

    Null and empty pages, and pages without text, have the empty text. Repeated rows are read alike,
    pages of any length whole, and an empty table gives an empty result.
    """
    tree = learned()

    @F.pandas_udf("string")
    def text(htmls: pd.Series) -> pd.Series:
        return htmls.map(lambda h: main_text(h, tree))

    return lean(pages).withColumn(out, text(F.col(html_col)))
