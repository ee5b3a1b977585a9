"""HTML rules over a small tree from the standard parser: text, structure, links, images, attachments, masked mail.

The tree is tolerant: unclosed elements end with their parent. All Spark functions take a column of
markup and are Arrow-batched; null markup has no text and empty lists.
"""

from __future__ import annotations

import bisect
import html as _html
import re
from html.parser import HTMLParser
from urllib.parse import parse_qs, unquote, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BREAKS = {"dl", "dt", "dd", "p", "div", "br", "tr", "td", "th", "li", "h1", "h2", "h3", "h4", "table"}
KEPT = {"href", "src", "alt", "colspan", "rowspan"}
DROPPED = {"script", "style", "noscript", "iframe"}
DECORATIVE = {"span", "font", "b", "i", "u", "em", "strong", "small", "center", "o:p"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: What a start tag ends by itself, up to the element that it can't reach past.
ENDS = {
    "p": ({"p"}, {"div", "td", "th", "li", "table", "body"}), "li": ({"li"}, {"ul", "ol"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
}
NOT_FILES = ("mailto:", "tel:", "sms:", "javascript:")
SCRIPTS = (".php", ".asp", ".aspx", ".jsp", ".do", ".cgi", ".html", ".htm")
FILE_NAME = re.compile(r"\.[A-Za-z0-9]{2,5}$")
FILE_SIZE = re.compile(r"\s*\(\s*[\d.,]+\s*(?:[KMGT]B?|B)\s*\)\s*$", re.I)
ELIDED = "data:elided"


class Node:
    """An element: tag, attributes, and children (elements and strings)."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def walk(self):  # noqa: ANN201
        """All elements below, in the order of the page; markup of any depth."""
        rest = [iter(self.children)]
        while rest:
            for child in rest[-1]:
                if isinstance(child, Node):
                    yield child
                    rest.append(iter(child.children))
                    break
            else:
                rest.pop()

    def visit(self, enter, leave):  # noqa: ANN001, ANN201
        """Calls enter(child) on each string and element below, which tells whether to go into it; leave(element) on going out."""
        rest = [(None, iter(self.children))]
        while rest:
            for child in rest[-1][1]:
                if enter(child) and isinstance(child, Node):
                    rest.append((child, iter(child.children)))
                    break
            else:
                done, _ = rest.pop()
                if done is not None:
                    leave(done)

    def text(self) -> str:
        """The text with one space for each run of white space; blocks stand apart."""
        out: list[str] = []

        def enter(child) -> bool:  # noqa: ANN001
            if isinstance(child, str):
                out.append(child)
            elif child.tag in BREAKS:
                out.append(" ")
            return isinstance(child, Node) and child.tag not in ("script", "style")

        self.visit(enter, lambda n: out.append(" ") if n.tag in BREAKS else None)
        return " ".join("".join(out).split())

    def select(self, selector: str) -> list[Node]:
        """Elements by tag, .class, #id, [attr], [attr*=value], descendants by spaces, alternatives by commas."""
        chains = [[_simple(s) for s in one.split()] for one in selector.split(",")]
        return [n for n in self.walk() if any(_matches(n, chain) for chain in chains)]

    def first(self, selector: str) -> Node | None:
        return next(iter(self.select(selector)), None)


def _simple(text: str):  # noqa: ANN202
    tag = re.match(r"[\w-]*", text)[0].lower()
    return tag, set(re.findall(r"\.([\w-]+)", re.sub(r"\[.*?\]", "", text))), re.findall(r"#([\w-]+)", text), re.findall(r"\[([\w-]+)(?:(\*?=)\"?([^\]\"]*)\"?)?\]", text)


def _is(node: Node, simple) -> bool:  # noqa: ANN001
    tag, classes, ids, attrs = simple
    if tag and node.tag != tag or not classes <= set(node.attrs.get("class", "").split()) or ids and node.attrs.get("id") not in ids:
        return False
    return all(a in node.attrs and (not op or (v in node.attrs[a] if op == "*=" else v == node.attrs[a])) for a, op, v in attrs)


def _matches(node: Node, chain: list) -> bool:
    if not _is(node, chain[-1]):
        return False
    rest, up = chain[:-1], node.parent
    while rest and up is not None:
        if _is(up, rest[-1]):
            rest = rest[:-1]
        up = up.parent
    return not rest


class _Builder(HTMLParser):
    """Keeps the open elements in a stack, and where in it each tag stands, so that no tag is looked for twice."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.open: list[Node] = []
        self.places: dict[str, list[int]] = {}

    def _close(self, depth: int) -> None:
        """Ends all elements from that place of the stack on."""
        while len(self.open) > depth:
            self.places[self.open.pop().tag].pop()
        self.at = self.open[-1] if self.open else self.root

    def handle_starttag(self, tag, attrs):  # noqa: ANN001, ANN201
        ends, within = ENDS.get(tag, (set(), set()))
        if ends:
            floor = max((self.places[w][-1] for w in within if self.places.get(w)), default=-1)
            depths = [at[bisect.bisect_right(at, floor)] for e in ends if (at := self.places.get(e)) and at[-1] > floor]
            if depths:
                self._close(min(depths))
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)
            self.at = node

    def handle_startendtag(self, tag, attrs):  # noqa: ANN001, ANN201
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):  # noqa: ANN001, ANN201
        if self.places.get(tag):
            self._close(self.places[tag][-1])

    def handle_data(self, data):  # noqa: ANN001, ANN201
        self.at.children.append(data)


def tree(markup: str | None) -> Node:
    builder = _Builder()
    builder.feed(markup or "")
    builder.close()
    return builder.root


def mail_of(code: str) -> str | None:
    """An address masked as hex: the first byte is the key of the others."""
    try:
        raw = bytes.fromhex(code)
    except ValueError:
        return None
    out = "".join(chr(b ^ raw[0]) for b in raw[1:])
    return out if "@" in out else None


def _unmasked(node: Node) -> str | None:
    return mail_of(node.attrs["data-cfemail"]) if "data-cfemail" in node.attrs else None


def text_of(node: Node) -> str:
    """Line feeds after block elements only; runs of spaces are one; at most one blank line together."""
    out: list[str] = []

    def enter(c) -> bool:  # noqa: ANN001
        if isinstance(c, str):
            out.append(c)
            return False
        if c.tag in ("script", "style"):
            return False
        shown = _unmasked(c)
        if shown is not None:
            out.append(shown)
            leave(c)
        return shown is None

    def leave(n: Node) -> None:
        if n.tag in BREAKS:
            out.append("\n")

    node.visit(enter, leave)
    lines = [re.sub("[ \t\u00a0]+", " ", x).strip() for x in "".join(out).split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def structure_of(node: Node) -> str:
    """Markup without comments, scripts and decoration, and with content attributes only; inline data is elided."""
    out: list[str] = []
    ends: list[str] = []

    def enter(c) -> bool:  # noqa: ANN001
        if isinstance(c, str):
            out.append(_html.escape(c, quote=False))
            return False
        if c.tag in DROPPED or c.tag == "head":
            return False
        shown = _unmasked(c)
        if shown is not None:
            out.append(_html.escape(shown, quote=False))
            return False
        attrs = {k: ELIDED if k == "src" and v.startswith("data:") else v for k, v in c.attrs.items() if k in KEPT}
        bare = c.tag in ("html", "body") or c.tag in DECORATIVE and not attrs
        if not bare:
            out.append(f"<{c.tag}" + "".join(f' {k}="{_html.escape(v)}"' for k, v in attrs.items()) + ("/>" if c.tag in VOID else ">"))
        ends.append("" if bare or c.tag in VOID else f"</{c.tag}>")
        return True

    node.visit(enter, lambda n: out.append(ends.pop()))
    return "".join(out).strip()


def absolute(base: str, href: str) -> str | None:
    try:
        return urljoin(base, href)
    except ValueError:
        return None


def images_of(node: Node, base: str) -> list[str]:
    found = (absolute(base, n.attrs["src"].strip()) for n in node.select("img") if n.attrs.get("src", "").strip())
    return [x for x in found if x is not None]


def _label(name: str) -> str:
    """A name as shown: one space for white space, and without the size behind it."""
    return FILE_SIZE.sub("", " ".join(name.split())).strip()


def file_name(text: str, title: str, href: str) -> str:
    """What a linked file is called: the first of these that there is.

    The link's text; its title, if it looks like a file's name; the end of the address's path, if it does and
    isn't a program's; a value of the query that does; the end of the path as it is; "unknown".
    """
    parts = urlsplit(href)
    tail = unquote(parts.path.rstrip("/").rpartition("/")[2])
    program = tail.lower().endswith(SCRIPTS)
    values = [unquote(v) for name in (parse_qs(parts.query) if parts.query else {}).values() for v in name[:1]]
    candidates = [_label(text), *filter(FILE_NAME.search, [_label(title), "" if program else tail, *values]), tail]
    return next(filter(None, candidates), "unknown")


def _viewed(href: str) -> str:
    """The image behind the address of an image viewer; any other address as it is."""
    if "view_image.php" not in href.lower():
        return href
    query = {k: v[0] for k, v in parse_qs(urlsplit(href).query).items()}
    name, board = query.get("fn", ""), query.get("bo_table", "")
    if name.startswith("/"):
        return name
    return f"/data/file/{board}/{name}" if name and board else href


def attachments_of(node: Node, base: str) -> list[tuple[str, str]]:
    """(name, address) of each link that leads away from the page to something that can be fetched."""
    anchors = [(a, a.attrs["href"].strip()) for a in node.select("a[href]")]
    away = [(a, href) for a, href in anchors if href and href[0] != "#" and not href.lower().startswith(NOT_FILES) and absolute(base, href) is not None]
    found = [(file_name(a.text(), a.attrs.get("title", ""), href), absolute(base, _viewed(href))) for a, href in away]
    return [(name, url) for name, url in found if url is not None]


def normalized_text(c: Column) -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: text_of(tree(p)))

    return run(c)


def structural_html(c: Column) -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: structure_of(tree(p)))

    return run(c)


def links(c: Column, base: Column) -> Column:
    """struct<images array<string>, attachments array<struct<name, url>>>"""

    @F.pandas_udf("images array<string>, attachments array<struct<name:string,url:string>>")
    def run(pages: pd.Series, bases: pd.Series) -> pd.DataFrame:
        out = []
        for p, b in zip(pages, bases):
            root = tree(p)
            out.append((images_of(root, b or ""), [{"name": n, "url": u} for n, u in attachments_of(root, b or "")]))
        return pd.DataFrame(out, columns=["images", "attachments"])

    return run(c, base)


def unmasked(c: Column) -> Column:
    """A masked address in SQL functions: hex digits, each byte XORed with the first; null if there is no @ in it."""
    n = F.floor(F.length(c) / 2)
    byte = lambda i: F.conv(F.substring(c, (i * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")
    shown = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.chr(byte(i).bitwiseXOR(byte(F.lit(0))))), "")
    return F.when(c.rlike("^([0-9A-Fa-f]{2}){2,}$") & F.contains(shown, F.lit("@")), shown)
