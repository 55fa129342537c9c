"""Main-text extraction by tree scoring (operator 2).

A page becomes a tree of elements (unclosed and misnested tags repaired the way
browsers do for the usual cases; a head ends where something stands that no head holds).
Subtrees that cannot hold the article are cut: menus, headers, footers, sidebars, forms,
scripts, notices, adverts, reader comments, by their tag or the words of their class, id and
role. A form that holds more than half of the page's paragraph points is the page itself, as
server pages write it, and only its fields go. The same holds for a class that names both
the article and something beside it (``content with-sidebar``); reader comments go
however long they are. If nothing would be left, names alone cut no larger half.
Every paragraph gives points (one, plus its commas, plus one per 100 characters up
to three) to its parent, half of them to the grandparent, and a quarter of what the one
below got that way to each further ancestor. A container's points are discounted by its
link density. The best container is kept, and those siblings that score at least
a fifth of it or are paragraphs of plain text.

The work is one pass over each page; a page is parsed in time proportional to its
length, and only Spark's rows are partitioned: nothing is shuffled.

Defined cases: a null, empty or blank page has an empty text; a page without
paragraphs is taken as the text of its remaining body; character references are
decoded once; texts are whole; repeated rows each get their text; an empty table
gives an empty result; input columns named like an output are replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import slices, table, without

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# contents are not markup up to the end tag
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
CUT = frozenset("head script style noscript template svg math canvas iframe object embed nav footer aside form button"
                " select textarea input dialog menu audio video map title xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure"
                   " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td"
                   " tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCKS - frozenset("td th tr tbody thead tfoot caption dt dd li body html".split()) | {"li", "dt", "dd"}
# an opening tag that ends an open one of the same family, up to a boundary
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "tfoot": ({"tr", "td", "th", "tbody"}, {"table"})}
# words of a class, id or role that name a part beside the article
BESIDE = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie"
                   " cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup"
                   " sidebar aside widget widgets menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer"
                   " masthead toolbar share sharing social related recommended recommendations outbrain taboola comment"
                   " comments disqus respond replies reply complementary contentinfo search login tags skip".split())
ARTICLE = frozenset("article content entry main post story".split())
# of these, words that tell even beside a word for the article ...
PLAINLY = frozenset("sponsor sponsored promo promotion banner cookie cookies consent gdpr newsletter subscribe subscription signup"
                    " sidebar nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer masthead toolbar share sharing"
                    " social related recommended recommendations outbrain taboola advert adverts advertisement advertising adsense".split())
# ... and those that tell however much text there is
READERS = frozenset("comment comments disqus respond replies reply".split())
HEAD = frozenset("head title meta link style script base noscript template basefont bgsound".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "attrs", "items", "parent", "depth", "block", "points", "size", "linked", "length", "commas", "direct", "far")

    def __init__(self, tag: str, attrs: str, parent: "Node | None") -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items: list = []  # texts and nodes
        self.depth = parent.depth + 1 if parent else 0
        # depth of the nearest block, itself included, that inline end tags don't leave
        self.block = self.depth if tag in BLOCKS and tag != "p" else parent.block if parent else 0
        self.points, self.size, self.linked = 0.0, 0, 0
        self.length, self.commas, self.direct, self.far = 0, 0, 0.0, 0.0


class _Open:
    """The open elements: the innermost of a name is found without climbing."""

    def __init__(self, root: Node) -> None:
        self.root = self.now = root
        self.by_tag: dict[str, list[Node]] = {}

    def innermost(self, tags: Iterable[str]) -> Node | None:
        return max((self.by_tag[t][-1] for t in tags if self.by_tag.get(t)), key=lambda x: x.depth, default=None)

    def enter(self, node: Node) -> None:
        self.now = node
        self.by_tag.setdefault(node.tag, []).append(node)

    def leave(self, node: Node) -> None:
        """Close ``node`` and all that is open in it."""
        while self.now is not node.parent:
            self.by_tag[self.now.tag].pop()
            self.now = self.now.parent

    def close(self, tags: Iterable[str], stop: Iterable[str]) -> None:
        """Close the innermost of ``tags``, unless one of ``stop`` lies further in."""
        node, bound = self.innermost(tags), self.innermost(stop)
        if node is not None and (bound is None or node.depth > bound.depth):
            self.leave(node)


P_BOUNDS = ("div", "article", "section", "td", "th", "li", "blockquote", "button", "object", "main", "body")


def parse(page: str) -> Node:
    root = Node("html", "", None)
    opened, at, n = _Open(root), 0, len(page)

    def text(piece: str) -> None:
        if opened.now.tag == "head" and piece.strip():
            opened.leave(opened.now)
        opened.now.items.append(piece)

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(entities.unescape(page[at:]))
            break
        if lt > at:
            text(entities.unescape(page[at:lt]))
        m = _TAG.match(page, lt)
        if not m:  # a bare "<"
            text("<")
            at = lt + 1
            continue
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            node = opened.innermost((tag,))
            # inline end tags don't leave a block
            if node is not None and (tag in BLOCKS or node.depth > opened.now.block):
                opened.leave(node)
            continue
        if tag not in HEAD:
            opened.close(("head",), ())
        if tag in ("html", "body"):
            if tag == "body":
                body = Node("body", m[3], root)
                while opened.now is not root:
                    opened.leave(opened.now)
                root.items.append(body)
                opened.enter(body)
            continue
        if tag in CLOSES_P:
            opened.close(("p",), P_BOUNDS)
        if tag in IMPLIED:
            tags, stop = IMPLIED[tag]
            for _ in range(3):  # a cell, its row and its group may all be open
                opened.close(tags, stop)
        elif tag == "a" and (link := opened.innermost(("a",))) is not None and link.depth > opened.now.block:
            opened.leave(link)
        node = Node(tag, m[3], opened.now)
        opened.now.items.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            inner, at = page[at:end.start() if end else n], end.end() if end else n
            node.items.append(inner)
        elif tag not in VOID and not m[3].rstrip().endswith("/") or tag in BLOCKS and tag not in VOID:
            opened.enter(node)
    return root


def beside(node: Node, in_article: bool) -> str:
    """How a subtree's name or attributes say that it lies beside the article.

    ``cut``: surely; ``form``, ``mixed``: unless it holds most of the page; ``named``: by its
    class, id or role alone; empty: it doesn't.
    """
    if node.tag == "form":
        return "form"
    if node.tag in CUT or node.tag == "header" and not in_article:
        return "cut"
    if not node.attrs or node.tag in ("article", "main", "body", "html"):
        return ""
    found = ""
    for m in _ATTR.finditer(node.attrs):
        name = m[1].lower()
        value = (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "cut"
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "cut"
        if name in ("class", "id", "role"):
            words = set(_WORD.findall(value))
            if words & READERS:
                return "cut"
            if words & BESIDE:
                if not words & ARTICLE:
                    found = "named"
                elif words & PLAINLY:
                    found = found or "mixed"
    return found


def prune(root: Node, goes: Callable[[Node, str], bool]) -> None:
    """Cut the subtrees that ``goes`` (element, how it lies beside) says, without recursion."""
    todo = [(root, False)]
    while todo:
        one, inside = todo.pop()
        inside = inside or one.tag in ("article", "main")
        kept = []
        for item in one.items:
            if isinstance(item, str):
                kept.append(item)
            elif not goes(item, "cut" if item.tag in VOID and item.tag != "br" else beside(item, inside)):
                kept.append(item)
                todo.append((item, inside))
        one.items = kept


def prepared(page: str, names: bool = True) -> list[Node]:
    """The scored elements of a page, root first, less what lies beside the article.

    What surely does goes first; what holds most of the rest is no sidebar. Without ``names``
    this also goes for words of classes alone.
    """
    root = parse(page)
    prune(root, lambda x, how: how == "cut")
    score(root)
    given(root)
    most = lambda x: 2 * x.points > root.points > 0
    prune(root, lambda x, how: how in ("form", "mixed") and not most(x) or how == "named" and (names or not most(x)))
    return score(root)


def in_order(node: Node) -> list[Node]:
    """The elements of a tree, parents first."""
    out, todo = [], [node]
    while todo:
        one = todo.pop()
        out.append(one)
        todo.extend(x for x in reversed(one.items) if not isinstance(x, str))
    return out


def blocks(node: Node) -> list[str]:
    """The texts of the blocks of a tree, in page order, white space folded."""
    out: list[str] = []
    now: list[str] = []

    def cut() -> None:
        text = " ".join("".join(now).split())
        if text:
            out.append(text)
        now.clear()

    todo: list = [node]
    while todo:
        one = todo.pop()
        if one is None:
            cut()
        elif isinstance(one, str):
            now.append(one)
        elif one.tag == "br":
            now.append(" ")
        elif one.tag in BLOCKS:
            cut()
            todo.append(None)
            todo.extend(reversed(one.items))
        else:
            todo.extend(reversed(one.items))
    cut()
    return out


PARAGRAPHS = frozenset("p pre blockquote td li dd".split())


def score(root: Node) -> list[Node]:
    """Give points and sizes to all elements, in one pass; returns them, parents first.

    ``direct`` are the points of an element's own paragraphs, ``far`` what comes up from
    below; ``length`` and ``commas`` count the text that flows in it, inline elements included.
    """
    nodes = in_order(root)
    for node in nodes:
        node.size = node.linked = node.length = node.commas = 0
        node.direct = node.far = 0.0
    for node in reversed(nodes):  # children before parents
        own = 0
        for item in node.items:
            if isinstance(item, str):
                n = len(item.strip())
                own += n
                node.length += n
                node.commas += item.count(",")
            else:
                node.size += item.size
                node.linked += item.linked
                node.far += item.direct / 2 + item.far / 4
                if item.tag not in BLOCKS:
                    node.length += item.length
                    node.commas += item.commas
        node.size += own
        if node.tag == "a":
            node.linked = node.size
        node.points = node.direct + node.far
        if node.length and node.parent is not None and (node.tag in PARAGRAPHS or node.tag == "div" and own):
            plain = 1 - node.linked / node.size if node.size else 0
            node.parent.direct += (1 + node.commas + min(node.length / 100, 3)) * plain
    return nodes


def given(root: Node) -> None:
    """Sum up, in ``points``, all that the paragraphs of each subtree give."""
    for node in reversed(in_order(root)):
        node.points = node.direct + sum(x.points for x in node.items if not isinstance(x, str))


def density(node: Node) -> float:
    return node.linked / node.size if node.size else 0.0


def main_blocks(page: str) -> list[str]:
    """The article's blocks in page order."""
    if not page.strip():
        return []
    nodes = prepared(page)
    if not any(x.points for x in nodes):
        nodes = prepared(page, names=False)
    root = nodes[0]
    value = lambda x: x.points * (1 - density(x)) * (1.25 if x.tag in ("article", "main") else 1)
    best = max(nodes, key=value, default=root)
    if not best.points:  # no paragraph: an article without them, or all that is left
        best = next((x for x in nodes if x.tag in ("article", "main")), root)
        return blocks(best)
    # an article that holds nearly the same points is the container itself
    up = best.parent
    while up is not None:
        if up.tag in ("article", "main") and up.size <= 3 * max(1, best.size):
            best = up
        up = up.parent
    if best.parent is None or best.tag in ("article", "main", "body"):
        return blocks(best)
    bar, out = max(10.0, value(best) * 0.2), []
    for item in best.parent.items:
        if isinstance(item, str):
            if item.strip() and best.parent.tag not in ("html", "body"):
                out.append(" ".join(item.split()))
        elif item is best or value(item) >= bar or item.tag in HEADINGS or (
                item.tag == "p" and (item.size > 80 and density(item) < 0.25 or item.size and not item.linked)):
            out.extend(blocks(item))
    return out


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with text (blocks joined by two line feeds) and n_chars, without its html."""
    pages = without(pages, ("text", "n_chars"))
    rest = [c for c in pages.columns if c != html]
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = ["\n\n".join(main_blocks(x or "")) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                    names=["row", "text", "n_chars"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, text string, n_chars long").select("row.*", "text", "n_chars")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
