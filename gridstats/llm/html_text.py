"""Main text of web pages by composite text density.

A page becomes a tree (a forgiving parser: a new paragraph closes an open one, stray end tags are
ignored). Elements that by their name hold menus, headers, footers, forms or code are cut. So are
those with a class, id or role for menus, sidebars, notices, adverts or comments: a whole token of
such words ("ad", "site-footer"; not "no-sidebar" or "article-header"). But a marked element with
most of the page's text outside links stays, unless it holds comments or an article lies outside
marked elements; densities decide about it. Every node left gets its link-adjusted
characters per tag; a node's sum is that of its children. The node with the largest sum is the heart
of the article, and the smallest density on the path from the body to it is the threshold. The choice
climbs from the heart towards the body, past siblings that are text; it stops at one that is mostly
links and below the threshold. Below the body each sibling is judged alone: one that is mostly links
stays out; headings, paragraphs, lists, quotes, tables and the like come in; other elements come in
if they hold such elements and reach ``BESIDE`` of the threshold, or are bare text with as
large a share of the chosen subtree's characters per tag.
An article or main element on the path is taken as the whole.

Pages are independent: nothing is shuffled, and a task holds one batch of pages at a time.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from .common import put_back, set_aside, whole_text

# Element names.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav"
    " ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CUT = frozenset(
    "head script style noscript template nav header footer aside form button select option textarea"
    " input iframe object svg canvas menu dialog audio video title".split()
)
# What can stand in a head, whose end tag may be left out.
HEAD = frozenset(
    "base basefont bgsound head html link meta noframes noscript script style template title".split()
)
# Words in a class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion popup"
    " modal overlay cookie cookies consent gdpr notice notices alert newsletter subscribe signup"
    " login menu nav navbar navigation breadcrumb breadcrumbs pager pagination sidebar aside widget"
    " footer header masthead toolbar share sharing social related recommended comment comments"
    " commentlist reply replies respond disqus discussion search contentinfo complementary form"
    " copyright disclaimer".split()
)
# Words that say where in a page something is, or how much, beside a mark.
PLACES = frozenset(
    "site page global main primary secondary top bottom left right upper lower mobile desktop list"
    " area box bar block section container wrapper wrap inner outer item items link links button"
    " buttons icons unit slot side".split()
)
# Marks of what readers wrote.
TALK = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
_ATTRIBUTES = ("class", "id", "role")
_MAIN = ("html", "body", "article", "main")
_ROOTS = ("#root", "html", "body")
_CONTENT = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hgroup details article main".split()
)
BESIDE = 0.25  # share that is asked of what lies beside the chosen subtree
_PIECE = re.compile(r"[A-Za-z]+")


class Node:
    __slots__ = ("name", "marks", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "parent")

    def __init__(self, name: str, parent: Node | None):
        self.name, self.parent = name, parent
        self.marks: frozenset | set = frozenset()
        self.children: list[Node | str] = []


class _Tree(HTMLParser):
    """Builds the tree without what is cut."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", None)
        self.cut: list[str] = []  # open elements from the outermost cut one down
        self.marked: list[Node] = []
        self.names: Counter[str] = Counter()  # of the open elements

    def handle_starttag(self, tag, attrs):
        if self.cut and self.cut[0] == "p" and tag in BLOCKS:
            self.cut.clear()  # a block ends an open paragraph, a cut one as well
        if self.cut == ["head"] and tag not in HEAD or tag == "body" and self._in_head():
            self.cut.clear()  # what cannot stand in a head ends it
        if self.cut:
            if tag not in EMPTY:
                self.cut.append(tag)
            return
        if tag in BLOCKS:
            self._close_paragraph()
        if tag in CUT or tag not in _MAIN and any(k == "hidden" for k, _ in attrs):
            if tag not in EMPTY:
                self.cut.append(tag)
            return
        node = Node(tag, self.at)
        node.marks = self._marks(tag, attrs)
        if node.marks:
            self.marked.append(node)
        self.at.children.append(node)
        if tag not in EMPTY:
            self.at = node
            self.names[tag] += 1

    def handle_startendtag(self, tag, attrs):
        if tag in EMPTY:
            self.handle_starttag(tag, attrs)
        else:  # a slash does not close an HTML element
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in ("body", "html") and self._in_head():
            self.cut.clear()
        if self.cut:
            if tag in self.cut:
                while self.cut.pop() != tag:
                    pass
            elif self._open(tag) is not None and tag in BLOCKS:
                self.cut.clear()  # an element around the cut one ends, so the cut one was not closed
                self.handle_endtag(tag)
            return
        node = self._open(tag)
        if node is not None:
            self._leave(node)

    def _leave(self, node: Node) -> None:
        """Close an open element, and those in it."""
        while self.at is not node.parent:
            self.names[self.at.name] -= 1
            self.at = self.at.parent

    def handle_data(self, data):
        if self.cut == ["head"] and not data.isspace():
            self.cut.clear()
        if not self.cut and data:
            self.at.children.append(data)

    def _in_head(self) -> bool:
        return bool(self.cut) and self.cut[0] == "head" and "template" not in self.cut

    @staticmethod
    def _marks(tag, attrs) -> set:
        """The marks among the whole tokens of class, id and role."""
        if tag in _MAIN:
            return set()
        found = set()
        for token in " ".join(v for k, v in attrs if k in _ATTRIBUTES and v).split():
            pieces = {w.lower() for w in _PIECE.findall(token) if len(w) > 1}
            if pieces <= MARKS | PLACES:
                found |= pieces & MARKS
        return found

    def _open(self, tag) -> Node | None:
        if not self.names[tag]:
            return None
        node = self.at
        while node is not None and node.name != tag:
            node = node.parent
        return node

    def _close_paragraph(self):
        if not self.names["p"]:
            return
        node = self.at
        while node is not None and node.name not in BLOCKS:
            node = node.parent
        if node is not None and node.name == "p":
            self._leave(node)


def _post_order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node)]
    return order[::-1]


def cut_marked(root: Node, marked: list[Node]) -> None:
    """Take out marked elements, but for those that hold most of the text outside links."""
    order = _post_order(root)
    plain: dict[Node, int] = {}
    for node in order:
        inner = [c for c in node.children if isinstance(c, Node)]
        text = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        plain[node] = 0 if node.name == "a" else text + sum(plain[c] for c in inner)
    total, inside = plain[root], set()
    for node in reversed(order):  # parents come first
        if node.marks or node.parent in inside:
            inside.add(node)
    article = any(n.name in ("article", "main") and plain[n] and n not in inside for n in order)
    gone = set()
    for node in marked:
        least = total if article or node.marks & TALK else total // 2 + 1
        if plain[node] < least or not total:
            gone.add(node)
    for parent in {n.parent for n in gone}:
        parent.children = [c for c in parent.children if c not in gone]


def measure(root: Node) -> None:
    """Characters, tags, link characters and link tags of every node, then densities and sums."""
    order = _post_order(root)
    for node in order:
        inner = [c for c in node.children if isinstance(c, Node)]
        text = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars = text + sum(c.chars for c in inner)
        node.tags = sum(c.tags + 1 for c in inner)
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
        else:
            node.link_chars = sum(c.link_chars for c in inner)
            node.link_tags = sum(c.link_tags + (c.name == "a") for c in inner)
    rate = root.link_chars / root.chars if root.chars else 0.0
    for node in order:
        chars, tags = node.chars, max(1, node.tags)
        linked, links = max(1, node.link_chars), max(1, node.link_tags)
        plain = max(1, chars - node.link_chars)
        base = math.log(chars / plain * node.link_chars + rate * chars + math.e)
        ratio = max(1.0, chars / linked * tags / links)
        node.density = chars / tags * math.log(ratio) / math.log(base) if base > 1 else chars / tags * math.log(ratio + 1)
        own = any(isinstance(c, str) and not c.isspace() for c in node.children)
        inner = sum(c.density for c in node.children if isinstance(c, Node))
        node.total = inner if not own else max(inner, node.density)


def article_of(root: Node) -> Node:
    """The subtree with the largest density sum, with what belongs to it (the module says what)."""
    best = max(reversed(_post_order(root)), key=lambda n: n.total)
    if best.name in _ROOTS:
        return best
    path = [best]
    while path[-1].parent is not None and path[-1].parent.name != "#root":
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    named = [n for n in path if n.name in ("article", "main")]
    for node in path[1:]:
        beside = [c for c in node.children if isinstance(c, Node) and c is not best and c.chars]
        if node.name in _ROOTS:
            return best if named else _with_siblings(node, best, threshold)
        if any(c.density < threshold and _linked(c) for c in beside):
            return best
        best = node
    return best if named or best.parent is None else _with_siblings(best.parent, best, threshold)


def _linked(node: Node) -> bool:
    return 2 * node.link_chars > node.chars


def _with_siblings(parent: Node, best: Node, threshold: float) -> Node:
    """The chosen child of a body and the children that belong to it; the body if all do."""

    def belongs(child: Node) -> bool:
        if child is best or not child.chars:
            return True
        if _linked(child):
            return False
        if child.name in _CONTENT:
            return True
        if any(n.name in _CONTENT and n.chars for n in _post_order(child)):
            return child.density >= BESIDE * threshold
        # the density of a short text without links is high; its characters per tag are not
        return child.chars * best.tags >= BESIDE * best.chars * max(1, child.tags)

    kept = [c for c in parent.children if isinstance(c, str) or belongs(c)]
    if len(kept) == len(parent.children):
        return parent
    whole = Node("#root", None)
    whole.children = [c for c in kept if isinstance(c, Node)]
    return whole


def blocks_of(root: Node) -> Iterator[str]:
    """Text of each block in page order; inline elements and line breaks stay inside a block."""
    parts: list[str] = []
    stack: list = [root]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            parts.append(item)
        elif item is None:
            yield "".join(parts)
            parts.clear()
        else:
            if item.name in BLOCKS:
                yield "".join(parts)
                parts.clear()
                stack.append(None)
            elif item.name == "br":
                parts.append(" ")
            stack += reversed(item.children)
    yield "".join(parts)


def main_text(html: str | None) -> str:
    """The article: blocks joined by line feeds, white space inside a block as one space."""
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    if tree.marked:
        cut_marked(tree.root, tree.marked)
    measure(tree.root)
    if not tree.root.chars:
        return ""
    lines = (" ".join(b.split()) for b in blocks_of(article_of(tree.root)))
    return "\n".join(x for x in lines if x)


def extract_text(pages: DataFrame, html_column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Add ``text`` and ``n_chars`` (code points) to every row; ``keep`` names the columns to return.

    Null and empty pages, and pages without an article, have the empty text. Rows are independent:
    repeated rows repeat their result, an empty table gives an empty table, kept columns named like
    a result are replaced. Whole pages are read; nothing is capped.
    """
    kept = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars")]
    pages, names = set_aside(pages)
    kept, html_column = [names.get(c, c) for c in kept], names.get(html_column, html_column)
    rows = pages.select(*[F.col(c) for c in kept], whole_text(html_column).alias("_html"))
    schema = StructType([rows.schema[c] for c in kept] + [StructField("text", StringType())])
    arrow = to_arrow_schema(schema)

    def scan(batches):
        for batch in batches:
            texts = pa.array([main_text(h) for h in batch["_html"].to_pylist()], pa.string())
            own = [batch[c].cast(arrow.field(c).type) for c in kept]
            yield pa.RecordBatch.from_arrays([*own, texts], schema=arrow)

    read = rows.mapInArrow(scan, schema).withColumn("n_chars", F.length("text").cast("long"))
    return put_back(read, names)
