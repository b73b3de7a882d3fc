"""Main text of pages by wrapper induction.

Pages of one host are aligned with a page of that host, node by node, by simple
tree matching. Nodes whose text stays the same over most pages are the host's
template; the slots that vary hold the content, on pages that mark their article
as on others. Of the varying slots those inside page furniture (menus, headers,
footers, sidebars, notices, adverts, forms, comments) are set aside.

A marked article decides only what the alignment leaves open. A text that most but
not nearly all pages share is a quotation inside an article and template outside.
An article in which nothing varies, as over copies of one page, is kept. What no node
of the host's page matches, or any text of a host with too few different pages to
align, is content unless an article is marked elsewhere on the page.
"""

from __future__ import annotations

import html as entities
import json
import math
import re
from collections import Counter
from collections.abc import Generator, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.sizing import broadcast_if_small, store

#: Share of a host's different pages in which a template text has to be the same, and how many at least.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.5, 3
#: The share for a text inside a marked article.
ARTICLE_SHARE = 0.9
#: Rows that share one copy of a host's reference page where it is too large to broadcast.
SALT_ROWS = 512

# Tags and class words by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "iframe", "noscript")
#: Elements whose text is not read. Those other than ``RAW`` are parsed like any element.
UNREAD = frozenset((*RAW, "template", "svg", "math", "object", "select", "datalist", "optgroup", "option"))
FURNITURE = frozenset("nav header footer aside form button menu dialog label fieldset head".split())
BLOCKS = frozenset(
    "html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table caption thead tbody "
    "tfoot tr td th figure figcaption address hr details summary center".split() + sorted(FURNITURE - {"label", "button"})
)
CLASS_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs header "
    "masthead footer sidebar side aside widget cookie cookies consent notice popup modal overlay newsletter subscribe "
    "signup login search share social related recommended comment comments replies reply disqus respond feedback".split()
)
#: Words that say where or in what form such a part stands; any other word beside one of the above names content.
PLACE_WORDS = frozenset(
    "site page main top bottom left right primary secondary global local post entry article box bar block list links "
    "items container wrapper wrap area section inner outer slot unit zone panel form buttons bars".split()
)
ARTICLE_WORDS = re.compile(r"(?i)(?<![a-z])(article|post|entry|story|main|content)(-?(body|content|text))?(?![a-z])")
#: Elements that a start tag ends when they are open.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:![^>]*|\?[^>]*)(?:>|\Z)|<(?P<end>/)?(?P<tag>[A-Za-z][^\s/>]*)"
    r"(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S,
)
_NAMES = re.compile(r"""(?i)(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_WORDS = re.compile(r"[a-z]+|[0-9]+")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


class Node:
    __slots__ = ("children", "classes", "ended", "flat", "full", "label", "look", "names", "number", "tag", "text")

    def __init__(self, tag: str, names: str = "", classes: str = "") -> None:
        self.tag, self.names, self.classes, self.text, self.number = tag, names, classes.lower(), "", -1
        # What two nodes must share to match; numbers and the names of an article differ from page to page.
        self.label = "" if tag in ("html", "body", "article", "main") else _DIGITS.sub("0", names)
        self.children: list[Node] = []
        self.ended = False  # by its own end tag, or by one that HTML lets it omit
        self.look = self.full = 0  # what the whole subtree looks like, and its weight in a match with its equal
        self.flat = False  # it holds one text and nothing else


def parse(page: str) -> Node:
    """A tree of elements; text is a node of its own, tag ``#``. Never fails: what is not
    closed ends with its parent, and ends without a start are passed over. Raw text without
    an end is skipped to the end of the page only in scripts and styles."""
    root = Node("#root")
    stack = [root]
    at = foreign = 0
    while match := _TOKEN.match(page, at):
        at = match.end()
        if text := match["text"]:
            last = stack[-1].children[-1] if stack[-1].children else None
            if last is not None and last.tag == "#":
                last.text += text
            else:
                stack[-1].children.append(node := Node("#"))
                node.text = text
            continue
        if match["tag"] is None:
            continue
        tag = match["tag"].lower()
        if match["end"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    stack[depth].ended = True
                    del stack[depth:]
                    break
            continue
        if foreign >= len(stack):
            foreign = 0
        if tag in BLOCKS and foreign and not any(n.tag in ("foreignobject", "desc", "annotation-xml") for n in stack[foreign:]):
            del stack[foreign:]  # a drawing without an end
            foreign = 0
        if tag in BLOCKS:
            _end_paragraph(stack)
        for open_tag in CLOSED_BY.get(tag, ()):
            if stack[-1].tag == open_tag:
                stack.pop().ended = True
                break
        found = [(kind.lower(), a or b or c) for kind, a, b, c in _NAMES.findall(match["attributes"])]
        node = Node(tag, " ".join(n for _, n in found), " ".join(n for kind, n in found if kind != "id"))
        stack[-1].children.append(node)
        closed = match["attributes"].endswith("/")
        if tag in RAW and not foreign:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            node.ended = True
            at = close.end() if close else len(page) if tag in ("script", "style") else at
        elif tag not in VOID and not closed:
            if tag in ("svg", "math") and not foreign:
                foreign = len(stack)
            stack.append(node)
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        node.number = len(order)
        order.append(node)
        todo += reversed(node.children)
    for node in reversed(order):
        inside = node.children
        if not inside:
            node.look, node.full = hash((node.tag, node.label, node.text)), 2 if node.tag == "#" else 1
        elif len(inside) == 1:
            child = inside[0]
            node.flat = child.tag == "#"
            node.look, node.full = hash((node.tag, node.label, child.look)), 1 + child.full
        else:
            node.look = hash((node.tag, node.label, *[c.look for c in inside]))
            node.full = 1 + sum([c.full for c in inside])
    return root


def _end_paragraph(stack: list[Node]) -> None:
    """A block ends the open p, with the inline elements inside it."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
            del stack[depth:]
            return
        if stack[depth].tag in BLOCKS:
            return


def clean(text: str) -> str:
    return _SPACE.sub(" ", entities.unescape(text)).strip()


# --- simple tree matching -------------------------------------------------

#: Cells of a table of two lists of children that is kept whole. A larger one is gone through row by
#: row, and again where it is traced: the same alignment in less memory.
CELLS = 250_000


def _between(a: Node, b: Node) -> tuple[int, int, int]:
    """Where the children differ: those before and after are equal trees, which some largest alignment
    matches in order."""
    xs, ys = a.children, b.children
    start, end, other = 0, len(xs), len(ys)
    while start < end and start < other and xs[start].look == ys[start].look:
        start += 1
    while end > start and other > start and xs[end - 1].look == ys[other - 1].look:
        end, other = end - 1, other - 1
    return start, end, other


def _alike(a: Node, b: Node) -> bool:
    return a.tag == b.tag and a.label == b.label


def _table(a: Node, b: Node, start: int, end: int, other: int, weights: dict[tuple[int, int], int]) -> list[list[int]]:
    """The table of the children that differ."""
    theirs = [(y.tag, y.label, y) for y in b.children[start:other]]
    rows = [above := [0] * (len(theirs) + 1)]
    for x in a.children[start:end]:
        value, row, tag, label = 0, [0], x.tag, x.label
        for j, (their_tag, their_label, y) in enumerate(theirs):
            if above[j + 1] > value:
                value = above[j + 1]
            if tag == their_tag and label == their_label and (gain := above[j] + _weight(x, y, weights)) > value:
                value = gain
            row.append(value)
        rows.append(row)
        above = row
    return rows


class _Rows:
    """The same table where it is large: some rows are kept, those between found again from them.

    A weight depends on the shapes of two nodes and on the texts that both hold. Texts that many children
    on both sides hold are part of the shape; two children that share no other text weigh what any two
    of their shapes do, and only those that share one are aligned by themselves.
    """

    def __init__(self, a: Node, b: Node, start: int, end: int, other: int) -> None:
        self.xs, self.ys = a.children[start:end], b.children[start:other]
        ours, theirs = ([{t.look for t in _texts(n)} for n in nodes] for nodes in (self.xs, self.ys))
        counts, others = (Counter(look for looks in each for look in looks) for each in (ours, theirs))
        common = {look for look, n in counts.items() if n * others[look] > len(self.xs) + len(self.ys)}
        holders: dict[int, list[int]] = {}
        for j, looks in enumerate(theirs):
            for look in looks - common:
                if look in counts:
                    holders.setdefault(look, []).append(j)
        self.near = [{j for look in looks if look in holders for j in holders[look]} for looks in ours]
        names: dict[tuple, int] = {}
        self.ours = [_shape(x, common, names) for x in self.xs]
        shapes = [_shape(y, common, names) for y in self.ys]
        self.members: dict[int, list[int]] = {}
        for j, shape in enumerate(shapes):
            self.members.setdefault(shape, []).append(j)
        self.place = {shape: k for k, shape in enumerate(self.members)}
        self.theirs = np.array([self.place[shape] for shape in shapes])
        #: By shape of ``xs``: weights by shape of ``ys``, and the shapes not weighed yet.
        self.known: dict[int, tuple[np.ndarray, set[int]]] = {}
        self.step = math.isqrt(len(self.xs)) + 1
        self.kept: list[np.ndarray] = []

    def _gains(self, i: int) -> Generator:
        """The weights of a child with each of the other's, 0 where they are not alike."""
        x, near = self.xs[i], self.near[i]
        if self.ours[i] not in self.known:
            self.known[self.ours[i]] = np.zeros(len(self.place), np.int32), set(self.place)
        weights, missing = self.known[self.ours[i]]
        for shape in list(missing):
            j = next((j for j in self.members[shape] if j not in near), None)
            if j is not None:
                weights[self.place[shape]] = yield _gain(x, self.ys[j])
                missing.discard(shape)
        gains = weights[self.theirs]
        for j in near:
            gains[j] = yield _gain(x, self.ys[j])
        return gains

    def _next(self, above: np.ndarray, gains: np.ndarray) -> np.ndarray:
        row = np.zeros_like(above)
        np.maximum.accumulate(np.maximum(above[1:], above[:-1] + gains), out=row[1:])
        return row

    def last(self) -> Generator:
        """The last value of the table."""
        row = np.zeros(len(self.ys) + 1, np.int32)
        for i in range(len(self.xs)):
            if i % self.step == 0:
                self.kept.append(row)
            row = self._next(row, (yield self._gains(i)))
        return int(row[-1])

    def traced(self) -> Iterator[tuple[Node, Node]]:
        j = len(self.ys)
        for n in reversed(range(len(self.kept))):
            xs, rows, gains = self.xs[n * self.step : (n + 1) * self.step], [self.kept[n]], []
            for i in range(len(xs)):
                gains.append(_run(self._gains(n * self.step + i)))
                rows.append(self._next(rows[-1], gains[-1]))
            i = len(xs)
            while i:
                here, above, gain = rows[i], rows[i - 1], gains[i - 1]
                if j and gain[j - 1] and here[j] == above[j - 1] + gain[j - 1]:
                    i, j = i - 1, j - 1
                    yield xs[i], self.ys[j]
                elif here[j] == above[j]:
                    i -= 1
                else:
                    j -= 1


def _shape(node: Node, common: set[int], names: dict[tuple, int]) -> int:
    """A number for what ``node`` is without its texts other than those in ``common``."""
    order, todo = [], [node]
    while todo:
        here = todo.pop()
        order.append(here)
        todo += here.children
    found: dict[int, int] = {}
    for here in reversed(order):
        text = here.look if here.tag == "#" and here.look in common else 0
        name = (here.tag, here.label, text, *[found[c.number] for c in here.children])
        found[here.number] = names.setdefault(name, len(names))
    return found[node.number]


def _gain(x: Node, y: Node) -> Generator:
    """The weight of two nodes, 0 if they are not alike."""
    if not _alike(x, y):
        return 0
    weights: dict[tuple[int, int], int] = {}
    if x.look != y.look and x.children and y.children and not (x.flat and y.flat):
        weights, _ = yield _weighed(x, y)
    return _weight(x, y, weights)


def _run(steps: Generator):
    """What a generator returns that waits for the generators it yields: recursion as deep as pages nest."""
    stack, value = [steps], None
    while stack:
        try:
            inner = stack[-1].send(value)
        except StopIteration as end:
            value = end.value
            stack.pop()
        else:
            value = None
            stack.append(inner)
    return value


def _weight(a: Node, b: Node, weights: dict[tuple[int, int], int]) -> int:
    """Nodes of the largest order-keeping alignment of two alike nodes; equal texts count twice."""
    if a.look == b.look:
        return a.full
    if not a.children or not b.children:
        return 1
    if a.flat and b.flat:
        return 2
    return weights[a.number, b.number]


def _weighed(a: Node, b: Node) -> Generator:
    """Weights and tables of two alike nodes and of the pairs below that their alignment looks at; pairs
    inside a large table are left to it.

    Pairs of alike nodes are listed level by level and weighed from the deepest level up, so trees
    may be as deep as they like.
    """
    levels, level = [], [(a, b)]
    while level:
        spans, below = [], []
        for x, y in level:
            start, end, other = _between(x, y)
            large = (end - start) * (other - start) > CELLS
            spans.append((x, y, start, end, other, large))
            for p in x.children[start:end] if other > start and not large else ():
                if p.children:
                    look, flat, tag, label = p.look, p.flat, p.tag, p.label
                    for q in y.children[start:other]:
                        if q.tag == tag and q.label == label and q.children and q.look != look and not (flat and q.flat):
                            below.append((p, q))
        levels.append(spans)
        level = below
    weights: dict[tuple[int, int], int] = {}
    tables = {}
    for spans in reversed(levels):
        for x, y, start, end, other, large in spans:
            equal = sum([c.full for c in x.children[:start]]) + sum([c.full for c in x.children[end:]])
            if large:
                rows = _Rows(x, y, start, end, other)
                most = yield rows.last()
            else:
                rows = _table(x, y, start, end, other, weights) if end > start and other > start else [[0]]
                most = rows[-1][-1]
            weights[x.number, y.number] = 1 + equal + most
            tables[x.number, y.number] = start, len(x.children) - end, rows
    return weights, tables


def align(a: Node, b: Node) -> dict[int, Node]:
    """Nodes of ``b`` by the number of the node of ``a`` that each is matched with."""
    weights, tables = _run(_weighed(a, b))
    out: dict[int, Node] = {}
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        out[x.number] = y
        if x.look == y.look or x.flat and y.flat:
            todo += zip(x.children, y.children, strict=True)
        elif x.children and y.children:
            if (x.number, y.number) not in tables:  # matched inside a large table
                for known, more in zip((weights, tables), _run(_weighed(x, y)), strict=True):
                    known.update(more)
            todo += _traced(x, y, *tables.pop((x.number, y.number)), weights)
    return out


def _traced(a: Node, b: Node, start: int, after: int, rows: list | _Rows, weights: dict) -> Iterator[tuple[Node, Node]]:
    """Pairs of matched children: those that begin and end the lists alike, and those of the table."""
    yield from zip(a.children[:start], b.children[:start], strict=True)
    if after:
        yield from zip(a.children[-after:], b.children[-after:], strict=True)
    if isinstance(rows, _Rows):
        yield from rows.traced()
        return
    i, j = len(rows) - 1, len(rows[-1]) - 1
    while i:
        here, above = rows[i], rows[i - 1]
        if j:
            x, y = a.children[start + i - 1], b.children[start + j - 1]
            if _alike(x, y) and here[j] == above[j - 1] + _weight(x, y, weights):
                yield x, y
                i, j = i - 1, j - 1
                continue
        if here[j] == above[j]:
            i -= 1
        else:
            j -= 1


# --- template and content -------------------------------------------------


def _texts(node: Node) -> Iterator[Node]:
    todo = [node]
    while todo:
        node = todo.pop()
        if node.tag == "#":
            yield node
        todo += reversed(node.children)


def constant_nodes(reference: Node, page: Node) -> list[int]:
    """Text nodes of the reference that the page has with the same text."""
    matched = align(reference, page)
    return [
        n.number for n in _texts(reference)
        if n.number in matched and (t := clean(n.text)) and clean(matched[n.number].text) == t
    ]


def _furniture(node: Node, in_article: bool) -> bool:
    """Whether the element is none of the content by its tag or class. Inside an article only whole
    classes count, ids and headings never: they name what a text is about."""
    # An element that is not read but never ends holds the rest of its parent: that is read.
    if node.tag in UNREAD and node.ended or node.tag in FURNITURE and not (node.tag == "header" and in_article):
        return True
    if not node.classes or node.tag in ("html", "body", "article", "main", "header", "h1", "h2", "h3", "h4", "h5", "h6"):
        return False
    return any(n in CLASS_WORDS or not in_article and _placed(n) for n in node.classes.split())


def _placed(name: str) -> bool:
    """Whether a compound class, as ``cookie-notice`` or ``site-header`` but not ``share-price``,
    consists of furniture and its place."""
    words = _WORDS.findall(name)
    return any(w in CLASS_WORDS for w in words) and all(w in CLASS_WORDS or w in PLACE_WORDS or w.isdigit() or w == "x" for w in words)


def _length(node: Node, in_article: bool) -> int:
    """Characters of the texts of ``node`` that are read."""
    todo, length = [node], 0
    while todo:
        here = todo.pop()
        if here.tag == "#":
            length += len(clean(here.text))
        elif here is node or not _furniture(here, in_article):
            todo += here.children
    return length


def _articles(root: Node) -> list[Node]:
    """The marked articles outside furniture, the outermost of each kind: ``article`` or ``main``
    elements that hold a text, else elements whose name says so, if they hold most of the page's
    text."""
    for fits in (
        lambda n: n.tag == "article", lambda n: n.tag == "main",
        lambda n: n.tag in ("div", "section", "td") and bool(n.names) and bool(ARTICLE_WORDS.search(n.names)),
    ):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if fits(node) and not _furniture(node, False):
                found.append(node)
            elif not _furniture(node, False):
                todo += reversed(node.children)
        if found and found[0].tag in ("article", "main"):
            if any(_length(n, True) for n in found):
                return found
        elif found and 2 * sum(_length(n, True) for n in found) > _length(root, False):
            return found
    return []


def _read(root: Node, articles: set[int], known: set[int]) -> Iterator[tuple[Node | None, bool, bool]]:
    """Texts and breaks outside furniture in page order, each with whether it is in one of the
    ``articles`` and whether in an element that is ``known``; None where a block begins or ends."""
    # An explicit stack, as pages nest as deep as they like.
    todo = [(root, False, False, False)]
    while todo:
        here, inside, seen, left = todo.pop()
        if left:
            yield None, inside, seen
        elif here.tag == "#" or here.tag in ("br", "hr", "img", "wbr"):
            yield here, inside, seen
        elif here.number in articles or not _furniture(here, inside):
            inside, seen = inside or here.number in articles, seen or here.number in known
            if here.tag in BLOCKS:
                yield None, inside, seen
                todo.append((here, inside, seen, True))
            todo += [(c, inside, seen, False) for c in reversed(here.children)]


def observe(page: str, reference: Node | None) -> tuple[bool, list, list[int]]:
    """What one parse and one alignment tell of a page: whether it marks an article; its texts and
    breaks outside furniture, in page order; and the reference's text nodes that it has with the same text.

    A text is ``[text, in an article, in a matched element, number of the reference's node with the
    same text or -1]``, a break between blocks 0.
    """
    root = parse(page)
    articles = {n.number for n in _articles(root)}
    matched = {} if reference is None else align(reference, root)
    same = {
        matched[n.number].number: n.number for n in (_texts(reference) if matched else ())
        if n.number in matched and (t := clean(n.text)) and clean(matched[n.number].text) == t
    }
    known = {n.number for n in matched.values() if n.tag not in ("#root", "html", "body")}
    seen: list = []
    for node, inside, within in _read(root, articles, known):
        if node is None:
            if seen and seen[-1] != 0:
                seen.append(0)
        elif node.tag != "wbr":
            text = node.text if node.tag == "#" else " "
            seen.append([text, int(inside), int(within), same.get(node.number, -1)])
    return bool(articles), seen, sorted(same.values())


def main_text(
    marked: bool, seen: list, template: frozenset[int] = frozenset(), certain: frozenset[int] = frozenset(),
    aligned: bool = False,
) -> str:
    """Blocks of content in page order, one a line, from what :func:`observe` saw.

    ``template`` holds the reference's nodes that are template outside articles, ``certain`` those that are
    so inside, too; ``aligned`` says whether the host has pages enough to tell what varies.
    """
    # An article in which nothing varies is kept.
    kept = all(e[3] in certain for e in seen if e and e[1] and clean(e[0]))
    blocks: list[list[str]] = [[]]
    for event in seen:
        if event == 0:
            blocks.append([])
            continue
        text, inside, within, node = event
        if marked and not inside and not (within and aligned):
            continue
        if node in template and (not inside or node in certain and not kept):
            continue
        blocks[-1].append(text)
    return "\n".join(t for b in blocks if b and (t := clean("".join(b))))


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def _with_reference(pages: DataFrame, known: DataFrame) -> DataFrame:
    """``pages`` with the columns of ``known``, one row a host: broadcast where that is measured
    to be small, else joined on (host, salt) so that a large host is many small groups."""
    small = broadcast_if_small(known)
    if small is not known:
        return pages.join(small, "host", "left")
    many = store(pages.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("int").alias("salts")))
    salted = pages.join(broadcast_if_small(many), "host").withColumn("salt", F.pmod(F.xxhash64("page_id"), "salts").cast("int"))
    copies = known.join(many, "host").select(*known.columns, F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return salted.drop("salts").join(copies, ["host", "salt"], "left").drop("salt")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: (page_id, url, text): the main text, blocks joined by a line break, empty if none.

    Character references are decoded, white space inside a block is one space, and empty
    blocks are left out. A null or empty page has an empty text. A URL without a host shares the
    empty host. Repeated pages count once for the template; rows without an id are
    treated like others. Other columns are ignored; no rows give no rows.
    """
    given = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("html"),
        _host(F.col(url)).alias("host"),
    )
    first = given.groupBy("host").agg(F.min("page_id").alias("page_id"))
    chosen = given.join(broadcast_if_small(store(first)), ["host", "page_id"])
    reference = store(chosen.groupBy("host").agg(F.min("html").alias("reference")))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees: dict[str, Node] = {}
        for frame in frames:
            out = []
            for row, address, host, page, model in zip(*(frame[c] for c in ("page_id", "url", "host", "html", "reference")), strict=True):
                if model is not None and model not in trees:
                    trees = {model: parse(model)} if len(trees) > 256 else trees | {model: parse(model)}
                marked, seen, same = observe(page, trees.get(model))
                out.append((row, address, host, marked, json.dumps(seen, ensure_ascii=False), None if model is None else same))
            yield pd.DataFrame(out, columns=["page_id", "url", "host", "marked", "seen", "same"])

    # One parse and one alignment a page; what is left of it is stored, and decided when all pages have been seen.
    observed = store(
        _with_reference(given, reference)
        .select(F.col("page_id").cast("string").alias("page_id"), "url", "host", "html", "reference")
        .mapInPandas(compare, "page_id string, url string, host string, marked boolean, seen string, same array<int>"),
        codec="zstd",
    )
    # Copies of a page count once: they are seen alike.
    different = observed.where("same IS NOT NULL").select("host", F.xxhash64("marked", "seen").alias("page"), "same").distinct()
    counted = store(different.groupBy("host", "same").agg(F.count(F.lit(1)).alias("n")))
    many = counted.groupBy("host").agg(F.sum("n").alias("pages"))
    votes = counted.select("host", "n", F.explode("same").alias("node")).groupBy("host", "node").agg(F.sum("n").alias("votes"))
    template = (
        votes.join(many, "host")
        .where((F.col("votes") >= TEMPLATE_PAGES) & (F.col("votes") >= TEMPLATE_SHARE * F.col("pages")))
        .groupBy("host").agg(
            F.array_sort(F.collect_set("node")).alias("template"),
            F.array_sort(F.collect_set(F.when(F.col("votes") >= ARTICLE_SHARE * F.col("pages"), F.col("node")))).alias("certain"),
        )
    )
    aligned = many.select("host", (F.col("pages") >= TEMPLATE_PAGES).alias("aligned"))
    known = store(aligned.join(template, "host", "left"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = []
            for marked, seen, several, *nodes in zip(*(frame[c] for c in ("marked", "seen", "aligned", "template", "certain")), strict=True):
                template, certain = (frozenset([] if n is None else n) for n in nodes)
                texts.append(main_text(bool(marked), json.loads(seen), template, certain, bool(several)))
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts})

    found = _with_reference(observed, known).select(
        "page_id", "url", "marked", "seen", F.coalesce("aligned", F.lit(False)).alias("aligned"), "template", "certain"
    )
    texts = found.mapInPandas(read, "page_id string, url string, text string")
    return texts.withColumn("page_id", F.col("page_id").cast(pages.schema[page_id].dataType))
