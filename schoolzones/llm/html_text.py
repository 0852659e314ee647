"""Main text of web pages by wrapper induction.

Each page becomes a tree of its block elements and of the texts between them; inline elements have no node, what they
hold counts as their parent's. Every text is a leaf of its own, also in articles, lists, tables and beside blocks. Per
host, the page that holds most of the texts that recur on the host (by path and text) is the pattern, so an empty page or
one of a rare layout never is where others share more; all different pages of the host are aligned to it by simple tree
matching (the largest order-preserving match of children, labels equal; of the largest, one that pairs equal parts). How
often a pattern node's text recurs is summed over all of them: nodes with the same text on at least ``CONSTANT_SHARE`` of
the pages, three pages at least, are template; the others are slots. A page is then aligned to its host's wrapper, matched
template nodes fall away, and what varies is content. List items, terms and rows of plain cells are judged with their like
neighbours: one that recurs stays where a neighbour varies, and the cells of such a row stay together.

The article (article, main or role=main, where a page has one) is where the text is looked for. How many blocks it has
differs from page to page, so inside it blocks are also aligned by their path of elements and their text: those on at least
``CONSTANT_SHARE`` of the host's different pages, three at least, are template too. On such hosts the text of a main
part beside its articles is judged in the same way; where a host has too few pages, the tags decide and only the articles
count. Articles in which nothing varies stay whole, and a recurring heading, caption, term or cell stays in front of a
block that does. Parts that never are main text (menus, page headers, footers, sidebars, forms, adverts, notices, comments, scripts, styles) are known by element or by
class, id and role words, and fall away on every page, also where a host has too few pages to learn from.

Only outlines and hashes of blocks are aligned and shuffled for learning; a wrapper (one outline) travels to its pages by a join that
Spark splits where one host has most pages. A null html is empty; empty pages have empty text. A null or odd url is a
host of its own. Repeated rows are judged alike. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored

#: HTML's element groups.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
NEVER = set(
    "head title script style noscript template svg math iframe object embed canvas audio video map nav footer aside "
    "form button select option textarea input dialog menu".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
#: What names the text after it.
LABELS = HEADINGS | set("caption dt summary td th".split())
#: What is judged with its like neighbours.
ITEMS = set("li dt dd".split())
#: An opening tag of the first kind ends an open element of the second.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
_ENDS_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
_SCOPES = set("article aside body div footer form header html li main nav ol section table td th ul".split())
#: Words of class, id or role that name what isn't main text.
_NOISE = set(
    "ad ads adv advert advertisement adverts sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup menu nav navbar navigation breadcrumb "
    "breadcrumbs pagination pager sidebar sidebars aside footer header masthead topbar toolbar comment comments "
    "commentlist reply replies disqus share sharing social related recommended widget widgets search login form skip "
    "complementary contentinfo".split()
)
#: Those that also an article can bear that isn't the page's.
_NO_ARTICLE = set("ad ads advert sponsored promo comment comments reply replies related recommended widget".split())
#: The tag of the nodes that hold texts.
TEXT = "#text"
CONSTANT_SHARE = 0.9
LEAST_PAGES = 3


class Node:
    """An element, or a text: its one item, with single spaces. ``noise``: never main text; ``named``: because of a word of
    its class, id or role."""

    __slots__ = ("tag", "noise", "named", "main", "items", "parent", "inside")

    def __init__(self, tag: str, attrs: list, parent: Node | None):
        self.tag, self.parent, self.items = tag, parent, []
        words = set()
        for name, value in attrs:
            if value and name in ("class", "id", "role"):
                words.update(re.split(r"[^a-z0-9]+", value.lower()))
        # Headings, and the header of an article, belong to the text.
        self.inside = inside = parent is not None and (parent.inside or parent.main)
        spared = {"header"} if words and (tag in HEADINGS or tag == "header" and inside) else set()
        self.main = (tag in ("article", "main") or "main" in words and tag == "div") and not (words and words & _NO_ARTICLE)
        self.named = bool(words) and not self.main and tag not in ("html", "body") and bool(words & (_NOISE - spared))
        self.noise = tag in NEVER or self.named or tag == "header" and not inside


class _Tree(HTMLParser):
    """Builds nodes; end tags that HTML lets out are filled in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#page", [], None)

    def _close(self, tags: set[str], scopes: set[str]) -> None:
        node = self.at
        while node.parent is not None:
            if node.tag in tags:
                self.at = node.parent
                return
            if node.tag in scopes:
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_P:
            self._close({"p"}, _SCOPES)
        if tag == "tr":
            self._close({"td", "th"}, _SCOPES - {"td", "th"})  # and the row around it below
        if tag in CLOSES:
            self._close(CLOSES[tag], _SCOPES - CLOSES[tag] if tag != "li" else {"ul", "ol", "menu"})
        node = Node(tag, attrs, self.at)
        self.at.items.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.items.append(Node(tag, attrs, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None:
            if node.tag == tag:
                self.at = node.parent
                return
            node = node.parent

    def handle_data(self, data):
        self.at.items.append(data)


def tree(html: str | None) -> Node:
    parser = _Tree()
    parser.feed(html or "")
    parser.close()
    _settle(parser.root)
    return parser.root


def _settle(top: Node) -> None:
    """Takes inline elements out: what they hold goes to the block around them, and texts up to the next block become one
    node. Noise in a text doesn't part it and stands behind it."""
    stack = [top]
    while stack:
        node = stack.pop()
        items: list[Node] = []
        held: list[str] = []
        aside: list[Node] = []
        todo: list = [None, *reversed(node.items)]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                held.append(x)
                continue
            if x is not None:
                if x.tag == "br":
                    held.append(" ")
                    continue
                if x.noise:
                    aside.append(x)
                    continue
                if x.tag in INLINE:
                    todo.extend(reversed(x.items))
                    continue
            if held:
                if words := "".join(held).split():
                    items.append(Node(TEXT, (), node))
                    items[-1].items.append(" ".join(words))
                held.clear()
            if aside:
                items.extend(aside)
                aside.clear()
            if x is not None:
                items.append(x)
        node.items = items
        for x in items:
            if x.tag != TEXT:
                x.parent = node
                if x.items:
                    stack.append(x)


def _text_below(node: Node) -> str:
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if x.tag == TEXT:
            out += x.items
        else:
            stack.extend(reversed(x.items))
    return " ".join(out)


class Folded:
    """A node of an outline: a label, the hash of the text it stands for, and the page's nodes behind it.

    ``shape`` and ``same`` number it by the labels, and by labels and texts, of it and all below; ``count``: how many.
    """

    __slots__ = ("label", "text", "children", "nodes", "number", "shape", "same", "count")

    def __init__(self, label: str, text: int, children: list[Folded], nodes: list[Node]):
        self.label, self.text, self.children, self.nodes, self.number = label, text, children, nodes, -1


def _hash(text: str) -> int:
    return crc32(text.encode("utf-8", "surrogatepass"))


def _opened(top: Node) -> set[int]:
    """The noise (by id) around the content, if a page has its content there only."""
    opened, seen = set(), set()
    for x in _content(top):
        while x is not None and id(x) not in seen:
            seen.add(id(x))
            if x.noise:
                opened.add(id(x))
            x = x.parent
    return opened


def _parts(node: Node, opened: set[int]) -> list[Node]:
    """What is right below a node: blocks, texts between them, and noise; nothing in noise, or where all is one text."""
    if node.noise and id(node) not in opened:
        return []
    shown = [x for x in node.items if not x.noise or id(x) in opened]
    return [] if len(shown) == 1 and shown[0].tag == TEXT else node.items


def fold(node: Node) -> Folded:
    """The outline below ``node``. Each text is a leaf: that of an element without other parts is the element's own."""
    opened = _opened(node)
    # Each entry: a node, and the children it is to be put among.
    out: list[Folded] = []
    stack: list[tuple[Node, list[Folded]]] = [(node, out)]
    while stack:
        x, among = stack.pop()
        if x.tag == TEXT:
            among.append(Folded(TEXT, _hash(x.items[0]), [], [x]))
            continue
        parts = _parts(x, opened)
        if parts:
            text = ""
        elif x.noise:
            text = _text_below(x)
        else:
            text = next((y.items[0] for y in x.items if y.tag == TEXT), "")
        among.append(Folded(x.tag + "!" * x.noise, _hash(text), [], [x]))
        below = among[-1].children
        stack.extend([(y, below) for y in reversed(parts)])
    return out[0]


def _step(path: int, tag: str) -> int:
    return crc32(tag.encode("utf-8", "surrogatepass"), path)


def pack(top: Folded) -> str:
    """An outline as text, numbered in preorder: label, text hash and number of children of each node."""
    out, stack = [], [top]
    while stack:
        x = stack.pop()
        out.append(f"{x.label}:{x.text}:{len(x.children)}")
        stack.extend(reversed(x.children))
    return " ".join(out)


def leaf_keys(top: Folded) -> list[int]:
    """The different keys of an outline's texts: each hashes the labels down to a leaf and its text."""
    out, stack = set(), [(top, _step(0, top.label))]
    while stack:
        x, path = stack.pop()
        if not x.children:
            out.add((path & 0x7FFFFFFF) << 32 | x.text)
        stack.extend((c, _step(path, c.label)) for c in x.children)
    return sorted(out)


def unpack(text: str) -> Folded:
    root, open_ = None, []
    for number, part in enumerate(text.split(" ")):
        label, hash_, n = part.rsplit(":", 2)
        node = Folded(label, int(hash_), [], [])
        node.number = number
        if open_:
            open_[-1][0].children.append(node)
            open_[-1][1] -= 1
        else:
            root = node
        open_.append([node, int(n)])
        while open_ and not open_[-1][1]:
            open_.pop()
    return root


def _shape(top: Folded, known: dict, alike: dict) -> None:
    """Numbers each node by its shape, which is the labels of it and of all below: equal shapes match alike.

    ``same`` also tells texts apart, and ``count`` is the number of nodes.
    """
    stack = [(top, False)]
    while stack:
        x, ready = stack.pop()
        if not x.children:
            x.shape = known.setdefault(x.label, len(known))
            x.same = alike.setdefault((x.label, x.text), len(alike))
            x.count = 1
        elif ready:
            x.shape = known.setdefault((x.label, tuple([c.shape for c in x.children])), len(known))
            x.same = alike.setdefault((x.label, tuple([c.same for c in x.children])), len(alike))
            x.count = 1 + sum([c.count for c in x.children])
        else:
            stack.append((x, True))
            stack.extend([(c, False) for c in x.children])


def _align(
    left: list[int], right: list[int], size: dict[tuple[int, int], int], more: tuple[list, list, list] | None = None
) -> tuple[int, list]:
    """The heaviest order-preserving pairing of two lists of shapes: its weight, and for each row of the table two rows
    of bits that tell where it is as good to leave out the last of ``left``, or else the last of ``right``.

    ``more``: numbers for ``left`` and ``right``, and what a pair of equal ones weighs more. Two rows of numbers are held
    at a time, so that 20,000 siblings beside as many take 100 MB. Long lists are first paired near the diagonal, further
    off only where that may be heavier.
    """
    last = [0] * (len(right) + 1)
    if len(left) * len(right) <= 1024:
        rows = []
        for i, x in enumerate(left):
            row, up, back = [0], 0, 0
            for j, y in enumerate(right):
                weight = size.get((x, y), 0)
                if more and more[0][i] == more[1][j]:
                    weight += more[2][i]
                most = max(row[j], last[j + 1], last[j] + weight if weight else 0)
                up |= (most == last[j + 1]) << j
                back |= (most == row[j]) << j
                row.append(most)
            rows.append((up.to_bytes(len(right) // 8 + 1, "little"), back.to_bytes(len(right) // 8 + 1, "little")))
            last = row
        return last[-1], rows
    kinds, at = np.unique(np.array(right), return_inverse=True)
    weights = {x: np.array([size.get((x, y), 0) for y in kinds.tolist()], np.int64) for x in set(left)}
    # What each can weigh at most; the heaviest first, summed up.
    most_left = np.array([weights[x].max() for x in left], np.int64)
    most_right = np.maximum.reduce(list(weights.values()))[at]
    same = more and np.array(more[1])
    if more:
        extra = dict(zip(more[0], more[2]))
        there = set(more[1])
        most_left += np.array([w if k in there else 0 for k, w in zip(*more[::2])], np.int64)
        most_right += np.array([extra.get(k, 0) for k in more[1]], np.int64)
    most_left, most_right = (np.cumsum(np.sort(x)[::-1]) for x in (most_left, most_right))
    width = 16
    while True:
        total, rows = _banded(left, at, weights, same, more, width)
        # A pairing that leaves the band leaves out more than ``width`` of the fewer, and what is left weighs less then.
        pairs = max(int(np.searchsorted(x, total, "right")) for x in (most_left, most_right))
        enough = min(len(left), len(right)) - pairs - 1
        if width >= enough:
            return total, rows
        width = enough if width > 16 else min(256, enough)


def _banded(left, at, weights, same, more, width: int) -> tuple[int, list]:
    """``_align`` by pairings that never are more than ``width`` places off those without gaps."""
    n, m = len(left), len(at)
    nothing = -(1 << 60)
    last, row = np.full(m + 1, nothing, np.int64), np.full(m + 1, nothing, np.int64)
    last[: max(0, m - n) + width + 1] = 0
    rows = []
    for i, x in enumerate(left):
        low = max(0, i + 1 + min(0, m - n) - width)
        high = min(m, i + 1 + max(0, m - n) + width)
        first = max(low, 1)
        weight = weights[x][at[first - 1 : high]]
        if more:
            weight += (same[first - 1 : high] == more[0][i]) * more[2][i]
        row[first - 1] = 0 if low == 0 else nothing
        now = row[first : high + 1]
        np.maximum(last[first : high + 1], np.where(weight > 0, last[first - 1 : high] + weight, nothing), out=now)
        np.maximum.accumulate(row[first - 1 : high + 1], out=row[first - 1 : high + 1])
        skip = (first - 1) % 8
        bits = np.zeros((2, skip + high + 1 - first), bool)
        np.equal(now, last[first : high + 1], out=bits[0, skip:])
        np.equal(now, row[first - 1 : high], out=bits[1, skip:])
        before = bytes((first - 1) // 8)
        bits = np.packbits(bits, axis=1, bitorder="little")
        rows.append((before + bits[0].tobytes(), before + bits[1].tobytes()))
        last, row = row, last
    return int(last[-1]), rows


def _ends(left: list[int], right: list[int]) -> tuple[int, int]:
    """How many numbers at the front, and of the others at the back, are equal."""
    least = min(len(left), len(right))
    front = next((i for i in range(least) if left[i] != right[i]), least)
    back = next((i for i in range(least - front) if left[-1 - i] != right[-1 - i]), least - front)
    return front, back


def _weigh(pairs: list[tuple[Folded, Folded]], size: dict[tuple[int, int], int], unit: int) -> None:
    """Puts into ``size`` how many nodes, times ``unit``, each of the pairs can match: by shapes, from the leaves up."""
    todo = [(x, y, False) for x, y in pairs]
    while todo:
        x, y, ready = todo.pop()
        key = x.shape, y.shape
        if key in size:
            continue
        if x.shape == y.shape:
            size[key] = unit * x.count
        elif not (x.children and y.children):
            size[key] = unit
        else:
            # Equal ones at the ends match in whole, so they needn't be weighed against others.
            front, back = _ends([c.shape for c in x.children], [c.shape for c in y.children])
            left, right = (z.children[front : len(z.children) - back] for z in (x, y))
            if ready:
                ends = x.children[:front] + x.children[len(x.children) - back :]
                kinds = {c.shape for c in left}, {c.shape for c in right}
                if len(kinds[0]) == len(kinds[1]) == 1:  # each of the fewer meets one of the others
                    below = size.get((left[0].shape, right[0].shape), 0) * min(len(left), len(right))
                else:
                    below = _align([c.shape for c in left], [c.shape for c in right], size)[0]
                size[key] = unit * (1 + sum(c.count for c in ends)) + below
            else:
                todo.append((x, y, True))
                todo.extend((*pair, False) for pair in _candidates(left, right))


def _candidates(left: list[Folded], right: list[Folded]) -> list[tuple[Folded, Folded]]:
    """The pairs of different shapes that can match."""
    left, right = ({c.shape: c for c in z}.values() for z in (left, right))
    by_label: dict[str, list[Folded]] = {}
    for y in right:
        by_label.setdefault(y.label, []).append(y)
    return [(x, y) for x in left for y in by_label.get(x.label, ())]


def match(a: Folded, b: Folded) -> list[tuple[Folded, Folded]]:
    """Simple tree matching: the largest set of pairs that keeps labels, order and parents.

    Of several that are as good, children are paired where they and all below them are equal, texts included: a block that
    recurs among others of its kind meets itself. Pairs of equal shapes are weighed once, and one table is held at a time.
    """
    if a.label != b.label:
        return []
    shapes: dict = {}
    alike: dict = {}
    _shape(a, shapes, alike)
    _shape(b, shapes, alike)
    unit = a.count + 1  # one pair weighs more than all equal texts
    size: dict[tuple[int, int], int] = {}
    pairs, stack = [], [(a, b)]
    while stack:
        x, y = stack.pop()
        pairs.append((x, y))
        if x.shape == y.shape:
            stack.extend(zip(x.children, y.children))  # any other pairing leaves nodes out
            continue
        if not (x.children and y.children):
            continue
        front, back = _ends([c.same for c in x.children], [c.same for c in y.children])
        stack.extend(zip(x.children[:front], y.children[:front]))
        stack.extend(zip(x.children[len(x.children) - back :], y.children[len(y.children) - back :]))
        left, right = (z.children[front : len(z.children) - back] for z in (x, y))
        if len(left) == len(right) == 1:
            if left[0].label == right[0].label:
                stack.append((left[0], right[0]))
            continue
        _weigh(_candidates(left, right), size, unit)
        more = [c.same for c in left], [c.same for c in right], [c.count for c in left]
        rows = _align([c.shape for c in left], [c.shape for c in right], size, more)[1]
        i, j = len(left), len(right)
        while i and j:
            up, back_ = rows[i - 1]
            byte, bit = divmod(j - 1, 8)
            if up[byte] >> bit & 1:
                i -= 1
            elif back_[byte] >> bit & 1:
                j -= 1
            else:
                i, j = i - 1, j - 1
                stack.append((left[i], right[j]))
    return pairs


def _outermost(top: Node, wanted, blocked) -> list[Node]:
    """In page order, the elements that are ``wanted`` and below no other such, nor below a ``blocked`` one."""
    found, stack = [], [top]
    while stack:
        x = stack.pop()
        if blocked(x):
            continue
        if wanted(x):
            found.append(x)
        else:
            stack.extend([y for y in reversed(x.items) if y.tag != TEXT])
    return found


def _content(top: Node) -> list[Node]:
    """The articles of a page, else its main parts; those in oddly named parts only if there are no others."""
    noise = lambda x: x.noise
    never = lambda x: x.noise and not x.named
    article, main = (lambda x: x.tag == "article"), (lambda x: x.main)
    if not _outermost(top, lambda x: x.main or x.tag == "article", lambda x: False):
        return []
    for wanted, blocked in ((article, noise), (main, noise), (main, never)):
        if found := _outermost(top, wanted, blocked):
            return found
    return []


def _blocks(top: Node, template: set[int], wide: bool) -> list[tuple[int, str, bool, bool, bool]]:
    """(key, text, of an article, a label, of ``template``) of the content's blocks below ``top``, without noise.

    ``wide``: from the main parts around the articles, if there are any. The key hashes a block's path and its text.
    """
    mains = _content(top) or [top]
    own = set(map(id, mains))
    if wide:
        around = []
        for x in mains:
            above, at = x, x.parent
            while at is not None:
                above, at = at if at.main else above, at.parent
            if not any(above is y for y in around[-1:]):
                around.append(above)
        mains = around
    found: list[tuple[int, str, bool, bool, bool]] = []
    for start in mains:
        names, x = [], start.parent
        while x is not None:
            names.append(x.tag)
            x = x.parent
        path = 0
        for name in reversed(names):
            path = _step(path, name)
        stack = [(start, path, False, False, False)]
        while stack:
            x, path, article, label, fixed = stack.pop()
            if x.noise:
                continue
            fixed = fixed or id(x) in template
            if x.tag == TEXT:
                text = x.items[0]
                found.append(((path & 0x7FFFFFFF) << 32 | _hash(text), text, article, label, fixed))
            else:
                below = _step(path, x.tag), article or id(x) in own, x.tag in LABELS or label and x.tag in _ENDS_P, fixed
                stack.extend((y, *below) for y in reversed(x.items))
    return found


def _groups(node: Node, rows: set[int]) -> list[list[Node]]:
    """The list items, terms and rows of plain cells (``rows``, by id) right below a node, like neighbours together."""
    groups: list[list[Node]] = []
    before = None
    for x in node.items:
        if x.tag == TEXT:
            continue
        like = None if x.noise or x.tag not in ITEMS and id(x) not in rows else x.tag
        if like and like == before:
            groups[-1].append(x)
        elif like:
            groups.append([x])
        before = like
    return groups


def _spared(top: Node, template: set[int]) -> set[int]:
    """Nodes of the template that are part of what varies: of items among like neighbours one of which varies, and of rows
    of plain cells that do. A cell is plain if it has one text at most; a row of them has two cells with a text."""
    order, stack = [], [top]
    while stack:
        x = stack.pop()
        if not x.noise and x.tag != TEXT:
            order.append(x)
            stack.extend(x.items)
    texts: dict[int, int] = {}
    varies: set[int] = set()
    rows: set[int] = set()
    for x in reversed(order):
        n = cells = 0
        for y in x.items:
            here = 1 if y.tag == TEXT else texts.get(id(y), 0)
            n += here
            cells += here == 1 and y.tag in ("td", "th")
            if id(y) in varies or y.tag == TEXT and id(y) not in template and id(x) not in template:
                varies.add(id(x))
        texts[id(x)] = n
        if x.tag == "tr" and n == cells > 1:
            rows.add(id(x))
    kept = rows & varies
    for x in order:
        for group in _groups(x, rows):
            if any(id(y) in varies for y in group):
                kept.update(id(y) for y in group if id(y) not in varies)
    for x in order:  # parents come before what is below them
        if id(x) in kept:
            kept.update(map(id, x.items))
    return kept & template


def extract(top: Node, template: set[int], constant: set[int] | None = None) -> str:
    """The content's blocks below ``top``, without noise and without the nodes (by id) of the template that aren't spared.

    ``constant``: the keys of the blocks that recur on the page's host; None where it has too few pages to tell. A label
    that recurs (a heading, a caption, a term, a cell) is judged by what it names: it stays if the block after it does.
    """
    if constant is None:
        template = template and template - _spared(top, template)
        return "\n\n".join(text for _, text, _, _, fixed in _blocks(top, template, False) if not fixed)
    blocks = [(text, article, label, fixed or key in constant) for key, text, article, label, fixed in _blocks(top, template, True)]
    varies = any(article and not recurs for _, article, _, recurs in blocks)
    kept, after = [], False
    for text, article, label, recurs in reversed(blocks):
        stays = not recurs or article and (not varies or label and after)
        after = stays and article
        if stays:
            kept.append(text)
    return "\n\n".join(reversed(kept))


_COUNTS = "host string, number int, pages long, same long"


def _outlines(html: pd.Series) -> pd.DataFrame:
    """The outline of each page, the keys of its texts, and those of the blocks of its articles and main parts."""
    outlines, leaves, blocks = [], [], []
    for h in html:
        top = tree(h)
        outline = fold(top)
        outlines.append(pack(outline))
        leaves.append(leaf_keys(outline))
        blocks.append(sorted({block[0] for block in _blocks(top, set(), True)}) if _content(top) else [])
    return pd.DataFrame({"outline": outlines, "leaves": leaves, "blocks": blocks})


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Outlines beside their host's pattern -> how often each pattern node is met, and with its own text."""
    for batch in batches:
        seen: dict[tuple[str, int], list[int]] = {}
        known: dict[str, Folded] = {}
        for host, outline, pattern in zip(*(batch.column(i).to_pylist() for i in range(3))):
            tree_ = known.get(pattern) or known.setdefault(pattern, unpack(pattern))
            for x, y in match(tree_, unpack(outline)):
                if x.children or y.children:
                    continue  # only what stands for a whole text can be template
                count = seen.setdefault((host, x.number), [0, 0])
                count[0] += 1
                count[1] += x.text == y.text
        rows = [(h, n, *c) for (h, n), c in seen.items()]
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "number", "pages", "same"])


def _extract(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for htmls, patterns, numbers, blocks in batches:
        known: dict[str, Folded] = {}
        out = []
        for html, pattern, constant, recurring in zip(htmls, patterns, numbers, blocks):
            top = tree(html)
            template: set[int] = set()
            if constant is not None and len(constant):
                constant = set(constant)
                tree_ = known.get(pattern) or known.setdefault(pattern, unpack(pattern))
                for x, y in match(tree_, fold(top)):
                    if x.number in constant and x.text == y.text and not y.children and not y.nodes[0].main:
                        template.update(map(id, y.nodes))
            inside = None if recurring is None or not _content(top) else set(recurring)
            out.append(extract(top, template, inside))
        yield pd.Series(out, dtype=object)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def wrappers(pages: DataFrame) -> DataFrame:
    """``pages`` (host, page_id, html) -> (host, pattern, numbers, blocks) of every host with enough pages.

    The outline of a host, its template nodes, and the keys of the template blocks inside articles and main parts.
    """
    outline = F.pandas_udf(_outlines, "outline string, leaves array<long>, blocks array<long>")
    outlines = stored(
        pages.select("host", "page_id", outline(F.coalesce("html", F.lit(""))).alias("of")).select("host", "page_id", "of.*"),
        "outlines",
    )
    different = outlines.groupBy("host", "outline").agg(
        F.min("page_id").alias("page_id"), F.min("leaves").alias("leaves"), F.min("blocks").alias("blocks")
    )
    different = stored(different, "different")
    hosts = stored(
        different.groupBy("host").agg(F.count("*").alias("all")).where(F.col("all") >= LEAST_PAGES), "hosts"
    )

    def recurring(keys: str) -> DataFrame:
        """(host, ``keys``): those on most of the host's different pages."""
        return (
            different.select("host", F.explode(keys).alias("key"))
            .groupBy("host", "key")
            .agg(F.count("*").alias("same"))
            .where(F.col("same") >= LEAST_PAGES * CONSTANT_SHARE)  # few are met on more than one page
            .join(hosts, "host")
            .where(F.col("same") >= F.col("all") * CONSTANT_SHARE)
            .groupBy("host")
            .agg(F.sort_array(F.collect_list("key")).alias(keys))
        )

    shared = recurring("leaves").withColumnRenamed("leaves", "shared")
    held = F.coalesce(F.size(F.array_intersect("leaves", "shared")), F.lit(0))
    # Stored between the join and the minimum, so that Spark may split the join and the minimum has partial ones.
    scored = different.join(hosts.join(shared, "host", "left"), "host")
    scored = stored(scored.select("host", "all", (-held).alias("less"), "page_id", "outline"), "scored")
    pattern = scored.groupBy("host", "all").agg(
        F.min_by("outline", F.struct("less", "page_id", "outline")).alias("pattern")
    )
    pattern = stored(pattern, "patterns")
    counts = (
        different.select("host", "outline")
        .join(pattern.select("host", "pattern"), "host")
        .mapInArrow(_learn, _COUNTS)
        .groupBy("host", "number")
        .agg(F.sum("pages").alias("pages"), F.sum("same").alias("same"))
    )
    constant = (
        counts.join(pattern.select("host", "all"), "host")
        .where((F.col("same") >= F.col("all") * CONSTANT_SHARE) & (F.col("number") > 0))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("number")).alias("numbers"))
    )
    return (
        pattern.join(constant, "host", "left")
        .join(recurring("blocks"), "host", "left")
        .select("host", "pattern", "numbers", F.coalesce("blocks", F.array().cast("array<long>")).alias("blocks"))
    )


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text) of every page: its blocks in order, two newlines between them."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    learned = stored(wrappers(rows.select("host", "page_id", "html")), "wrappers")
    text = F.pandas_udf(_extract, "string")
    return rows.join(learned, "host", "left").select(
        "page_id", "url", text(F.coalesce("html", F.lit("")), "pattern", "numbers", "blocks").alias("text")
    )
