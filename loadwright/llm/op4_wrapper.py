"""Main text of web pages by wrapper induction.

Every page becomes a tree of block elements; runs of equally built siblings
(list items, paragraphs) fold into one node.  Pages of a host with the same
labels down to ``LAYOUT_DEPTH`` are a layout (those of a layout with fewer than
``MIN_PAGES`` pages go with the host's largest).  Per layout the commonest
folded tree is the reference; every other tree is aligned with it by simple
tree matching.  A node whose text is the same on at least ``CONSTANT`` of the
layout's pages that have the node (``MIN_PAGES`` or more) is template; the
slots whose text varies are content, in an ``article`` or not.  Where a page
has no template, the ``article`` or ``main`` elements are its content if they
hold half of its text or more.  Lists of links outside them are no content.

What the markup itself declares as navigation, header, footer, aside or hidden
takes no part.  Names
(``NAMES`` in class or id) and forms are left out as well, unless the page's
main text lies in them (``_leave_out``): adverts and comments vary from page
to page, so no template shows them.

All pages of a host take part, by counts: pages meet only as (host, tree,
node, text hash) with a number, combined before the shuffle, so a host with a
third of all pages is no hot group.

Copies: a page that the template would leave less than ``FAIR`` of its text (of
its articles' if they hold half of it) is taken for a copy, not for a page
that is mostly template.  All copies of a host with the same template texts
then count as one page, and the host's template is found anew; so mirrors of
an article that differ in a line keep it.  A page whose every block would still
be template keeps its blocks.

Inside an article a name leaves out paragraphs, headings, lists' items and tables
only if it says advert or comment; a name that can mean the text itself
(``UNSURE``) leaves out an element there only if it is mostly links.

Blocks end at block elements and at ``br``.  Character references are
decoded, white space in a block becomes one space, blocks are joined by \\n.

Cases: null and empty html give an empty text; broken or cut markup is read
as far as it goes (an unclosed tag at the end is dropped, a quote that is never
closed is none, an unclosed script, style or comment ends the page, an unclosed
button, label, option or title ends with its parent or at the next block).  Reading a page takes
time in proportion to its length.  Trees of any size are aligned exactly: in
time by the pairs of nodes that neither trimming equal ends nor folding
removes, in memory by the nodes (``CELLS``).  A page without a
host in its url has no host template; repeated pages are pages each; an empty
table gives an empty result; other columns pass through in a struct.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from functools import lru_cache
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, small_batches, table

CONSTANT = 0.8
MIN_PAGES = 5
LINK_SHARE = 0.6
LAYOUT_DEPTH = 3  # html, body and the parts of the page
MAX_DEPTH = 60  # deeper elements count to their ancestor at this depth
FAIR = 0.25  # a template that leaves a page less than this of its text was found on copies
CELLS = 1_000_000  # numbers an alignment holds, or the square root of the pairs of children; the others are found again
BROADCAST_ROWS = 100_000  # template lists (a few hundred bytes each) small enough to send

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul search".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noframes".split())  # no markup inside
MUTED = frozenset("select datalist optgroup option button label svg math object template".split())  # controls and pictures
DROPPED = frozenset("nav footer aside menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar".split())
# Words of class and id attributes that declare a part outside the main text.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright discussion disqus footer gdpr login masthead menu modal nav navbar navigation "
    "newsletter notice notification overlay pager pagination popup promo promoted promotion related reply replies "
    "respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget".split()
)
# Words that make a name tell how the main text is laid out ("has-sidebar").
MODIFIERS = frozenset("has with without no layout".split())
# Adverts and comments: these words hold for ids (mostly anchors) and paragraphs of an article too.
OWN_IDS = frozenset("ad ads advert adverts advertisement advertising comment comments disqus respond sponsored".split())
# Words that may as well describe the article's own text ("share price").
UNSURE = frozenset(
    "alert aside banner copyright discussion header login notice notification overlay promotion related reply replies "
    "search share sharing social".split()
)
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd pre blockquote figure figcaption table thead tbody tfoot tr td th".split())
LEFT = 0.1  # less than this of the text outside named elements: the names are not believed
CLOSES = {  # an opening tag closes these open ones
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
_OPEN = re.compile(r"<(?:!--|/?[a-zA-Z]|[!?/])")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_KEY = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(\s*=\s*)?")
_BARE = re.compile(r"[^\s>]*")
_GAP = re.compile(r"[\s/]*")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Tags:
    """A page's markup, read once from left to right: every search starts
    behind what was read before, and what is once not found is not looked for again."""

    def __init__(self, html: str):
        self.html = html
        self.absent: set[str] = set()
        self.ahead: dict[str, int] = {}

    def find(self, what: str, pos: int) -> int:
        at = -1 if what in self.absent else self.html.find(what, pos)
        if at < 0:
            self.absent.add(what)
        return at

    def next_tag(self, what: str, pos: int) -> int:
        """Where the next ``<name`` or ``</name`` starts, the page's length if nowhere."""
        at = self.ahead.get(what, -1)
        if at < pos:
            m = re.compile(rf"{what}(?![\w:-])", re.I).search(self.html, pos)
            at = self.ahead[what] = m.start() if m else len(self.html)
        return at

    def closed(self, tag: str, pos: int) -> bool:
        """Whether an element opened before ``pos`` is closed before the next of its kind."""
        end = self.next_tag(f"</{tag}", pos)
        return end < len(self.html) and end < self.next_tag(f"<{tag}", pos)

    def next(self, pos: int):
        """The next tag or comment: start, end, whether a closing tag, name ("": none), attributes.

        Quotes count where a value starts, if they are closed anywhere; of a
        repeated attribute the first counts.
        """
        html = self.html
        m = _OPEN.search(html, pos)
        if m is None:
            return None
        start, opened = m.start(), m.group()
        if not opened[-1].isalpha():
            mark = "-->" if opened == "<!--" else ">"
            end = self.find(mark, start + 2)
            return start, len(html) if end < 0 else end + len(mark), False, "", {}
        closing = opened[1] == "/"
        m = _NAME.match(html, start + 1 + closing)
        tag, pos = m.group().lower(), m.end()
        attrs: dict[str, str] = {}
        while True:
            m = _KEY.match(html, pos)
            if m is None:
                break
            pos, value = m.end(), ""
            if m.group(2):
                quote = html[pos : pos + 1]
                end = self.find(quote, pos + 1) if quote in ("'", '"') else -1
                if end >= 0:
                    value, pos = html[pos + 1 : end], end + 1
                else:
                    m2 = _BARE.match(html, pos)
                    value, pos = m2.group().strip("\"'"), m2.end()
            attrs.setdefault(m.group(1).lower(), value)
        pos = _GAP.match(html, pos).end()
        if pos >= len(html):
            return start, len(html), False, "", {}
        return start, pos + 1, closing, tag, attrs


def left_out(tag: str, attrs: dict[str, str], in_main: bool) -> bool:
    """Whether an element is declared to be no main text."""
    if tag in DROPPED or "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role") in ROLES:
        return True
    return tag == "header" and not in_main


def named_out(tag: str, attrs: dict[str, str], in_main: bool) -> str:
    """Whether its name suggests so (or it is a form): "" no, "yes" unless the
    page's text overrules it, "links" if it is mostly links."""
    if tag in ("body", "html", "main"):
        return ""
    if tag == "form" or attrs.get("role") == "form":
        return "yes"
    words = {w.lower() for w in _PARTS.findall(attrs.get("class", ""))}
    ids = {w.lower() for w in _PARTS.findall(attrs.get("id", ""))}
    if in_main:
        ids &= OWN_IDS if tag not in ("h1", "h2", "h3", "h4", "h5", "h6") else frozenset()
        if tag in TEXTUAL:
            words &= OWN_IDS
    words |= ids
    if words & MODIFIERS:
        return ""
    found = words & NAMES
    if in_main and found:
        return "yes" if found - UNSURE else "links"
    return "yes" if found or (not in_main and "header" in words) else ""


class Page:
    """Block elements in page order (parent, label) and blocks of text."""

    def __init__(self, html: str | None):
        self.parent, self.label, depth = [-1], ["#"], [0]
        self.blocks: list[tuple[int, str, bool, float]] = []  # node, text, in main, share of link text
        # tag, node, left out, in main, the named elements around
        stack: list[tuple[str, int, bool, bool, tuple[int, ...]]] = [("#", 0, False, False, ())]
        named: list[bool] = []  # named elements: whether an article or main lies in them
        unsure: set[int] = set()  # those left out only if mostly links
        around: list[tuple[int, ...]] = []  # each block's named elements
        text: list[str] = []
        linked, links, pos, html = 0, 0, 0, html or ""
        tags = Tags(html)
        # The control or picture being read, whether its end tag can be trusted, blocks open in it.
        mute, trusted, inner = "", False, []

        def flush():
            nonlocal linked
            words = " ".join("".join(text).split())
            _, node, out, main, names = stack[-1]
            if words and not out:
                self.blocks.append((node, words, main, linked / len(words)))
                around.append(names)
            text.clear()
            linked = 0

        def add(raw: str):
            nonlocal linked
            if raw and not mute:
                raw = entities.unescape(raw)
                text.append(raw)
                if links:
                    linked += len(raw)

        while True:
            found = tags.next(pos)
            if found is None:
                add(html[pos:])
                break
            start, end, closing, tag, attrs = found
            add(html[pos:start])
            pos = end
            if not tag:
                continue
            if tag in RAW and not closing:
                end = tags.next_tag(f"</{tag}", pos)
                if end < len(html) or tag in ("script", "style"):
                    pos = end
                elif not mute:
                    mute, trusted = tag, False
                continue
            if tag == "a":
                links = 0 if closing else 1
            if tag in MUTED:
                if closing and (tag == mute or mute in ("option", "optgroup") and tag in ("select", "datalist")):
                    mute = ""
                elif not closing and not mute and not html.endswith("/>", start, pos):
                    mute, trusted, inner = tag, tag != "option" and tags.closed(tag, pos), []
                continue
            if mute and tag in BLOCKS:
                if trusted and not closing:
                    inner.append(tag)
                    continue
                if trusted and tag in inner:
                    while inner.pop() != tag:
                        pass
                    continue
                if not trusted or any(up[0] == tag for up in stack):
                    mute = ""
            if mute:
                continue
            if tag == "br":
                flush()
            if tag not in BLOCKS:
                continue
            flush()
            if closing:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
                continue
            links = 0
            if stack[-1][0] == "p":  # a block element ends an open paragraph
                stack.pop()
            while len(stack) > 1 and stack[-1][0] in CLOSES.get(tag, ()):
                stack.pop()
            if tag in VOID:
                continue
            _, up, out, outer, names = stack[-1]
            main = outer or tag in ("article", "main") or attrs.get("role") == "main" or "articleBody" in attrs.get("itemprop", "")
            out = out or left_out(tag, attrs, main)
            if main and not outer:
                for k in names:
                    named[k] = True
            name = named_out(tag, attrs, main) if len(names) < MAX_DEPTH else ""
            if name:
                if name == "links":
                    unsure.add(len(named))
                names = (*names, len(named))
                named.append(False)
            node = up
            if depth[up] < MAX_DEPTH:
                node = len(self.parent)
                self.parent.append(up)
                self.label.append(tag if not attrs.get("class") else f"{tag}.{'.'.join(sorted(attrs['class'].split()))}")
                depth.append(depth[up] + 1)
            stack.append((tag, node, out, main, names))
        flush()
        if named:
            self._leave_out(named, around, unsure)

    def _leave_out(self, named: list[bool], around: list[tuple[int, ...]], unsure: set[int]) -> None:
        """Drop the blocks of named elements, but for those elements that hold the main text.

        One around an article keeps it if it has half of the text or more,
        that of named elements without an article apart.  One without does if
        next to nothing (``LEFT``) is found outside named elements, on a page
        without article or, for one in an article, in articles.
        """
        held: dict[tuple[int, bool], int] = {}  # characters by named element; all, in main
        page, free = {False: 0, True: 0}, {False: 0, True: 0}
        own = [0] * len(named)  # characters outside named elements without an article
        rest = 0
        for (_, text, main, _), names in zip(self.blocks, around, strict=True):
            if all(named[k] for k in names):
                rest += len(text)
                for k in names:
                    own[k] += len(text)
            for scope in {False, main}:
                page[scope] += len(text)
                free[scope] += 0 if any(not named[k] for k in names) else len(text)
                for k in names:
                    held[k, scope] = held.get((k, scope), 0) + len(text)
        within = {k: held[k, False] == held.get((k, True), 0) for k, scope in held if not scope}
        of_links = dict.fromkeys(unsure, 0.0)
        for (_, text, _, share), names in zip(self.blocks, around, strict=True):
            for k in unsure.intersection(names):
                of_links[k] += len(text) * share
        back = {k for k in unsure if of_links[k] < LINK_SHARE * held.get((k, False), 0)}
        for k, article in enumerate(named):
            if (k, False) not in held:
                continue
            if article:
                if 2 * own[k] >= rest:
                    back.add(k)
            else:
                scope = within[k]
                if (scope or not free[True]) and free[scope] < LEFT * page[scope] and 2 * held[k, scope] >= page[scope]:
                    back.add(k)
        self.blocks = [b for b, names in zip(self.blocks, around, strict=True) if back.issuperset(names)]

    def content(self) -> list[tuple[int, str]]:
        """The content where the page's host gives no template."""
        keep = chosen([t for _, t, _, _ in self.blocks], [main for _, _, main, _ in self.blocks], [x >= LINK_SHARE for *_, x in self.blocks], False)
        return [self.blocks[i][:2] for i in keep]

    def layout(self) -> int:
        """A hash of the labels near the root."""
        paths = [""]
        depth = [0]
        for up, label in zip(self.parent[1:], self.label[1:], strict=True):
            depth.append(depth[up] + 1)
            paths.append(f"{paths[up]} {_escape(label)}" if depth[-1] <= LAYOUT_DEPTH else "")
        return text_hash("\n".join(sorted(set(paths))))

    def folded(self) -> tuple[str, list[int]]:
        """The tree with equal neighbours folded, as nested brackets, and the
        folded tree's node (in page order) of each node."""
        n = len(self.parent)
        children: list[list[int]] = [[] for _ in range(n)]
        shape = [""] * n
        twin = list(range(n))  # the earlier sibling a node folds into
        for i in range(n - 1, -1, -1):
            kids = children[i][::-1]
            shapes, first = [], []
            for k in kids:
                if shapes and shapes[-1] == shape[k]:
                    twin[k] = first[-1]
                else:
                    shapes.append(shape[k])
                    first.append(k)
            shape[i] = f"({_escape(self.label[i])}{''.join(shapes)})"
            if i:
                children[self.parent[i]].append(i)
        # Number the kept nodes; a folded node's subtree goes with its twin's, place by place.
        number, at, count = [-1] * n, [0] * n, 0
        todo = [(0, 0)]
        place: dict[tuple[int, int], int] = {}
        order: list[int] = []
        while todo:
            i, canon = todo.pop()
            at[i] = canon
            if canon == i:
                order.append(i)
            kids, kept = children[i][::-1], 0
            for k in kids:
                if twin[k] == k:
                    slot = (canon, kept)
                    place.setdefault(slot, k)
                    at[k] = place[slot]
                    kept += 1
                else:
                    at[k] = at[twin[k]]
            todo += [(k, at[k]) for k in reversed(kids)]
        for i in order:
            number[i] = count
            count += 1
        return shape[0], [number[at[i]] for i in range(n)]


def chosen(texts: list[str], main: list[bool], links: list[bool], templated: bool) -> list[int]:
    """Which blocks are content, of those that are no template.

    With a template: all but lists of links outside article and main.
    Without: those in article and main if that is half of the text or more,
    else all but lists of links.
    """
    if not templated:
        own = sum(len(t) for t, m in zip(texts, main, strict=True) if m)
        if own and 2 * own >= sum(len(t) for t, m, x in zip(texts, main, links, strict=True) if m or not x):
            return [i for i, m in enumerate(main) if m]
    return [i for i, x in enumerate(links) if not x or templated and main[i]]


def _escape(label: str) -> str:
    return re.sub(r"[()\s]", "_", label)


def tree_of(text: str) -> list[tuple[str, list[int]]]:
    """Nested brackets back to (label, children) in page order."""
    nodes: list[tuple[str, list[int]]] = []
    stack: list[int] = []
    for m in re.finditer(r"\(([^()]*)|\)", text):
        if m.group() == ")":
            stack.pop()
            continue
        if stack:
            nodes[stack[-1]][1].append(len(nodes))
        stack.append(len(nodes))
        nodes.append((m.group(1), []))
    return nodes


class Reference:
    """A tree with, of each label, its nodes and their children as one array in page order.

    A node has a slot before its children, so that running maxima of all the
    nodes' children are taken at once (``owner`` is the slot's node's place).
    """

    def __init__(self, text: str):
        self.nodes = tree_of(text)
        n = len(self.nodes)
        self.end = list(range(1, n + 1))  # past the last node below
        for i in range(n - 1, -1, -1):
            if self.nodes[i][1]:
                self.end[i] = self.end[self.nodes[i][1][-1]]
        self.known: dict[tuple, int] = {}
        self.ids = subtree_ids(self.nodes, self.known)
        by_label: dict[str, list[int]] = {}
        for i, (label, _) in enumerate(self.nodes):
            by_label.setdefault(label, []).append(i)
        self.slots = {label: self._slots(of) for label, of in by_label.items()}

    def _slots(self, of: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        at, child, owner = [0], [], []
        for place, i in enumerate(of):
            child += [-1, *self.nodes[i][1]]
            owner += [place] * (1 + len(self.nodes[i][1]))
            at.append(len(child))
        return tuple(np.array(x, dtype=np.int64) for x in (of, at, child, owner))


@lru_cache(maxsize=4)
def reference_of(text: str) -> Reference:
    return Reference(text)


def subtree_ids(tree: list[tuple[str, list[int]]], known: dict[tuple, int]) -> list[int]:
    """Equal numbers for equal subtrees; ``known`` has those of other trees and is added to."""
    ids = [0] * len(tree)
    for i in range(len(tree) - 1, -1, -1):
        ids[i] = known.setdefault((tree[i][0], *[ids[k] for k in tree[i][1]]), len(known))
    return ids


def align(page: str, reference: str) -> list[int]:
    """Simple tree matching: for each node of a page's tree its node in the reference, or -1.

    Children of matched nodes are matched in order so that most nodes match.
    Equal subtrees at both ends match each other (some best matching has them);
    what lies between is weighed by all pairs, whatever their number: a node
    against all nodes of the reference at a time, so that only one array per
    level of the tree is held.
    """
    a, ref = tree_of(page), reference_of(reference)
    b = ref.nodes
    if page == reference:
        return list(range(len(a)))
    out = [-1] * len(a)
    ida, idb = subtree_ids(a, dict(ref.known)), ref.ids

    def weights(u: int, lo: int, hi: int, held: dict[int, np.ndarray], regions: dict) -> np.ndarray:
        """The most nodes that ``u``'s subtree can match with that of each node from ``lo`` to ``hi``; a last 0."""
        row = held.get(ida[u])
        if row is not None:
            return row
        label, kids = a[u]
        row = np.zeros(hi - lo + 1, dtype=np.int64)
        if label in ref.slots:
            if label not in regions:
                of, at, child, owner = ref.slots[label]
                i, j = np.searchsorted(of, (lo, hi))
                s, e = at[i], at[j]
                child = child[s:e]
                regions[label] = (
                    of[i:j] - lo, at[i + 1 : j + 1] - s - 1, np.where(child < 0, hi - lo, child - lo), (owner[s:e] - i) * (len(b) + 1),
                )
            of, last, child, start = regions[label]
            if len(of):
                # Each node's running best starts above the one before's, so one running maximum serves all.
                best = start
                for k in kids if len(child) > len(of) else ():
                    if a[k][0] in ref.slots:
                        step = best.copy()
                        np.maximum(step[1:], best[:-1] + weights(k, lo, hi, held, regions)[child[1:]], out=step[1:])
                        best = np.maximum.accumulate(step)
                row[of] = 1 + best[last] - start[last]
        if (len(held) + 1) * len(row) <= CELLS:
            held[ida[u]] = row
        return row

    def paired(x: list[int], y: list[int]) -> list[tuple[int, int]]:
        """Pairs of two lists of children that let the most nodes match."""
        head, p, q = 0, len(x), len(y)
        while head < min(p, q) and ida[x[head]] == idb[y[head]]:
            head += 1
        while p > head and q > head and ida[x[p - 1]] == idb[y[q - 1]]:
            p, q = p - 1, q - 1
        return [*zip(x[:head], y[:head], strict=True), *between(x[head:p], y[head:q]), *zip(x[p:], y[q:], strict=True)]

    def between(x: list[int], y: list[int]) -> list[tuple[int, int]]:
        if not x or not y:
            return []
        if len(x) == 1 == len(y):
            return [(x[0], y[0])] if a[x[0]][0] == b[y[0]][0] else []
        lo, hi = y[0], ref.end[y[-1]]
        at, held, regions = np.array(y) - lo, {}, {}

        def block(best: np.ndarray, some: list[int]) -> list[np.ndarray]:
            rows = [best]
            for u in some:
                here = rows[-1].copy()
                np.maximum(here[1:], rows[-1][:-1] + weights(u, lo, hi, held, regions)[at], out=here[1:])
                rows.append(np.maximum.accumulate(here))
            return rows

        # Every ``size``-th row is kept, and those between are found again on the way back.
        size = max(CELLS // len(y), isqrt(len(x)), 1)
        rows = [np.zeros(len(y) + 1, dtype=np.int64)]
        kept = []
        for k in range(0, len(x), size):
            kept.append(rows[-1])
            rows = block(rows[-1], x[k : k + size])
        pairs, q = [], len(y)
        for k in range(len(kept) - 1, -1, -1):
            if k < len(kept) - 1:
                rows = block(kept[k], x[k * size : (k + 1) * size])
            p = len(rows) - 1
            while p and q:
                if rows[p][q] == rows[p - 1][q]:
                    p -= 1
                elif rows[p][q] == rows[p][q - 1]:
                    q -= 1
                else:
                    p, q = p - 1, q - 1
                    pairs.append((x[k * size + p], y[q]))
        return pairs[::-1]

    todo = [(0, 0)] if a and b and a[0][0] == b[0][0] else []
    while todo:
        i, j = todo.pop()
        out[i] = j
        x, y = a[i][1], b[j][1]
        todo += zip(x, y, strict=True) if ida[i] == idb[j] else paired(x, y)
    return out


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def parsed_pages(pages: DataFrame) -> DataFrame:
    """Stored once: page (all columns but html), host, tree, layout, and of all blocks
    nodes, hashes, sizes, texts, marks (1 in article or main, 2 mostly link text)."""
    small_batches(pages.sparkSession)

    @F.pandas_udf("tree string, layout long, nodes array<int>, hashes array<long>, sizes array<int>, texts array<string>, marks array<tinyint>")
    def parse(html: pd.Series) -> pd.DataFrame:
        rows = []
        for h in html:
            page = Page(h)
            tree, number = page.folded()
            blocks = page.blocks
            rows.append((
                tree,
                page.layout(),
                np.array([number[n] for n, *_ in blocks], dtype=np.int32),
                np.array([text_hash(t) for _, t, *_ in blocks], dtype=np.int64),
                np.array([len(t) for _, t, *_ in blocks], dtype=np.int32),
                [t for _, t, *_ in blocks],
                np.array([main + 2 * (share >= LINK_SHARE) for *_, main, share in blocks], dtype=np.int8),
            ))
        return pd.DataFrame(rows, columns=["tree", "layout", "nodes", "hashes", "sizes", "texts", "marks"])

    rest = [c for c in pages.columns if c != "html"]
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    out = pages.select(F.struct(*rest).alias("page"), host.alias("host"), parse(F.col("html")).alias("p"))
    return materialise(out.select("page", "host", "p.*"), "pages")


def templates(parsed: DataFrame) -> DataFrame:
    """(host, tree, drop): of the trees that hold template nodes, a list of
    "node:hash" of the constant texts.  ``parsed`` has a weight: the part of a
    page that a row counts for."""
    least = MIN_PAGES - 1e-6  # parts of a page add up but for rounding

    @F.pandas_udf("array<int>")
    def aligned(tree: pd.Series, reference: pd.Series) -> pd.Series:
        return pd.Series([align(t, r) for t, r in zip(tree, reference, strict=True)])

    hosted = parsed.where("host <> ''")
    trees = materialise(hosted.groupBy("host", "layout", "tree").agg(F.sum("weight").alias("n")), "trees")
    layouts = trees.groupBy("host", "layout").agg(F.sum("n").alias("pages"), F.max(F.struct("n", "tree"))["tree"].alias("reference"))
    layouts = materialise(layouts, "layouts")
    largest = F.max(F.struct("pages", "layout", "reference"))
    hosts = layouts.groupBy("host").agg(F.sum("pages").alias("pages"), largest.alias("most")).where(F.col("pages") >= least)
    hosts = materialise(
        layouts.withColumnRenamed("pages", "own").join(hosts, "host").select(
            "host", "layout", *[F.when(F.col("own") >= least, F.col(c)).otherwise(F.col("most")[c]).alias(a) for c, a in (("layout", "cluster"), ("reference", "of"))]
        ),
        "hosts",
    )
    maps = trees.join(hosts, ["host", "layout"]).select("host", "cluster", "tree", "n", F.posexplode(aligned("tree", "of")).alias("node", "ref"))
    maps = materialise(maps.where("ref >= 0"), "alignment")
    having = maps.groupBy("host", "cluster", "ref").agg(F.sum("n").alias("pages"))
    maps = maps.drop("n")
    # Distinct texts of a page's node, counted before they meet the alignment.
    seen = hosted.select("host", "tree", "weight", F.explode(F.array_distinct(F.arrays_zip("nodes", "hashes"))).alias("b"))
    seen = seen.groupBy("host", "tree", F.col("b.nodes").alias("node"), F.col("b.hashes").alias("hash")).agg(F.sum("weight").alias("n"))
    common = (
        seen.join(maps, ["host", "tree", "node"])
        .groupBy("host", "cluster", "ref", "hash").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
        .join(having, ["host", "cluster", "ref"])
        .where(F.col("n") >= F.col("pages") * CONSTANT - 1e-6)
        .select("host", "cluster", "ref", "hash")
    )
    common = materialise(common, "constant")
    drop = F.concat(F.col("node").cast("string"), F.lit(":"), F.col("hash").cast("string"))
    return materialise(
        maps.join(common, ["host", "cluster", "ref"]).groupBy("host", "tree").agg(F.collect_set(drop).alias("drop")), "templates"
    )


def with_template(parsed: DataFrame, wrapper: DataFrame) -> DataFrame:
    """``parsed`` plus its tree's ``drop`` (null: none)."""
    if wrapper.count() <= BROADCAST_ROWS:
        wrapper = F.broadcast(wrapper)
    return parsed.join(wrapper, ["host", "tree"], "left")


def copied(parsed: DataFrame, wrapper: DataFrame) -> DataFrame:
    """Pages without their texts, plus ``same``: a hash of the template texts of a
    page that they would leave less than ``FAIR`` of its text, else null."""

    @F.pandas_udf("long")
    def same(nodes: pd.Series, hashes: pd.Series, sizes: pd.Series, marks: pd.Series, drop: pd.Series) -> pd.Series:
        rows = []
        for ns, hs, zs, ms, d in zip(nodes, hashes, sizes, marks, drop, strict=True):
            d = set() if d is None else set(d)
            gone = np.array([f"{n}:{h}" in d for n, h in zip(ns, hs, strict=True)], dtype=bool)
            main, free = (ms & 1) > 0, (ms & 3) != 2
            scope = main if 2 * zs[main].sum() >= zs[free].sum() and main.any() else free
            few = gone.any() and zs[scope & ~gone].sum() < FAIR * zs[scope].sum()
            rows.append(text_hash(" ".join(sorted({str(h) for h in hs[gone]}))) if few else None)
        return pd.Series(rows, dtype="Int64")

    slim = with_template(parsed.drop("page", "texts"), wrapper)
    return slim.withColumn("same", same("nodes", "hashes", "sizes", "marks", "drop")).drop("drop", "sizes", "marks")


def wrappers(parsed: DataFrame) -> DataFrame:
    """``templates``, found anew with copies as one page on the hosts that have some."""
    wrapper = templates(parsed.withColumn("weight", F.lit(1.0)))
    pages = copied(parsed, wrapper)
    groups = materialise(pages.where("same IS NOT NULL").groupBy("host", "same").agg((1 / F.count("*")).alias("part")), "copies")
    if groups.isEmpty():
        return wrapper
    hosts = groups.select("host").distinct()
    again = pages.join(hosts, "host", "left_semi").join(groups, ["host", "same"], "left")
    again = materialise(again.withColumn("weight", F.coalesce("part", F.lit(1.0))).drop("same", "part"), "copied")
    return wrapper.join(hosts, "host", "left_anti").unionByName(templates(again))


def main_text(pages: DataFrame) -> DataFrame:
    """``page`` (a struct of the columns but html) and its main ``text``."""
    parsed = parsed_pages(pages)
    joined = with_template(parsed, wrappers(parsed))

    @F.pandas_udf("string")
    def text(nodes: pd.Series, hashes: pd.Series, texts: pd.Series, marks: pd.Series, drop: pd.Series) -> pd.Series:
        rows = []
        for ns, hs, ts, ms, d in zip(nodes, hashes, texts, marks, drop, strict=True):
            kept = list(range(len(ts)))
            if d is not None:
                d = set(d)
                kept = [i for i in kept if f"{ns[i]}:{hs[i]}" not in d]
            templated = d is not None and bool(kept)
            kept = kept or list(range(len(ts)))
            own = chosen([ts[i] for i in kept], [bool(ms[i] & 1) for i in kept], [bool(ms[i] & 2) for i in kept], templated)
            rows.append("\n".join(ts[kept[i]] for i in own))
        return pd.Series(rows, dtype=object)

    return joined.select("page", text("nodes", "hashes", "texts", "marks", "drop").alias("text"))


def op4_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select(
        F.col("page.page_id").alias("page_id"), F.col("page.url").alias("url"), "text",
        F.length("text").cast("long").alias("n_chars"),
    )


QUERIES = {"op4_wrapper_text": op4_wrapper_text}
ORACLES: dict[str, str] = {}
