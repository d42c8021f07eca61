"""Main text of HTML pages by composite text density.

A page is cut into tags and text runs once, from left to right, and becomes a tree of its block elements; inline tags count for the
block they stand in. For every node the characters of its subtree are divided by its tags, and this density is scaled by how
little of the text and of the tags are links, relative to the links of the whole body. The density sum of a node adds up the
densities of its children, its own text being one of them. The subtree with the greatest density sum is the main one; the least
density on its path up to the body is the threshold, and further subtrees beside that path that reach it, with and without the
scaling (which favours very short texts), are content as well.
Where the page marks its article (``article``, ``main``, ``role=main``, ``itemprop=articleBody``), the search stays within these and the
marked element that holds the found subtree is taken whole.

What is never text does not become a node: scripts, styles, markup, forms and their controls, navigation, footers, asides, headers
outside an article, hidden elements, and elements whose role, class or id says that they are menus, notices, adverts, sidebars, sharing
links or reader comments. A class or id does not remove an element that holds an article, a ``main`` or a first heading.

White space (Unicode's, decoded no-break spaces included) inside a block becomes one space; ``br`` is white space; blocks that
are not empty are joined by a line feed in page order. Unclosed elements end with their parents; what follows a tag that
never ends is dropped, as browsers do. Null and empty pages, and pages without a body text, give an empty text. Rows are
independent: repeated rows give repeated results, and all other columns travel inside ``row``. Texts of any length are taken
whole, in time proportional to their length.
"""

from __future__ import annotations

import math
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import packed, row_slices

# HTML's element kinds and the words that name what is not main text.
VOID = frozenset("area base br col embed frame hr img input keygen link meta param source track wbr".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup html legend li listing main menu nav ol optgroup option p pre search section summary table tbody
    td tfoot th thead title tr ul""".split()
)
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
DROPPED = frozenset(
    """aside audio button canvas datalist dialog fieldset footer form head iframe input label legend map menu nav noembed noframes
    noscript object optgroup option script search select style svg template textarea title video""".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar tooltip".split())
NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies
    discussion disqus footer form gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices notification
    outbrain pager pagination popup promo promos promotion recommended related replies respond search share sharing sidebar sidebars
    signup skip social sponsor sponsored subscribe subscription taboola toolbar""".split()
)
#: Words beside which such a name says only that a page has the part, and classes of nested articles that are not the article.
RELATIONS = frozenset(("has", "no", "with", "without"))
SIDE_ARTICLES = frozenset("ad advert advertisement comment promo promoted related reply sponsored teaser".split())
ENDS_P = BLOCK - {"body", "caption", "head", "html", "legend", "option", "optgroup", "tbody", "td", "tfoot", "th", "thead", "title", "tr"}
#: Elements that a start tag ends, and the elements at which the search for them stops.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    **{f"h{i}": ({f"h{j}" for j in range(1, 7)}, BLOCK - {f"h{j}" for j in range(1, 7)}) for i in range(1, 7)},
}

_TAG = re.compile(r"""<(/?)([A-Za-z][^\t\n\f\r />]*+)((?>[^>"'=]++|=[\t\n\f\r ]*+"[^"]*+"|=[\t\n\f\r ]*+'[^']*+'|["'=])*+)>""")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>]|$)""", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_HOLDS_MAIN = re.compile(r"<(?:article|main|h1)[\s/>]", re.I)
_COMMENT_END = re.compile(r"--!?>")


class _Page:
    """The block tree of one page: parents, own characters, link characters, tags and link tags, and the text runs in page order."""

    def __init__(self, html: str):
        self.parent, self.chars, self.linked, self.tags, self.link_tags, self.marked = [-1], [0], [0], [0], [0], [False]
        self.runs: list[tuple[int, str]] = []
        self._node, self._text, self._linked_run = 0, [], 0
        self._link_of = -1  # the node in which the open link began
        self._stack: list[tuple[str, int]] = [("", 0)]
        self._open: dict[str, int] = {}
        self._dropped = 0  # height of the stack at the outermost dropped element, 0 outside of one
        self._holders = [m.start() for m in _HOLDS_MAIN.finditer(html)]
        self._passed = 0
        self._read(html)
        self._flush()

    def _read(self, html: str) -> None:
        at, size, find = 0, len(html), html.find
        while at < size:
            lt = find("<", at)
            if lt < 0:
                self._chars(html[at:])
                return
            if lt > at:
                self._chars(html[at:lt])
            tag = _TAG.match(html, lt)
            if tag:
                at = tag.end()
                name = tag[2].lower()
                if tag[1]:
                    self._end(name)
                    continue
                self._start(name, tag[3], html, at)
                if name in RAW:
                    close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
                    at = close.start() if close else size
                elif name == "plaintext":
                    self._chars(html[at:])
                    return
                continue
            after = html[lt + 1 : lt + 3]
            if after[:1].isascii() and (after[:1].isalpha() or after[:1] == "/" and after[1:].isascii() and after[1:].isalpha()):
                return  # a tag that never ends
            if html.startswith("<!--", lt):
                if html.startswith((">", "->"), lt + 4):
                    at = find(">", lt) + 1
                else:
                    close = _COMMENT_END.search(html, lt + 4)
                    at = close.end() if close else size
            elif after[:1] in ("!", "?") and after or after[:1] == "/" and len(after) > 1:
                close = find(">", lt)
                at = close + 1 if close >= 0 else size
            else:
                self._chars("<")
                at = lt + 1

    def _chars(self, text: str) -> None:
        if self._dropped:
            return
        if "&" in text:
            text = unescape(text)
        self._text.append(text)
        if self._link_of >= 0:
            self._linked_run += len("".join(text.split()))

    def _flush(self) -> None:
        if self._text:
            line = " ".join("".join(self._text).split())
            self._text.clear()
            if line:
                self.runs.append((self._node, line))
                self.chars[self._node] += len(line)
                self.linked[self._node] += min(self._linked_run, len(line))
        self._linked_run = 0

    def _start(self, name: str, rest: str, html: str, at: int) -> None:
        if name == "image":
            name = "img"
        if self._dropped:
            if name not in VOID and (name in BLOCK or name in DROPPED or name == self._stack[self._dropped][0]):
                self._close_implied(name, self._dropped - 1)
                if self._dropped:
                    self._push(name, self._node)
            if self._dropped:
                return
        else:
            self._close_implied(name, 0)
        marked, drop = self._judge(name, rest, html, at)
        if name in VOID:
            if not drop:
                self.tags[self._node] += 1
                if name in ("br", "hr", "img"):
                    self._text.append(" ")
                if name == "hr":
                    self._flush()
            return
        if drop:
            if name in BLOCK:
                self._flush()
            self._push(name, self._node)
            self._dropped = len(self._stack) - 1
            return
        if name not in BLOCK:
            self.tags[self._node] += 1
            if name == "a":
                self._link_of = self._node
                self.link_tags[self._node] += 1
            return
        if name in ("html", "body"):
            return
        self._flush()
        self.parent.append(self._node)
        for column in (self.chars, self.linked, self.link_tags):
            column.append(0)
        self.tags.append(1)
        self.marked.append(marked)
        self._node = len(self.parent) - 1
        self._push(name, self._node)

    def _judge(self, name: str, rest: str, html: str, at: int) -> tuple[bool, bool]:
        """Whether an element is marked as the article, and whether it is dropped."""
        marked = name in ("article", "main")
        if name in ("html", "body"):
            return False, False
        if name in DROPPED or name == "header" and not self._in_article():
            return False, True
        if rest and not rest.isspace():
            named = False
            for m in _ATTRIBUTE.finditer(rest):
                key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if key == "role":
                    marked |= value.lower() == "main"
                    if value.lower() in ROLES:
                        return False, True
                elif key == "itemprop":
                    marked |= value == "articleBody"
                elif key == "hidden" and value.lower() != "until-found" or key == "aria-hidden" and value.lower() == "true":
                    return False, True
                elif key == "style":
                    if _HIDDEN.search(value):
                        return False, True
                elif key in ("class", "id"):
                    words = {w.lower() for w in _WORD.findall(value)}
                    if self._in_article():
                        words.discard("header")
                    named |= RELATIONS.isdisjoint(words) and not NAMES.isdisjoint(words)
                    if name == "article" and not SIDE_ARTICLES.isdisjoint(value.lower().split()):
                        return False, True
            if named and not marked and name != "h1" and not self._holds_main(name, html, at):
                return False, True
        return marked, False

    def _in_article(self) -> bool:
        return bool(self._open.get("article") or self._open.get("main"))

    def _holds_main(self, name: str, html: str, at: int) -> bool:
        """Whether an article, a ``main`` or a first heading begins before the element ends."""
        while self._passed < len(self._holders) and self._holders[self._passed] < at:
            self._passed += 1
        if self._passed == len(self._holders):
            return False
        depth, limit = 1, self._holders[self._passed]
        for m in re.compile(rf"<(/?){re.escape(name)}(?=[\s/>])", re.I).finditer(html, at, limit):
            depth += -1 if m[1] else 1
            if not depth:
                return False
        return True

    def _push(self, name: str, node: int) -> None:
        self._stack.append((name, node))
        self._open[name] = self._open.get(name, 0) + 1

    def _pop_to(self, height: int) -> None:
        """Close all elements from this height of the stack on."""
        while len(self._stack) > height:
            name, node = self._stack.pop()
            self._open[name] -= 1
            if self._dropped and len(self._stack) <= self._dropped:
                if len(self._stack) == self._dropped:
                    self._dropped = 0
                continue
            if not self._dropped:
                self._flush()
                if self._link_of == node:
                    self._link_of = -1
                self._node = self.parent[node]

    def _close_implied(self, name: str, floor: int) -> None:
        if name in ENDS_P and self._open.get("p"):
            self._close({"p"}, {"button", "caption", "object", "table", "td", "th", "template"}, floor)
        if name in ENDED_BY:
            self._close(*ENDED_BY[name], floor)

    def _close(self, names, stops, floor: int) -> None:
        for height in range(len(self._stack) - 1, floor, -1):
            if self._stack[height][0] in names:
                self._pop_to(height)
                return
            if self._stack[height][0] in stops:
                return

    def _end(self, name: str) -> None:
        if name == "br":
            self._chars(" ")
        elif name == "a":
            if not self._dropped:
                self._link_of = -1
        if self._open.get(name):
            height = len(self._stack) - 1
            while self._stack[height][0] != name:
                height -= 1
            self._pop_to(height)
        elif name in BLOCK and name not in ("html", "body") and not self._dropped:
            self._flush()


def _densities(page: _Page) -> tuple[list[float], list[float], list[float], list[int]]:
    """Composite and plain density, density sum and the number after the last node of the subtree, for every node."""
    n = len(page.parent)
    chars, linked, tags, link_tags = (list(x) for x in (page.chars, page.linked, page.tags, page.link_tags))
    end = list(range(1, n + 1))
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        chars[up] += chars[i]
        linked[up] += linked[i]
        tags[up] += tags[i]
        link_tags[up] += link_tags[i]
        end[up] = max(end[up], end[i])
    share = linked[0] / chars[0] if chars[0] else 0.0

    def density(c: int, lc: int, t: int, lt: int) -> float:
        plain = c / max(t, 1)
        if not share or not c:
            return plain
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        return plain * math.log(c / max(lc, 1) * max(t, 1) / max(lt, 1)) / math.log(base)

    own = [density(*x) for x in zip(chars, linked, tags, link_tags)]
    total = [density(c, l, 1 + k, k) if c else 0.0 for c, l, k in zip(page.chars, page.linked, page.link_tags)]
    for i in range(1, n):
        total[page.parent[i]] += own[i]
    return own, [c / max(t, 1) for c, t in zip(chars, tags)], total, end


def main_text(html: str) -> str:
    page = _Page(html)
    if not page.runs:
        return ""
    own, plain, total, end = _densities(page)
    n = len(end)
    holds = [0] * (n + 1)
    for node, _ in page.runs:
        holds[node + 1] = 1
    for i in range(n):
        holds[i + 1] += holds[i]
    outer = [0] * n  # the outermost marked element around a node, itself included; 0 outside
    for i in range(1, n):
        outer[i] = outer[page.parent[i]] or (i if page.marked[i] else 0)
    inside = [i for i in range(1, n) if outer[i] and holds[end[outer[i]]] > holds[outer[i]]]
    if inside:
        best = outer[max(inside, key=lambda i: (total[i], -i))]
        return "\n".join(text for node, text in page.runs if best <= node < end[best])
    best = max(range(n), key=lambda i: (total[i], -i))
    path, on_path = best, {best}
    while path:
        path = page.parent[path]
        on_path.add(path)
    least, least_plain = min(own[i] for i in on_path), min(plain[i] for i in on_path)
    taken = [False] * n
    for i in range(n):
        up = page.parent[i]
        taken[i] = i == best or i not in on_path and (taken[up] or up in on_path and own[i] >= least and plain[i] >= least_plain)
    return "\n".join(text for node, text in page.runs if taken[node])


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``row`` (all columns of the page), its main ``text`` and the code points of that, ``n_chars``."""
    wide = packed(pages)

    def run(batches):
        for batch, htmls in row_slices(batches, html_column):
            texts = [main_text(h.decode()) for h in htmls]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), sizes], ["row", "text", "n_chars"])

    return wide.mapInArrow(run, f"row {wide.schema['row'].dataType.simpleString()}, text string, n_chars bigint")
