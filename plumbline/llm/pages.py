"""Main text of web pages by minimum-cut labelling of their text blocks.

A page becomes a list of text blocks. What speaks for or against a block (enclosing elements, class names, length,
link density) is summed into the capacity of its edge to the content or the boilerplate terminal; neighbours in page
order and siblings in the DOM are joined by smoothness edges. The minimum cut between the terminals labels the blocks,
so a short paragraph among long ones stays and a long advert inside a menu goes.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import groups, small_batches, with_doc

_TAG = re.compile(r"<(?:!--(?P<comment>.*?)(?:-->|$)|[!?][^>]*(?:>|$)|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)(?:>|$))", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
_NAME_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Elements whose content is never text of the page: scripts, styles, inert markup, drawings, and the controls of forms.
_DROPPED = {"script", "style", "template", "iframe", "svg", "select", "textarea", "button", "title", "datalist"}
_RAW = {"script", "style", "textarea", "title", "iframe", "template"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p",
    "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
# A start tag of the key ends an open element of the value.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_AGAINST = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset", "search"}
_AGAINST_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "menu", "menubar", "alert"}
_AGAINST_NAMES = {
    "ad", "ads", "adv", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "discussion",
    "disqus", "foot", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo", "promotion",
    "recommended", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "tags", "toolbar", "widget",
}
_FOR_NAMES = {"article", "body", "content", "entry", "main", "post", "story", "text"}
_STRONG = 9.0


@dataclass
class Element:
    """An open element: what it says about the blocks inside, and where it hangs."""

    name: str
    number: int
    for_: float = 0.0
    against: float = 0.0
    article: bool = False


@dataclass
class Block:
    """Text between block borders, with the element that holds it."""

    parent: Element
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    size: int = 0


def _element(name: str, rest: str, number: int, parent: Element) -> Element:
    e = Element(name, number, parent.for_, parent.against, parent.article)
    attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)} if rest.strip(" /") else {}
    names = {p.lower() for k in ("class", "id") for p in _NAME_PART.findall(attributes.get(k, ""))}
    role = attributes.get("role", "").lower()
    if name in ("article", "main") or role in ("main", "article") or attributes.get("itemprop", "").lower() == "articlebody":
        e.article, e.for_ = True, max(e.for_, 4.0)
    if name in _AGAINST or role in _AGAINST_ROLES or (name not in ("html", "body", "article", "main") and names & _AGAINST_NAMES):
        e.against = max(e.against, _STRONG + 4.0)
    elif name == "header" or "header" in names:
        e.against = max(e.against, 3.0 if e.article else _STRONG)
    elif names & _FOR_NAMES:
        e.for_ = max(e.for_, 3.0)
    return e


class _Skipper:
    """Finds where a dropped element of a page ends."""

    def __init__(self, page: str):
        self.page = page
        self.without: set[str] = set()  # names with no further end tag

    def _end(self, name: str, at: int) -> re.Match | None:
        found = None if name in self.without else re.compile(rf"</{name}\b[^>]*(?:>|$)", re.I).search(self.page, at)
        if found is None:
            self.without.add(name)
        return found

    def past(self, name: str, at: int, holder: str | None) -> int:
        """Raw text runs to its end tag or the end of the page; other elements end with the block that holds them at the latest."""
        end = self._end(name, at)
        if name in _RAW:
            return end.end() if end else len(self.page)
        depth, close = 0, None
        if holder and self._end(holder, at):
            for m in re.compile(rf"<(/?){holder}\b", re.I).finditer(self.page, at, end.start() if end else len(self.page)):
                depth += -1 if m[1] else 1
                if depth < 0:
                    close = m.start()
                    break
        # Of an element that nothing ends only the tag is left out.
        return close if close is not None else end.end() if end else at


def blocks(page: str) -> list[Block]:
    """Text blocks in page order; comments, markup, scripts, styles and form controls are left out."""
    skipper = _Skipper(page)
    root = Element("", 0)
    stack, out, at, numbered, links = [root], [], 0, 0, 0
    current = Block(root)

    def flush() -> None:
        nonlocal current
        if current.size:
            out.append(current)
        current = Block(stack[-1])

    def text(a: int, b: int) -> None:
        piece = page[a:b]
        if piece:
            current.pieces.append(piece)
            if not piece.isspace():
                n = len(piece)
                current.size += n
                current.linked += n if links else 0

    while (m := _TAG.search(page, at)) is not None:
        text(at, m.start())
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["close"]:
            if name == "br":
                current.pieces.append(" ")
                continue
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if not place:
                if name == "p":
                    flush()
                continue
            if name == "a":
                links = max(0, links - 1)
            border = any(e.name in _BLOCK for e in stack[place:])
            if border and name not in _BLOCK:
                # A stray inline end tag does not close the blocks around it.
                continue
            del stack[place:]
            if border:
                flush()
            continue
        if name in _DROPPED:
            if name in _RAW or not m["rest"].endswith("/"):
                at = skipper.past(name, at, next((e.name for e in reversed(stack) if e.name in _BLOCK), None))
            continue
        if name in _BLOCK:
            if stack[-1].name == "p" or any(e.name == "p" for e in stack[-4:]):
                while any(e.name == "p" for e in stack[1:]):
                    stack.pop()
                links = 0
            if name in _ENDS:
                while stack[-1].name in _ENDS[name] or (len(stack) > 1 and stack[-1].name not in _BLOCK and stack[-2].name in _ENDS[name]):
                    stack.pop()
        if name in _VOID:
            if name == "br":
                current.pieces.append(" ")
            elif name in _BLOCK:
                flush()
            continue
        numbered += 1
        stack.append(_element(name, m["rest"], numbered, stack[-1]))
        if name in _BLOCK:
            flush()
        elif name == "a":
            links += 1
    text(at, len(page))
    flush()
    return out


def gain(block: Block, words: str) -> float:
    """Evidence that a block is content, as a signed capacity."""
    e = block.parent
    value = e.for_ - e.against + min(len(words) / 150, 3.0) - 3.0 * block.linked / max(1, block.size)
    if e.name in _HEADINGS:
        value += 2.0 if e.article else 0.5
    elif e.name in ("p", "pre", "blockquote", "td", "li", "dd", "figcaption") and (e.article or e.name in ("p", "pre", "blockquote")):
        value += 1.0
    elif len(words) < 40:
        value -= 1.0
    return value


def minimum_cut(gains: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes lie on the content side of the minimum cut.

    A gain is the capacity from the content terminal, a negative one that to the other terminal; edges are
    undirected. Flow goes along shortest augmenting paths.
    """
    n = len(gains)
    rest = list(gains)
    out: list[list[list]] = [[] for _ in range(n)]
    for a, b, capacity in edges:
        there, back = [b, capacity, None], [a, capacity, None]
        there[2], back[2] = back, there
        out[a].append(there)
        out[b].append(back)
    small = 1e-9
    while True:
        came: dict[int, list | None] = {i: None for i in range(n) if rest[i] > small}
        queue = deque(came)
        goal = -1
        while queue and goal < 0:
            i = queue.popleft()
            for edge in out[i]:
                j = edge[0]
                if edge[1] > small and j not in came:
                    came[j] = edge
                    if rest[j] < -small:
                        goal = j
                        break
                    queue.append(j)
        if goal < 0:
            return [i in came for i in range(n)]
        path, i = [], goal
        while (edge := came[i]) is not None:
            path.append(edge)
            i = edge[2][0]
        flow = min(rest[i], -rest[goal], *(e[1] for e in path))
        rest[i] -= flow
        rest[goal] += flow
        for e in path:
            e[1] -= flow
            e[2][1] += flow


def main_text(page: str) -> str:
    """The content blocks of a page, white space reduced to one space, joined by empty lines."""
    found = blocks(page)
    texts = [" ".join(html.unescape("".join(b.pieces)).split()) for b in found]
    kept = [i for i, t in enumerate(texts) if t]
    gains = [gain(found[i], texts[i]) for i in kept]
    if len(kept) == 1 and not found[kept[0]].parent.against:
        gains[0] += 1.0  # a lone short text is no leftover of a longer one
    edges, last = [], {}
    for k, i in enumerate(kept):
        holder = found[i].parent.number
        if k:
            same = found[kept[k - 1]].parent
            alike = (same.for_, same.against) == (found[i].parent.for_, found[i].parent.against)
            edges.append((k - 1, k, 1.0 if alike else 0.2))
        if holder in last and last[holder] != k - 1:
            edges.append((last[holder], k, 0.5))
        last[holder] = k
    # Without a gain against there is nothing to cut; without one for it there is no content.
    if min(gains, default=0.0) > 0:
        side = [True] * len(kept)
    else:
        side = minimum_cut(gains, edges)
    return "\n\n".join(texts[i] for i, content in zip(kept, side) if content)


def _extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in groups(batches, "html", 8 << 20, 256):
        texts = [main_text(h or "") for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], names=["doc", "main"])


def extracted(pages: DataFrame, keep_html: bool = True) -> DataFrame:
    """``pages`` as ``doc`` (struct of all their columns, or of ``page_id`` and ``url``) with ``main`` text.

    A null html counts as empty; a page without content has an empty text; truncated markup is read as far as it
    goes; rows are read one by one, repeated or not, and whole, however long.
    """
    small_batches(pages.sparkSession)
    kept = pages if keep_html else pages.select("page_id", "url")
    source = pages.select((F.struct("*") if keep_html else F.struct("page_id", "url")).alias("doc"), "html")
    return source.mapInArrow(_extractor, with_doc(kept, "main string"))
