"""Main text of web pages by composite text density.

A page becomes a tree of elements. Menus, page headers and footers, sidebars,
notices, adverts, forms, comments, scripts and hidden parts are taken out by
what they declare (element or role). A telling word of class or id takes out
only a container that is also link-heavy or short beside the page's text (a
quarter of it at most; half for comments), or another block that is link-heavy;
inline elements and headings stay. A container that stays in spite of such a
word adds nothing to the density sum around it. For each remaining node

    density = C/T * log(C*T / (L*LT)) to the base C*L/(C-L) + Lb*C/Cb + e

with C its characters, T its tags, L and LT those inside links and Cb, Lb the
body's: characters per tag, cut down where links hold them. The density sum of
a node is the sum of its children's densities, and the node with the greatest
sum is the core of the page. The least density on the path from the body to the
core is the threshold for every subtree beside that path and inside the core:
sections at or above it stay; below it stay short paragraphs, lists, tables and
headings that belong to parts that stay. Link-heavy blocks (more than half of
their characters in links) go, and so do lines of their own beside the core that
are less dense than it. An article or main element around the core only bounds
the search; further articles stay if their sum reaches the threshold.

Text is given by blocks: character references decoded, white space runs one
space, trimmed, empty blocks left out, joined by a newline. A line break
element is white space inside its block.

Defined cases. Null or empty html, or a page without text: the empty text.
Repeated rows, null ids and urls: kept as they are; an empty table gives no rows.
Of equal sums the denser node is the core, then the earlier. Unclosed elements end
where their parent ends; a tag that never ends is no tag; where a quote inside a
tag never closes, tags end at their first greater-than sign from there on. Pages
are read in time proportional to their length, and trees of any depth are walked
without recursion.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import small_batches

# --- fixed values: HTML's own element classes ---------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCK - frozenset("html body head td th tr tbody thead tfoot caption title".split())
# Start tags that end an open element of the second list, up to the nearest element of the third.
IMPLIED = {
    "li": ("li", "ul ol menu dir"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th caption colgroup", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "tbody": ("tr td th thead tbody tfoot caption colgroup", "table"),
    "tfoot": ("tr td th thead tbody tfoot caption colgroup", "table"),
    "thead": ("tr td th caption colgroup", "table"),
    "option": ("option", "select datalist optgroup"),
}
IMPLIED = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in IMPLIED.items()}
# Elements, roles and words of class or id that declare something else than the article.
DROPPED = frozenset(
    "head nav footer aside form script style noscript template iframe svg canvas object embed applet audio video map "
    "button select input textarea option datalist dialog menu search title".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split()
)
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot adbox banner sponsor sponsored sponsors promo "
    "promotion nav navbar navigation menu menubar topbar breadcrumb breadcrumbs pagination pager header masthead "
    "footer sidebar aside rail cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup signin login paywall share sharing social related recommended "
    "recommendations comment comments commentlist disqus replies reply respond form search toolbar skip "
    "copyright disclaimer".split()
)
# Elements that a page is laid out with; a class word on them counts once they are a quarter of the text at most.
CONTAINERS = frozenset("address blockquote center details div dl dir fieldset hgroup ol p section summary ul".split())
SHORT_SHARE = 4
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_UNQUOTED = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(
    r"([^\s=/\"'<>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?"
)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_BESIDE = re.compile(r"(?:with|without|has|no|not|hide|show)(?:[-_]|(?=[A-Z]))")
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "attributes", "parent", "parts", "chars", "tags", "link_chars", "link_tags", "density", "sum",
                 "lowered", "holds")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        # Text runs and child nodes in page order.
        self.parts: list = []
        self.lowered = self.holds = False

    def children(self) -> Iterator[Node]:
        return (p for p in self.parts if not isinstance(p, str))


class _Open:
    """The open elements of a page, with the depths of each name, so that no end tag walks the tree."""

    def __init__(self, root: Node):
        self.path = [root]
        self.depths: dict[str, list[int]] = {}
        # Depths of block elements and of what else ends the reach of a paragraph.
        self.blocks: list[int] = []

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.path))
        if node.tag in BLOCK or node.tag in ("button", "object"):
            self.blocks.append(len(self.path))
        self.path.append(node)

    def close(self, depth: int) -> None:
        """End the element at ``depth`` and all in it."""
        while len(self.path) > depth:
            self.depths[self.path.pop().tag].pop()
        while self.blocks and self.blocks[-1] >= depth:
            self.blocks.pop()

    def last(self, tags: Iterable[str]) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def end(self, tag: str) -> None:
        """An end tag. An inline one does not reach out of its table cell."""
        depth = self.last((tag,))
        if depth and (tag in BLOCK or self.last(("td", "th", "table")) < depth):
            self.close(depth)

    def imply(self, tag: str) -> None:
        """End what a start tag ends."""
        if tag in CLOSES_P and self.blocks and self.path[self.blocks[-1]].tag == "p":
            self.close(self.blocks[-1])
        if tag in IMPLIED:
            ended, scope = IMPLIED[tag]
            above = self.last(scope)
            found = [bisect_right(self.depths[t], above) for t in ended if t in self.depths]
            first = [self.depths[t][i] for t, i in zip((t for t in ended if t in self.depths), found, strict=True)
                     if i < len(self.depths[t])]
            if first:
                self.close(min(first))


class _Tags:
    """Ends of tags, in one pass over the page.

    A greater-than sign inside quotes does not end a tag. Where a quote runs to the
    page's end, that tag and all behind it end at their first such sign.
    """

    def __init__(self, page: str):
        self.page, self.quotes, self.last = page, True, page.rfind(">")
        self.absent: set[str] = set()

    def find(self, mark: str, at: int) -> int:
        """Like ``str.find``, but a mark that was not found once is not sought again."""
        if mark in self.absent:
            return -1
        found = self.page.find(mark, at)
        if found < 0:
            self.absent.add(mark)
        return found

    def end(self, at: int) -> int:
        """The place of the sign that ends the tag whose attributes start at ``at``; -1 if there is none."""
        page, start = self.page, at
        while self.quotes:
            at = _UNQUOTED.match(page, at).end()
            if at < len(page) and page[at] == ">":
                return at
            close = page.find(page[at], at + 1) if at < len(page) else -1
            if close < 0:
                self.quotes = False
            at = close + 1
        return page.find(">", start)


def parse(page: str) -> Node:
    """The element tree of a page, whatever its faults, in time that grows with its length."""
    root = Node("html", "", None)
    open_ = _Open(root)
    tags = _Tags(page)
    at = start = 0
    end = len(page)
    while at < end:
        node = open_.path[-1]
        found = page.find("<", at)
        if found < 0 or found > tags.last:
            # No tag ends behind this place; an open comment or section is none of the text.
            stop = min((i for i in (page.find(m, max(at, found)) for m in ("<!--", "<![CDATA[")) if i >= 0), default=end)
            node.parts.append(html.unescape(page[start:stop]))
            start = end
            break
        at = found
        if page.startswith("<!--", at):
            closes = [i + len(m) for m in ("-->", "--!>") if (i := tags.find(m, at + 4)) >= 0]
            after, text = (min(closes) if closes else end), None
        elif page.startswith("<![CDATA[", at):
            close = tags.find("]]>", at + 9)
            after = close + 3 if close >= 0 else end
            text = page[at + 9 : close if close >= 0 else end]
        elif page[at + 1 : at + 2] in ("!", "?"):
            after, text = page.find(">", at) + 1, None
        elif tag_at := _TAG.match(page, at):
            close = tags.end(tag_at.end())
            if close < 0:
                at += 1
                continue
            if at > start:
                node.parts.append(html.unescape(page[start:at]))
            at = start = close + 1
            tag = tag_at[2].lower()
            if tag_at[1]:
                open_.end(tag)
                continue
            if tag == "html":
                continue
            open_.imply(tag)
            parent = open_.path[-1]
            child = Node(tag, page[tag_at.end() : close], parent)
            parent.parts.append(child)
            if tag in RAW:
                shut = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|$)[^>]*>?", re.I).search(page, at)
                if tag in ("textarea", "title"):
                    child.parts.append(html.unescape(page[at : shut.start() if shut else end]))
                at = start = shut.end() if shut else end
            elif tag not in VOID:
                open_.push(child)
            continue
        else:
            at += 1
            continue
        if at > start:
            node.parts.append(html.unescape(page[start:at]))
        if text:
            node.parts.append(text)
        at = start = after
    if start < end:
        open_.path[-1].parts.append(html.unescape(page[start:]))
    return root


def _declared(node: Node) -> tuple[dict[str, str], set[str]]:
    """Attributes, and the lower-case words of class and id."""
    if not node.attributes.strip():
        return {}, set()
    got: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(node.attributes):
        got.setdefault(name.lower(), html.unescape(a or b or c))
    named = f"{got.get('class', '')} {got.get('id', '')}"
    # "with-sidebar", "has-comments": what else the element holds or lacks, not what it is.
    own = " ".join(name for name in named.split() if not _BESIDE.match(name))
    return got, {w.lower() for w in _WORDS.findall(own)}


def _mark_holders(root: Node) -> None:
    """Mark each element around a main element, an article that is no comment, or a first heading."""
    todo = [root]
    while todo:
        node = todo.pop()
        node.holds = False
        todo.extend(node.children())
    todo = [root]
    while todo:
        node = todo.pop()
        todo.extend(node.children())
        if node.tag in ("main", "h1") or node.tag == "article" and not _declared(node)[1] & COMMENT_WORDS:
            at = node.parent
            while at is not None and not at.holds:
                at.holds = True
                at = at.parent


def _is_dropped(node: Node, in_article: bool) -> bool:
    tag = node.tag
    if tag in ("html", "body", "main"):
        return False
    got, words = _declared(node)
    if "hidden" in got or got.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(got.get("style", "")):
        return True
    if words & COMMENT_WORDS and tag == "article":
        return True
    if tag == "form":
        return not node.holds
    if tag in DROPPED:
        return True
    if tag == "header":
        return not in_article and not node.holds
    return got.get("role", "").lower() in DROPPED_ROLES and tag not in ("article", "h1", "p") and not node.holds


def _is_named_so(node: Node, in_article: bool, text_chars: int) -> bool:
    """Whether a measured element is none of the article by its class or id, and by its size or links."""
    tag = node.tag
    if tag not in BLOCK or tag in HEADINGS or tag in ("html", "body", "main", "article"):
        return False
    words = _declared(node)[1]
    if tag == "p":
        words = words & {"ad", "ads", "advert", "advertisement", "copyright", "cookie", *COMMENT_WORDS}
    if not words & DROPPED_WORDS or in_article and words & DROPPED_WORDS <= {"header"} or node.holds:
        return False
    container = tag in CONTAINERS
    if words & COMMENT_WORDS and container:
        # Comments may be long; but what holds most of a page without an article element is no comment.
        return in_article or 2 * node.chars <= text_chars
    node.lowered = container
    return _link_heavy([node]) or container and SHORT_SHARE * node.chars <= text_chars


def _prune(root: Node, dropped: Callable[[Node, bool], bool]) -> None:
    _mark_holders(root)
    todo = [(root, False)]
    while todo:
        node, in_article = todo.pop()
        inside = in_article or node.tag in ("article", "main")
        kept = []
        for part in node.parts:
            if not isinstance(part, str):
                if dropped(part, inside):
                    if part.tag in BLOCK:
                        kept.append(Node("hr", "", node))
                    continue
                todo.append((part, inside))
            kept.append(part)
        node.parts = kept


def _measure(body: Node) -> list[Node]:
    """Fill in counts, densities and density sums; the nodes in page order."""
    order, todo = [], [body]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(reversed(list(node.children())))
    for node in reversed(order):
        chars = tags = link_chars = link_tags = 0
        for part in node.parts:
            if isinstance(part, str):
                chars += len(_SPACE.sub(" ", part).strip())
            else:
                chars += part.chars
                tags += part.tags + 1
                link_chars += part.link_chars
                link_tags += part.link_tags
        if node.tag == "a":
            link_chars, link_tags = chars, link_tags + 1
        node.chars, node.tags, node.link_chars, node.link_tags = chars, tags, link_chars, link_tags
    body_chars, body_links = max(body.chars, 1), body.link_chars
    for node in reversed(order):
        c, t, lc, lt = node.chars, node.tags + 1, node.link_chars, max(node.link_tags, 1)
        if not c:
            node.density = 0.0
        else:
            base = math.log(c * lc / max(c - lc, 1) + body_links * c / body_chars + math.e)
            node.density = max(0.0, c / t * math.log(max(c * t / (max(lc, 1) * lt), 1.0)) / base)
        node.sum = sum(child.density for child in node.children() if not child.lowered)
    return order


def _blocks(nodes: list[Node]) -> list[str]:
    """The blocks of text below the nodes, in page order."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(run)).strip()
        if text:
            blocks.append(text)
        run.clear()

    for top in nodes:
        todo: list = [top]
        while todo:
            part = todo.pop()
            if isinstance(part, str):
                run.append(part)
            elif part is None:
                flush()
            elif part.tag in ("br", "wbr", "img"):
                run.append("" if part.tag == "wbr" else " ")
            elif part.tag in BLOCK:
                flush()
                todo.append(None)
                todo.extend(reversed(part.parts))
            else:
                todo.extend(reversed(part.parts))
        flush()
    return blocks


def _weight(node: Node) -> float:
    """What is held against the threshold: the sum over the children, or a leaf's own density."""
    return max(node.sum, node.density) if node.parts else 0.0


def _text_weight(parts: list) -> float:
    """Density of a run of text and inline elements."""
    chars = sum(len(_SPACE.sub(" ", p).strip()) if isinstance(p, str) else p.chars for p in parts)
    return chars * math.log(chars) if chars > 1 else 0.0


def _link_heavy(parts: list) -> bool:
    """Whether more than half of the characters are inside links."""
    chars = sum(len(_SPACE.sub(" ", p).strip()) if isinstance(p, str) else p.chars for p in parts)
    return 2 * sum(p.link_chars for p in parts if not isinstance(p, str)) > chars


def _is_leaf(node: Node) -> bool:
    return not any(child.tag in BLOCK for child in node.children())


def _items(node: Node) -> list[list]:
    """The parts of an element: each block alone, text and inline elements in runs."""
    items: list[list] = []
    run: list = []
    for part in node.parts:
        if not isinstance(part, str) and part.tag in BLOCK:
            if run:
                items.append(run)
            items.append([part])
            run = []
        else:
            run.append(part)
    return [*items, run] if run else items


KEPT, BETWEEN, GONE = 2, 1, 0


def _verdict(item: list, core: Node, inner: Node | None, top: bool, threshold: float, leaf_tags: set[str]) -> int:
    part = item[0]
    if part is inner:
        return KEPT
    block = not isinstance(part, str) and part.tag in BLOCK
    if block and part.tag in HEADINGS:
        return BETWEEN
    loose = not block or part.tag not in CONTAINERS or part.tag in ("ul", "ol", "p")
    if _link_heavy(item):
        return BETWEEN if inner is None and (not block or part.tag == "p") else GONE
    if inner is not None and block and part.tag in CONTAINERS and _is_leaf(part):
        # One line beside the core: it has to be as dense as the core itself.
        threshold = max(threshold, core.density)
    if loose and not top or (_weight(part) if block else _text_weight(item)) >= threshold:
        return KEPT
    if inner is None and block and _is_leaf(part) and part.tag in leaf_tags:
        return KEPT
    return BETWEEN if loose or not _is_leaf(part) else GONE


def _select(node: Node, core: Node, inner: Node | None, top: bool, threshold: float) -> None:
    """Leave in an element what belongs to the article.

    ``inner`` is its child on the way to the core, None in the core and in what is
    kept beside it; ``top`` says that the element only holds the page together.
    Subtrees at or above the threshold stay. Below it, paragraphs, lists, tables and
    bare text stay inside the article's own elements, and in the page's between two
    parts that stay; a heading stays if a part that stays follows; a container of one
    line goes, unless dense leaves beside it in the core have the same name. A line
    outside the core has to reach the core's own density.
    """
    items = _items(node)
    leaf_tags = {item[0].tag for item in items if not isinstance(item[0], str) and item[0].tag in BLOCK
                 and _is_leaf(item[0]) and _weight(item[0]) >= threshold}
    verdicts = [_verdict(item, core, inner, top, threshold, leaf_tags) for item in items]
    sure = [i for i, v in enumerate(verdicts) if v == KEPT]
    kept: list = []
    follows = False
    for i in range(len(items) - 1, -1, -1):
        part = items[i][0]
        heading = not isinstance(part, str) and part.tag in HEADINGS
        blank = all(isinstance(p, str) and not p.strip() for p in items[i])
        if blank:
            stays = True
        elif heading:
            stays = follows
        else:
            stays = verdicts[i] == KEPT or verdicts[i] == BETWEEN and bool(sure) and sure[0] < i < sure[-1]
            follows = stays
        kept.append(items[i] if stays else [Node("hr", "", node)])
    node.parts = [part for item in reversed(kept) for part in item]


def _select_within(top: Node, core: Node, threshold: float) -> None:
    """:func:`_select` in a subtree that stays, down to its last container."""
    todo = [top]
    while todo:
        node = todo.pop()
        if node.tag in BLOCK and node.tag not in ("table", "p", "ul", "ol", "dl") and not _is_leaf(node):
            _select(node, core, None, False, threshold)
            todo.extend(child for child in node.children() if child.tag in BLOCK)


def _core(body: Node) -> list[Node]:
    """The subtrees that hold the article, in page order.

    The threshold is the least density on the way from the body to the core. An article
    or main element around the core bounds what is looked at; further ones stay if
    their weight reaches the threshold.
    """
    order = _measure(body)
    core = max(order, key=lambda node: (node.sum, node.density))
    path = [core]
    while path[-1] is not body:
        path.append(path[-1].parent)
    threshold = min(node.density for node in path)
    bound = next((node for node in reversed(path) if node.tag in ("article", "main")), body)
    tops = [bound]
    if bound is not body:
        todo = [body]
        while todo:
            node = todo.pop()
            for child in node.children():
                if child.tag == "article" and child is not bound and _weight(child) >= threshold:
                    tops.append(child)
                elif child is not bound:
                    todo.append(child)
        places = {id(node): i for i, node in enumerate(order)}
        tops.sort(key=lambda node: places[id(node)])
    for node, inner in zip(path[1:], path, strict=False):
        _select(node, core, inner, node is body, threshold)
        if node is bound:
            break
    for node in [core, *(top for top in tops if top is not bound)]:
        _select_within(node, core, threshold)
    return tops


def extract(page: str | None) -> str:
    """The article's text of one page."""
    if not page:
        return ""
    root = parse(page)
    _prune(root, _is_dropped)
    body = next((child for child in root.children() if child.tag == "body"), root)
    _measure(body)
    text_chars = body.chars - body.link_chars
    _prune(body, lambda node, in_article: _is_named_so(node, in_article, text_chars))
    return "\n".join(_blocks(_core(body)))


def _extract_each(pages: pd.Series) -> pd.Series:
    return pages.map(extract)


def main_text(column: str | Column = "html") -> Column:
    """Main text of a column of pages; null pages give the empty text."""
    page = F.col(column) if isinstance(column, str) else column
    return F.pandas_udf(_extract_each, "string")(F.coalesce(page, F.lit("")))


def extract_pages(pages: DataFrame, column: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text of ``column`` as ``text`` (replaced where it exists)."""
    small_batches(pages.sparkSession)
    return pages.withColumn(text, main_text(column))
