"""Operator 6: main text of web pages by tree scoring.

A page is read into a small tree.  Every paragraph passes points (one, one per
comma, up to three for length) to its parent, half of them to its grandparent
and less to further ancestors.  A container's points are discounted by its
link density.  From the best container the way goes up to the article or main
element around it, and on to ancestors below the body that add no link-heavy
part; all blocks of that element are kept, with siblings that score well enough,
are articles, or are paragraphs of running text.  Elements that never belong to
an article (menus, page headers, footers, sidebars, forms, scripts, adverts,
notices, reader comments, by tag, role or class) are left out before and inside
it.  A class or id never leaves out what holds an article or main element; and
where the word is only part of a name (``with-sidebar``), not what holds most of
the page's paragraphs.  The header of an article belongs to it.

Character references are decoded, white space inside a block becomes one
space, blocks are joined by a newline in page order.

Edge cases: NULL or empty html gives empty text; a page without any paragraph
points gives its remaining blocks; broken markup (unclosed or stray tags, a
page cut off) is read as far as it goes; equal scores go to the container that
comes first; repeated rows are read each; an empty table gives an empty table.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Element names of HTML by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template head title nav header footer aside form button select option textarea input label dialog iframe object svg canvas audio video map menu".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("html body caption tbody td tfoot th thead tr dd dt legend summary li".split()) | frozenset(["li", "dd", "dt"])
PARAGRAPHS = frozenset("p pre td blockquote li dd".split())
#: Words of class, id and role that name what is not the article.
UNLIKELY = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist "
    "complementary contentinfo cookie cookies consent disqus disclaimer footer form gdpr header login masthead menu menubar modal nav "
    "navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion related reply replies respond rss "
    "search share sharing shoutbox sidebar sidebars signup skip social sponsor sponsored sponsors subscribe toolbar tools toast tweet widget widgets".split()
)
HOSTS = ("article", "main")
#: What a class, id or role says of an element: nothing, a name with such a word in it, such a word.
PLAIN, PARTLY, WHOLLY = 0, 1, 2
#: A paragraph's least length to score, the share of the best score that a sibling needs.
LEAST_CHARS, SIBLING_SHARE, SIBLING_POINTS = 25, 0.2, 10
#: From this share of characters in links on a part is a menu rather than text.
LINK_HEAVY = 0.5

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_PART = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")


class Node:
    """An element: its children are nodes and pieces of text, in page order."""

    __slots__ = ("children", "dropped", "inside", "link_chars", "named", "parent", "points", "tag", "text_chars")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False, named: int = 0):
        self.tag, self.parent, self.dropped, self.named = tag, parent, dropped, named
        self.inside = tag in HOSTS or parent is not None and parent.inside
        self.children: list[Node | str] = []
        self.points, self.text_chars, self.link_chars = 0.0, 0, 0


def _hidden(attributes: str) -> bool:
    return bool(attributes) and _HIDDEN.search(attributes) is not None


def _named(tag: str, attributes: str) -> int:
    """Whether class, id or role name what is not the article, wholly or in part of a name."""
    found = PLAIN
    if not attributes or tag in ("html", "body", *HOSTS):
        return found
    for match in _NAMES.finditer(attributes):
        value = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", match[1] or match[2] or match[3] or "").lower()
        for name in value.split():
            if name in UNLIKELY:
                return WHOLLY
            if not UNLIKELY.isdisjoint(_PART.split(name)):
                found = PARTLY
    return found


def parse(page: str) -> Node:
    """The tree of a page; tags that do not fit are closed or skipped as browsers do in plain cases."""
    root = here = Node("", None)
    at, raw = 0, None
    for match in _TOKEN.finditer(page):
        if match.start() < at:
            continue  # inside a script
        if match.start() > at:
            here.children.append(references.unescape(page[at : match.start()]))
        at = match.end()
        name = match[2]
        if not name:
            continue
        name = name.lower()
        if match[1]:
            up = here
            while up is not root and up.tag != name:
                if name not in BLOCKS and up.tag in BLOCKS:
                    up = root  # an inline end tag closes nothing beyond its block
                    break
                up = up.parent
            if up is not root:
                here = up.parent
            continue
        if name in VOID:
            here.children.append(" " if name in ("br", "hr", "wbr") else "")
            continue
        if name in CLOSES_P:
            up = here
            while up is not root and (up.tag == "p" or up.tag not in BLOCKS):
                if up.tag == "p":
                    here = up.parent
                    break
                up = up.parent
        if name in ("li", "dd", "dt", "tr", "td", "th", "option"):
            up = here
            while up is not root and up.tag not in ("ul", "ol", "dl", "table", "tbody", "div", "article", "section", "body", "select"):
                if up.tag == name or {up.tag, name} in ({"dd", "dt"}, {"td", "th"}):
                    here = up.parent
                    break
                up = up.parent
        gone = name in DROPPED and not (name == "header" and here.inside) or name not in ("html", "body", *HOSTS) and _hidden(match[3])
        node = Node(name, here, here.dropped or gone, _named(name, match[3]))
        here.children.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif not match[3].rstrip().endswith("/"):
            here = node
    if at < len(page):
        rest = page[at:]
        cut = re.search(r"<[a-zA-Z/!][^>]*\Z", rest)  # a tag that the page's end has cut off
        here.children.append(references.unescape(rest[: cut.start()] if cut else rest))
    return root


def blocks(nodes: list[Node | str]) -> list[str]:
    """Texts of the blocks, in page order; inline elements run on."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append(text)

    stack: list[Node | str | None] = list(reversed(nodes))  # None: a block ends
    while stack:
        node = stack.pop()
        if node is None:
            close()
        elif isinstance(node, str):
            run.append(node)
        elif not node.dropped:
            if node.tag in BLOCKS:
                close()
                stack.append(None)
            stack.extend(reversed(node.children))
    close()
    return out


def _walk(root: Node) -> list[Node]:
    """Kept elements in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped)
    return order


def _leave_out(root: Node) -> None:
    """Drop the elements whose names say so, unless they hold what is looked for: first those named wholly,
    then of those named in part all that hold no more than half of the paragraphs that are left."""
    for level in (WHOLLY, PARTLY):
        order = _walk(root)
        if not any(n.named == level for n in order):
            continue
        hosts, mass = {id(n): n.tag in HOSTS for n in order}, dict.fromkeys(map(id, order), 0)
        for node in reversed(order):
            if node.tag in PARAGRAPHS:
                mass[id(node)] += sum(len(c.strip()) for c in _inline(node))
            if node.parent is not None:
                hosts[id(node.parent)] |= hosts[id(node)]
                mass[id(node.parent)] += mass[id(node)]
        for node in order:
            if node.named == level and not hosts[id(node)]:
                node.dropped = level == WHOLLY or 2 * mass[id(node)] <= mass[id(root)]


def _density(node: Node) -> float:
    return node.link_chars / max(node.text_chars, 1)


def _top(best: Node) -> Node:
    """The element around the best container whose blocks are the article."""
    top, up = best, best
    while up is not None:
        if up.tag in HOSTS and _density(up) < LINK_HEAVY:
            top = up
            break
        up = up.parent
    while top.parent is not None and top.parent.tag not in ("", "html", "body"):
        beside = (c for c in top.parent.children if isinstance(c, Node) and c is not top and not c.dropped)
        if any(_density(c) >= LINK_HEAVY for c in beside if c.text_chars):
            break
        top = top.parent
    return top


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    root = parse(page)
    _leave_out(root)
    order = _walk(root)
    for node in reversed(order):  # children before parents
        for child in node.children:
            if isinstance(child, str):
                node.text_chars += len(child.strip())
            elif not child.dropped:
                node.text_chars += child.text_chars
                node.link_chars += child.link_chars
        if node.tag == "a":
            node.link_chars = node.text_chars
    scored = False
    for node in order:
        if node.tag not in PARAGRAPHS and not (node.tag in ("div", "section", "article") and any(isinstance(c, str) and len(c.strip()) >= LEAST_CHARS for c in node.children)):
            continue
        own = " ".join("".join(_inline(node)).split())
        if len(own) < LEAST_CHARS:
            continue
        points = 1 + own.count(",") + min(len(own) // 100, 3)
        up, level = (node if node.tag in ("div", "section", "article") else node.parent), 0
        while up is not None and level < 5:
            up.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up, level = up.parent, level + 1
        scored = True
    if not scored:
        return "\n".join(blocks([root]))
    worth = {id(n): n.points * (1 - _density(n)) for n in order}
    best = max(order, key=lambda n: worth[id(n)])
    if best.parent is None:
        return "\n".join(blocks([best]))
    top = _top(best)
    least = max(SIBLING_POINTS, SIBLING_SHARE * worth[id(best)])
    kept: list[Node | str] = []
    for node in top.parent.children:
        if not isinstance(node, Node) or node.dropped:
            continue
        density = _density(node)
        running = node.tag == "p" and (node.text_chars > 80 and density < 0.25 or 0 < node.text_chars <= 80 and density == 0 and "." in "".join(_inline(node)))
        article = node.tag == "article" and node.points > 0 and density < LINK_HEAVY
        if node is top or worth[id(node)] >= least or running or article:
            kept.append(node)
    return "\n".join(blocks(kept))


def _inline(node: Node) -> Iterator[str]:
    """Text of an element without its blocks."""
    stack = list(reversed(node.children))
    while stack:
        child = stack.pop()
        if isinstance(child, str):
            yield child
        elif not child.dropped and child.tag not in BLOCKS:
            stack.extend(reversed(child.children))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` and ``n_chars`` (code points)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [main_text(h.as_py()) for h in part.column("html")]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["key", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    src = pages.select(pages[id_col].alias("key"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    out = src.mapInArrow(run, f"key {kind}, url string, text string, n_chars bigint")
    return out.withColumnRenamed("key", id_col)
