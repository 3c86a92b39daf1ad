"""Main text of web pages by tree scoring.

The page becomes a tree. Every paragraph gives points for its length and its commas to its
ancestors, less with each level up; a container's points are discounted by the share of
its text that is in links. The best container and its siblings are kept, but for those that
are mostly links. Parts that are never article text (scripts, forms, menus, and
containers whose class, id or role says advert, sidebar, comments and so on) are left out
before scoring, and lists of links after it.

A page is one row and its tree lives in one task; pages are independent, so there is no
shuffle. Nothing is cut: the work is linear in the page.

Defined results: a null or empty page gives an empty text; broken markup is read the way
browsers read it (an open paragraph ends at the next block, stray end tags are skipped);
a tag that is cut off at the end of the page is no text; a page without an id keeps its null
id; repeated rows are read alike; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
_LEFT_OUT = frozenset(
    "head nav header footer aside form button select option menu dialog object audio video canvas "
    "fieldset search input label datalist".split()
)
_PARAGRAPH = frozenset("p pre blockquote td dd li h1 h2 h3 h4 h5 h6 figcaption".split())
#: An element that opens here ends these, up to the given stop elements.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
_P_STOPS = frozenset("table td th button object caption html".split())

#: Words in class, id or role of parts that are no article text.
_UNLIKELY = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion "
    "sidebar aside nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar tabs "
    "header masthead footer copyright comment comments commentlist respond reply replies disqus "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay lightbox paywall "
    "newsletter subscribe subscription signup login register search form share sharing social follow "
    "related recommended recommendations trending popular widget widgets skip hidden complementary "
    "contentinfo outbrain taboola".split()
)
_LIKELY = frozenset("article main content body post entry story text page".split())
#: A name that starts so tells of a page's state or subject, not what the part is.
_ABOUT = frozenset("has no not with without is category tag".split())
#: Parts of an article that are mostly links.
_CITED = frozenset("references reference reflist bibliography citations footnotes endnotes sources".split())

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?>[^\"'>]|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'])*+)>"
    r"|<[!?/][^>]*+>?"
    r"|(?P<text>[^<]++|<)",
    re.DOTALL,
)
_ATTR = re.compile(r"""(class|id|role|aria-hidden|hidden|style)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_NO_SHOW = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = (
        "tag", "parent", "children", "words", "unlikely", "likely", "hidden", "points", "chars", "link_chars", "commas", "links", "cited"
    )

    def __init__(self, tag: str, parent: Node | None, attrs: str = "") -> None:
        self.tag, self.parent = tag, parent
        self.children: list[Node | str] = []
        self.words: frozenset[str] = frozenset()
        self.unlikely = False
        self.likely = tag in ("article", "main", "html", "body")
        self.hidden = False
        self.points = 0.0
        self.chars = self.link_chars = self.commas = self.links = 0
        self.cited = False
        if attrs.strip(" /"):
            words = set()
            for name, value in _ATTR.findall(attrs):
                name, value = name.lower(), value.strip("\"'")
                if name in ("class", "id", "role"):
                    for token in value.split():
                        parts = [w.lower() for w in _WORDS.findall(token)]
                        words.update(parts)
                        self.likely |= token.lower() in _LIKELY
                        self.unlikely |= bool(parts) and parts[0] not in _ABOUT and not _UNLIKELY.isdisjoint(parts)
                elif name == "hidden" or (name == "style" and _NO_SHOW.search(value)):
                    self.hidden = True
                elif name == "aria-hidden" and value.lower() == "true":
                    self.hidden = True
            self.words = frozenset(words)

    def left_out(self, by_name: bool = True) -> bool:
        if self.tag in _LEFT_OUT or self.hidden:
            return True
        return by_name and self.unlikely and not self.likely


class _Open:
    """The elements that are open, outermost first, and where those of each name are."""

    def __init__(self, root: Node) -> None:
        self.nodes = [root]
        self.places: dict[str, list[int]] = {root.tag: [0]}
        self.blocks: list[int] = []  # places of blocks other than p

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in _BLOCK and node.tag != "p":
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, place: int) -> None:
        """Close everything from a place on; the root stays."""
        while len(self.nodes) > max(1, place):
            self.places[self.nodes.pop().tag].pop()
        while self.blocks and self.blocks[-1] >= len(self.nodes):
            self.blocks.pop()

    def last(self, tags: Iterable[str]) -> int:
        """The innermost place of one of the names, or -1."""
        return max((at[-1] for t in tags if (at := self.places.get(t))), default=-1)

    def block(self) -> int:
        return self.blocks[-1] if self.blocks else -1

    def closed(self, tag: str) -> None:
        """An end tag; one that nothing opened, or that would end a block around it, is skipped."""
        place = self.last((tag,))
        if place >= 0 and (tag in _BLOCK or self.block() < place):
            self.cut(place)

    def opened(self, tag: str) -> None:
        """Close what a new element ends."""
        if tag in _BLOCK:
            p = self.last(("p",))
            if p > max(self.block(), self.last(_P_STOPS)):
                self.cut(p)
        ends, stops = _ENDS.get(tag, ((), ()))
        stop = self.last(stops)
        outer = [at[i] for t in ends if (at := self.places.get(t)) and (i := bisect_right(at, stop)) < len(at)]
        if outer:
            self.cut(min(outer))
        top = self.nodes[-1].tag
        if tag[0] == "h" and tag[1:].isdigit() and top[0] == "h" and top[1:].isdigit():
            self.cut(len(self.nodes) - 1)


def parse(page: str) -> Node:
    """The page's tree; raw elements (scripts and the like) are not in it."""
    root = Node("html", None)
    now = _Open(root)
    pos, end, last = 0, len(page), page.rfind(">")
    while pos < end:
        if pos > last and page[pos] == "<" and page[pos + 1 : pos + 2].isalpha():
            break  # a tag that never closes: the rest is no text
        m = _TOKEN.match(page, pos)
        pos = m.end()
        if m["text"] is not None:
            # References are read text by text: parts of one may not come from two.
            now.nodes[-1].children.append(html.unescape(m["text"]))
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag in ("html", "body"):
            if tag == "body" and not m["end"]:
                now.cut(1)
            continue
        if m["end"]:
            now.closed(tag)
            continue
        if tag in _RAW:
            if not m["attrs"].rstrip().endswith("/") or tag not in ("svg", "math"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, pos)
                pos = close.end() if close else end
            continue
        now.opened(tag)
        node = Node(tag, now.nodes[-1], m["attrs"])
        now.nodes[-1].children.append(node)
        if tag not in _VOID:
            now.push(node)
    return root


def _ordered(root: Node, by_name: bool = True) -> list[Node]:
    """All nodes that may hold article text, parents before children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        node.children = [c for c in node.children if isinstance(c, str) or not c.left_out(by_name)]
        todo.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return out


def _spare_holders(nodes: list[Node]) -> None:
    """Unlikely names do not count for what holds most of the page's paragraphs and its title or article."""
    chars: dict[Node, int] = {}
    marked = set()
    for node in reversed(nodes):
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str)) if _is_paragraph(node) else 0
        inner = [c for c in node.children if not isinstance(c, str)]
        chars[node] = own + sum(chars[c] for c in inner if c.tag != "a")
        if any(c in marked or c.tag == "h1" or c.likely for c in inner):
            marked.add(node)
    for node in nodes:
        node.likely |= node in marked and 2 * chars[node] > chars[nodes[0]]


def _measure(nodes: list[Node]) -> None:
    """Text, commas and links of every node, bottom up; whether it is in a list of sources, top down."""
    for node in reversed(nodes):
        chars = links = commas = count = 0
        for c in node.children:
            if isinstance(c, str):
                chars += len(c.strip())
                commas += c.count(",") + c.count("，") + c.count("、")
            else:
                chars += c.chars
                links += c.link_chars
                commas += c.commas
                count += c.links + (c.tag == "a")
        node.chars, node.link_chars = chars, chars if node.tag == "a" else links
        node.commas, node.links = commas, count
    for node in nodes:
        node.cited = not node.words.isdisjoint(_CITED) or node.parent is not None and node.parent.cited


def _density(node: Node) -> float:
    return node.link_chars / node.chars if node.chars else 0.0


def _is_paragraph(node: Node) -> bool:
    """Paragraph elements, and other blocks that hold text of their own."""
    if node.tag in _PARAGRAPH:
        return not any(not isinstance(c, str) and c.tag in _BLOCK for c in node.children)
    if node.tag not in _BLOCK:
        return False
    return any(isinstance(c, str) and len(c.strip()) > 25 for c in node.children)


def _score(nodes: list[Node]) -> None:
    for node in nodes:
        if not _is_paragraph(node) or not node.chars:
            continue
        points = 1 + node.commas + min(node.chars / 100, 3.0)
        up, level = node.parent, 0
        if node.tag not in _PARAGRAPH:
            up = node  # its own text makes it a container
        while up is not None and level < 5:
            up.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up, level = up.parent, level + 1
    for node in nodes:
        if node.tag in ("article", "main") or node.words & _LIKELY:
            node.points *= 1.25
        node.points *= 1 - _density(node)


def _chosen(nodes: list[Node]) -> list[Node]:
    """The best container, or what holds it within the article, with its good siblings."""
    best = max(nodes, key=lambda n: n.points)
    if best.points <= 0:
        return [nodes[0]]
    up = best
    while up.parent is not None:
        up = up.parent
        if up.tag in ("article", "main") or "main" in up.words or "article" in up.words:
            best = up
            break
    while best.tag in ("p", "tr", "td", "tbody", "table", "li", "ul", "ol", "blockquote", "pre") and best.parent is not None:
        best = best.parent
    if best.parent is None:
        return [best]
    # What is no article text by its name, or a list of links, is out by now: the other parts beside
    # the best one belong to it, however short they are, unless they are mostly links.
    return [s for s in best.parent.children if not isinstance(s, str) and (s is best or s.chars and _density(s) < 0.5)]


def _link_list(node: Node) -> bool:
    """A menu or a list of further reading: mostly links, several of them."""
    if node.tag not in ("ul", "ol", "div", "section", "table", "dl") or _density(node) <= 0.5:
        return False
    # Entries that say more than their link are no menu.
    return node.links >= 2 and node.chars - node.link_chars < 10 * node.links and not node.cited


def _blocks(root: Node) -> list[str]:
    """Texts of the blocks below a node, in page order."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if run and (text := " ".join("".join(run).split())):
            out.append(text)
        run.clear()

    todo: list[Node | str | None] = [root]
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            run.append(item)
        elif item.tag == "br":
            run.append(" ")
        elif not _link_list(item):
            if item.tag in _BLOCK:
                flush()
                todo.append(None)
            todo.extend(reversed(item.children))
    flush()
    return out


def main_text(page: str | None) -> str:
    """The article's blocks, joined by line ends; empty if there is no text."""
    if not page:
        return ""
    root = parse(page)
    every = _ordered(root, by_name=False)
    _spare_holders(every)
    named = any(n.left_out() for n in every)
    text = _read(_ordered(root))
    return text if text or not named else _read(_ordered(parse(page), by_name=False))


def _read(nodes: list[Node]) -> str:
    _measure(nodes)
    _score(nodes)
    return "\n".join(b for node in _chosen(nodes) for b in _blocks(node))


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """page_id, url, ``text`` and ``n_chars`` (code points) for every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.col(f"`{html_col}`").cast("string").alias("html"),
    )
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
