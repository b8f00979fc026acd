"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text with their places in the element tree. A linear
classifier gives each block a cost of being called content and one of being called
boilerplate; these are the capacities to the terminals. Elements, roles and names that
mark boilerplate are features among others. Blocks that follow each other or stand near
each other in the tree are tied by edges whose capacity is the cost of telling them
apart. The maximum flow leaves the blocks that the source still reaches: the content.
A block whose own cost outweighs all its edges is settled before, and its edges become
costs of its neighbours; the flow runs over what is left, in time near to linear. Only
what a browser doesn't show (``hidden``) is certain to go.

Markup is read as browsers do where it matters: unclosed paragraphs, list items and
scripts, attributes with quoted ">", comments, a tag cut off at the end of the page.
Null pages are empty; their text is empty. Repeated rows are read each for itself; an
empty table gives no row. Only the id, URL and markup columns are read.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import only
from tessera.llm.ragged import slices

#: Elements of the HTML standard by how they are read.
RAW = "script|style|title|textarea|noscript|template|iframe|svg|select|math|object|canvas|audio|video"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Elements, roles and words of class or id names that mark boilerplate.
ASIDE_TAGS = frozenset("nav footer aside form button menu dialog search head label fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright disqus dropdown footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices notification pagination pager popup privacy promo promoted promotion recommended related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toc toolbar topbar widget widgets".split()
)
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset("article content entry main post story text body".split())
#: Elements that a paragraph or item left open does not reach out of; a cell is left by the next part of its row.
SCOPES = frozenset("ul ol dl table article section body div".split())
CELLS, ROW_PARTS = frozenset(("td", "th")), frozenset(("td", "th", "tr"))
#: The classifier: score of a block; above 0 speaks for content.
BASIS, IN_MAIN, NAMED_MAIN, PER_WORD, MOST_WORDS, SENTENCE, HEADING, LINKS, LIST_ITEM, PAGE_HEADER = -1.5, 5.0, 1.5, 0.1, 4.0, 1.0, 1.0, -6.0, -0.5, -2.0
#: In an element whose tag or role, or whose name, marks boilerplate; in one that isn't shown.
MARKED, MARKED_NAME, CERTAIN = -12.0, -11.0, -1000.0
#: Smoothness: of blocks in sequence, of blocks near each other in the tree, of the next block in one parent.
IN_SEQUENCE, NEAR, NEXT_OF_PARENT = 0.5, 1.5, 0.7

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[a-zA-Z/!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    __slots__ = ("tag", "parent", "depth", "aside", "aside_name", "unseen", "main", "named", "header", "link")

    def __init__(self, tag: str, parent: Element | None, attrs: str = "") -> None:
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.aside = bool(parent and parent.aside) or tag in ASIDE_TAGS
        self.aside_name = bool(parent and parent.aside_name)
        self.unseen = bool(parent and parent.unseen)
        self.main = bool(parent and parent.main) or tag in MAIN_TAGS
        self.named = bool(parent and parent.named)
        self.header = bool(parent and parent.header) or tag == "header"
        self.link = bool(parent and parent.link) or tag == "a"
        if attrs and tag not in ("html", "body"):
            for kind, a, b, c in _NAMES.findall(attrs):
                kind, value = kind.lower(), a or b or c
                if kind == "role":
                    self.aside |= value.lower() in ASIDE_ROLES
                    self.main |= value.lower() in ("main", "article")
                elif kind == "hidden" or kind == "aria-hidden" and value.lower() == "true" or kind == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    self.unseen = True
                elif kind in ("class", "id") and tag not in MAIN_TAGS:
                    words = {w.lower() for w in _WORDS.findall(value)}
                    self.aside_name |= bool(words & ASIDE_WORDS)
                    self.named |= bool(words & MAIN_WORDS)
                    self.header |= "header" in words


def blocks(page: str) -> list[tuple[str, Element, float]]:
    """(text, innermost block element, share of text in links) of every block, in page order."""
    root = Element("", None)
    top, out, parts, linked, at = root, [], [], 0, 0

    def flush(element: Element) -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                while element.tag and element.tag not in BLOCK:
                    element = element.parent
                out.append((text, element, min(1.0, linked / max(1, sum(map(len, parts))))))
            parts.clear()
        linked = 0

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text = page[at : m.start()]
            parts.append(text)
            if top.link:
                linked += len(text)
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCK:
            flush(top)
        elif tag == "br":
            parts.append(" ")
        if m["end"]:
            element = top
            while element.parent and element.tag != tag:
                # A table cell or a section is not left by the end of something inside out of order.
                if element.tag in ("article", "section", "td", "body") and tag not in BLOCK:
                    element = root
                    break
                element = element.parent
            if element.parent:
                top = element.parent
            continue
        if tag in BLOCK:
            closes = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}.get(tag, ())
            element, found = top, None
            while element.parent and element.tag not in SCOPES and (element.tag not in CELLS or tag in ROW_PARTS):
                if element.tag == "p" or element.tag in closes:
                    found = element
                element = element.parent
            if found:
                top = found.parent
        if tag not in VOID and not m["attrs"].endswith("/"):
            top = Element(tag, top, m["attrs"])
    if at < len(page):
        parts.append(page[at:])
        if top.link:
            linked += len(page) - at
    flush(top)
    return out


def score(text: str, element: Element, links: float) -> float:
    """What speaks for content less what speaks for boilerplate."""
    words = text.count(" ") + 1
    out = BASIS + min(MOST_WORDS, PER_WORD * words) + LINKS * links
    out += MARKED if element.aside else MARKED_NAME * element.aside_name
    out += CERTAIN * element.unseen
    out += IN_MAIN * element.main + NAMED_MAIN * element.named + HEADING * (element.tag[0:1] == "h" and element.tag[1:].isdigit())
    out += SENTENCE * (text[-1] in ".!?…。") + LIST_ITEM * (element.tag == "li")
    return out + PAGE_HEADER * (element.header and not element.main)


def distance(a: Element, b: Element) -> int:
    """Steps in the tree between two elements."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def label(found: list[tuple[str, Element, float]]) -> list[bool]:
    """Which blocks the minimum cut leaves on the source's side."""
    scores = [score(*block) for block in found]
    ties: list[dict[int, float]] = [{} for _ in found]
    last: dict[int, int] = {}

    def tie(i: int, j: int, w: float) -> None:
        ties[i][j] = ties[j][i] = ties[i].get(j, 0.0) + w

    for i, (_, element, _) in enumerate(found):
        home = element.parent or element
        if i:
            before = found[i - 1][1]
            tie(i - 1, i, IN_SEQUENCE + NEAR / (1 + distance(before.parent or before, home)))
            if (j := last.get(id(home), i - 1)) != i - 1:
                tie(j, i, NEXT_OF_PARENT)
        last[id(home)] = i
    return minimum_cut(scores, ties)


def minimum_cut(scores: list[float], ties: list[dict[int, float]]) -> list[bool]:
    """The smallest source side of a minimum cut; a positive score is joined to the source, a negative one to the sink."""
    side: list[bool | None] = [None] * len(scores)
    own, links = list(scores), [dict(t) for t in ties]
    bound = [sum(t.values()) for t in links]
    queue = deque(range(len(own)))
    while queue:
        i = queue.popleft()
        if side[i] is not None or abs(own[i]) < bound[i] or own[i] == bound[i] > 0:
            continue
        side[i] = own[i] > 0
        for j, w in links[i].items():
            if side[j] is None:
                own[j] += w if side[i] else -w
                bound[j] -= w
                del links[j][i]
                queue.append(j)
    _flow(own, links, side)
    return [bool(x) for x in side]


def _flow(own: list[float], links: list[dict[int, float]], side: list[bool | None]) -> None:
    """Settles the blocks left: shortest augmenting paths by levels, from all supplies to all demands at once."""
    left = [i for i, x in enumerate(side) if x is None]
    tiny = 1e-9
    while True:
        level = {i: 0 for i in left if own[i] > tiny}
        queue, met = deque(level), False
        while queue:
            u = queue.popleft()
            met |= own[u] < -tiny
            for v, c in links[u].items():
                if c > tiny and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if not met:
            for i in left:
                side[i] = i in level
            return
        arcs = {u: [v for v in links[u] if level.get(v) == level[u] + 1] for u in level}
        for source in [u for u in level if level[u] == 0]:
            path = [source]
            while path and own[source] > tiny:
                u = path[-1]
                if own[u] < -tiny:
                    w = min(own[source], -own[u], *(links[a][b] for a, b in zip(path, path[1:])))
                    own[source] -= w
                    own[u] += w
                    keep = len(path)
                    for k in range(len(path) - 2, -1, -1):
                        a, b = path[k], path[k + 1]
                        links[a][b] -= w
                        links[b][a] += w
                        keep = k + 1 if links[a][b] <= tiny else keep
                    del path[keep:]
                    continue
                while arcs[u] and links[u][arcs[u][-1]] <= tiny:
                    arcs[u].pop()
                if arcs[u]:
                    path.append(arcs[u][-1])
                else:
                    path.pop()
                    if path:
                        arcs[path[-1]].pop()


def main_text(page: str) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n\n".join(text for (text, _, _), keep in zip(found, label(found)) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    src = only(pages, id_col, url_col, html_col)
    kinds = [src.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in slices(batches, html_col):
            raw = data.tobytes()
            texts = [main_text(raw[a:b].decode()) for a, b in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return src.mapInArrow(run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars bigint")
