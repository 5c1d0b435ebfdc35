"""Main text of HTML pages by a minimum cut between content and boilerplate.

A page is cut into blocks, runs of text without a block-level tag between them.  A classifier gives each block
the costs of calling it content and of calling it boilerplate; they are the capacities of its arcs from the
source and to the sink.  Blocks next to each other, and next ones under the same parent, are tied by edges
whose capacity falls with their distance in the DOM.  The minimum cut is the cheapest labelling; maximum flow
finds it.  Blocks whose own costs outweigh all their edges are labelled first, which changes no minimum.

The text of a page is that of its content blocks in page order: references decoded, white space inside a block
made one space, blocks joined by one space.

Defined cases: null and empty pages give an empty text.  Markup that is never closed ends with the page; an end
tag that closes nothing is passed over.  Work grows with the page's length, and with what its markup leaves open hardly at
all; after ``BROKEN_QUOTES`` tags whose quotes never end, quotes are letters.  Repeated rows give equal texts.  Pages may have any length.  Other
columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lexroll.llm.common import per_text, text_batches

_PLAIN_TAG = r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
_REMARK = r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
MARKUP = re.compile(
    _REMARK + r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|" + _PLAIN_TAG, re.S
)
UNQUOTED = re.compile(_REMARK + "|()()()(?!)|" + _PLAIN_TAG, re.S)
BROKEN_QUOTES = 64  # tags of a page whose quotes never end; from then on its quotes are letters like others
# Elements whose inside is no text to read.
SILENT = {"script", "style", "title", "noscript", "template", "iframe", "svg", "textarea", "select", "object", "canvas", "audio", "video", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
}
# An opening tag of the key's kind ends an open element of these kinds.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
SCOPES = {"ul", "ol", "dl", "table", "body", "html", "article", "section", "div", "main", "nav", "aside", "header", "footer", "form", "blockquote"}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "details", "dialog", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2",
    "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}

# The classifier: evidence for content, as log odds.
TAGS = {
    "article": 4.0, "main": 3.0, "nav": -7.0, "footer": -7.0, "aside": -7.0, "form": -7.0, "menu": -7.0, "dialog": -7.0,
    "button": -7.0, "header": -6.0, "head": -9.0, "fieldset": -5.0, "figcaption": 0.0,
}
WORDS_FOR = {"article": 1.5, "content": 1.0, "entry": 1.0, "main": 1.0, "post": 1.0, "story": 1.5, "body": 0.5, "text": 0.5}
WORDS_AGAINST = {
    "ad", "adbox", "ads", "adsense", "adslot", "adunit", "advert", "adverts", "advertisement", "advertisements", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "commentlist", "consent", "cookie", "cookiebar", "cookies", "copyright", "discussion", "disqus", "footer", "gdpr", "header",
    "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification",
    "overlay", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share",
    "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "subscription", "tags", "toolbar", "topbar", "widget",
}
# Inside an article these may as well name a part of it; the text and its neighbours have a say.
WORDS_DOUBTFUL = {"discussion", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "social", "tags"}
WORDS_AGAINST_ARTICLES = {"ad", "advert", "comment", "comments", "promo", "related", "reply", "sponsored"}
ROLES = {
    "main": 3.0, "article": 3.0, "navigation": -7.0, "banner": -7.0, "contentinfo": -7.0, "complementary": -7.0, "search": -7.0,
    "dialog": -7.0, "alert": -6.0, "alertdialog": -7.0, "menu": -7.0, "menubar": -7.0, "toolbar": -7.0, "form": -7.0,
}
AGAINST = -7.0
DOUBT = -3.0
HIDDEN = -9.0
STRONG = -5.0  # evidence that stands by itself, whatever is around
NEXT, SIBLING = 1.0, 0.5  # capacities of edges at distance one

ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Element:
    name: str
    number: int
    depth: int
    evidence: float
    in_article: bool
    in_link: bool
    parent: Element | None
    holder: Element | None = None  # the nearest element around that is no inline one, or this


@dataclass
class Block:
    parent: Element
    text: str
    odds: float


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(raw)} if raw.strip("/ ") else {}


def _evidence(name: str, raw: str, in_article: bool) -> float:
    own = TAGS.get(name, 0.0)
    if name == "header" and in_article:
        own = 0.0  # an article's own head holds its title
    if not raw:
        return own
    given = _attributes(raw)
    parts = {p.lower() for key in ("class", "id") for p in NAME_PARTS.findall(given.get(key, ""))}
    against = parts & (WORDS_AGAINST if name not in ("article", "main") else WORDS_AGAINST_ARTICLES)
    if against and name not in ("body", "html"):
        own = min(own, DOUBT if in_article and against <= WORDS_DOUBTFUL else AGAINST)
    else:
        own += max((WORDS_FOR[p] for p in parts & WORDS_FOR.keys()), default=0.0) if name != "body" else 0.0
    role = ROLES.get(given.get("role", "").lower(), 0.0)
    own = min(own, role) if role < 0 else own + role
    style = given.get("style", "").replace(" ", "").lower()
    if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
        own = HIDDEN
    return own


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page with the classifier's log odds for content."""
    root = Element("", 0, 0, 0.0, False, False, None)
    root.holder = root
    top, number = root, 0
    opened: dict[str, list[Element]] = {}
    scopes = [root]
    blocks: list[Block] = []
    pieces: list[str] = []
    linked = 0
    leads = False
    holder = root

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                blocks.append(Block(holder, text, _odds(holder, text, linked)))
            pieces.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal holder, linked
        if not pieces:
            holder = top.holder
        pieces.append(text)
        if top.in_link:
            linked += len(text.strip())

    def close(node: Element) -> None:
        """Leave ``node`` and all that is open inside it."""
        nonlocal top
        while top is not node.parent:
            opened[top.name].pop()
            if top is scopes[-1]:
                scopes.pop()
            top = top.parent

    def close_last(names: set[str]) -> None:
        """Leave the innermost open element of these names, unless a scope lies between."""
        last = max((opened[n][-1] for n in names if opened.get(n)), key=lambda e: e.number, default=root)
        if last is not root and last.number >= scopes[-1].number:
            close(last)

    at, markup, broken, last_end = 0, MARKUP, 0, page.rfind(">")
    while True:
        # Beyond the last ">" only an open comment is markup.
        found = markup.search(page, at) if at <= last_end or page.find("<!--", at) >= 0 else None
        if found is None:
            if at < len(page):
                say(page[at:])
            break
        if found.start() > at:
            say(page[at : found.start()])
        at = found.end()
        slash, name, raw = found.group(1), found.group(2), found.group(3)
        if name is None:
            slash, name, raw = found.group(4), found.group(5), found.group(6)
            if name is None:
                continue  # a comment or declaration
            broken += '"' in raw or "'" in raw
            if broken > BROKEN_QUOTES:
                markup = UNQUOTED
        name = name.lower()
        if name not in INLINE:
            flush()
        if slash:
            if opened.get(name):
                close(opened[name][-1])
            continue
        if name in SILENT:
            if not raw.endswith("/"):
                end = re.compile(f"</{re.escape(name)}[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in VOID:
            continue
        ended = ENDS.get(name) or ({"p"} if name in CLOSES_P else None)
        if ended:
            close_last(ended)
        if name in CLOSES_P and ended != {"p"}:
            close_last({"p"})
        number += 1
        own = _evidence(name, raw, top.in_article)
        evidence = own if own <= STRONG else top.evidence + own
        if own > 0 and name in ("article", "main") and not leads:
            # The page's own article, which a wrapper's name says nothing against.
            leads = True
            evidence = max(evidence, own)
        top = Element(
            name, number, top.depth + 1, evidence,
            top.in_article or name == "article", top.in_link or name == "a", top,
        )
        top.holder = top.parent.holder if name in INLINE else top
        opened.setdefault(name, []).append(top)
        if name in SCOPES:
            scopes.append(top)
    flush()
    return blocks


def _odds(holder: Element, text: str, linked: int) -> float:
    words = text.count(" ") + 1
    odds = holder.evidence + 0.5 + min(2.0, words / 15)
    if linked:
        odds -= 3.0 * min(1.0, linked / len(text)) * (1.0 if words < 30 else 0.3)
    if holder.name in ("h1", "h2", "h3"):
        odds += 1.0
    if text[-1] in ".!?…":
        odds += 0.5
    if text[0] in "©" or text.startswith("(c)"):
        odds -= 4.0
    return max(-9.0, min(9.0, odds))


def _distance(a: Element, b: Element) -> int:
    steps = 1
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def edges_of(blocks: list[Block]) -> dict[tuple[int, int], float]:
    """Smoothness between neighbours in the page and between neighbours under one parent."""
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            edges[i - 1, i] = NEXT / _distance(blocks[i - 1].parent, block.parent)
        above = block.parent.parent or block.parent
        j = last.get(above.number)
        if j is not None:
            edges[j, i] = edges.get((j, i), 0.0) + SIBLING
        last[above.number] = i
    return edges


def minimum_cut(source: list[float], sink: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """For each node whether it is on the source's side of a minimum cut, the smallest such side.

    ``source`` and ``sink`` are the capacities of its arcs from the source and to the sink; an edge has its
    capacity both ways.
    """
    n = len(source)
    need = [a - b for a, b in zip(source, sink)]  # flow straight through a node takes no part in the choice
    ties: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), c in edges.items():
        ties[i][j] = ties[i].get(j, 0.0) + c
        ties[j][i] = ties[j].get(i, 0.0) + c
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # nodes that no labelling of their neighbours could turn
        i = todo.popleft()
        if side[i] is None and abs(need[i]) > sum(ties[i].values()) + 1e-12:
            side[i] = need[i] > 0
            for j, c in ties[i].items():
                need[j] += c if side[i] else -c
                del ties[j][i]
                todo.append(j)
            ties[i] = {}
    open_nodes = [i for i in range(n) if side[i] is None]
    if open_nodes:
        reached = _flow({i: need[i] for i in open_nodes}, {i: dict(ties[i]) for i in open_nodes})
        for i in open_nodes:
            side[i] = i in reached
    return [bool(s) for s in side]


def _flow(need: dict[int, float], left: dict[int, dict[int, float]]) -> set[int]:
    """Push flow from nodes that have too much to nodes that lack, level by level; the nodes still reached.

    Each round measures how far nodes are from those with too much and blocks all shortest paths at once.
    """
    least = 1e-12
    while True:
        level = {i: 0 for i, x in need.items() if x > least}
        queue = deque(level)
        lacking = False
        while queue:
            i = queue.popleft()
            lacking = lacking or need[i] < -least
            for j, c in left[i].items():
                if c > least and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not lacking:
            return set(level)
        arcs, at = {i: list(left[i]) for i in level}, dict.fromkeys(level, 0)
        for source in [i for i in level if need[i] > least]:
            path = [source]
            while path and need[source] > least:
                here = path[-1]
                if need[here] < -least:
                    amount = min(need[source], -need[here], *(left[a][b] for a, b in zip(path, path[1:])))
                    for a, b in zip(path, path[1:]):
                        left[a][b] -= amount
                        left[b][a] += amount
                    need[source] -= amount
                    need[here] += amount
                    keep = next((k for k, (a, b) in enumerate(zip(path, path[1:])) if left[a][b] <= least), len(path) - 1)
                    del path[keep + 1 :]
                    continue
                while at[here] < len(arcs[here]):
                    onward = arcs[here][at[here]]
                    if left[here][onward] > least and level.get(onward) == level[here] + 1:
                        path.append(onward)
                        break
                    at[here] += 1  # it leads nowhere in this round
                else:
                    level[here] = -1
                    path.pop()


def main_text_of(page: str | None) -> str:
    """The main text of one whole page."""
    blocks = blocks_of(page or "")
    # The cost of a label is the negative log of its probability.
    as_boilerplate = [math.log1p(math.exp(b.odds)) for b in blocks]
    as_content = [math.log1p(math.exp(-b.odds)) for b in blocks]
    content = minimum_cut(as_boilerplate, as_content, edges_of(blocks))
    return " ".join(b.text for b, kept in zip(blocks, content) if kept)


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row."""
    text_batches(pages.sparkSession)
    found = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        per_text(main_text_of, "string")(F.col(html_col)).alias("text"),
    )
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
