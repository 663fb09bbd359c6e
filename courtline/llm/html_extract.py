"""Operator 7: main-text extraction by minimum-cut labelling.

A page becomes a row of text blocks.  A linear classifier turns each block's
markers and text figures into a cost of calling it boilerplate or content;
these are the capacities to the two terminals.  Blocks that follow each other
and blocks of one container are joined by smoothness edges, weaker the
farther apart they lie in the DOM.  The source side of a minimum cut is the
article.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template svg iframe object select".split())
PLAIN_INLINE = frozenset("abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small strike strong sub sup time tt u var".split())
PLAIN_INLINE |= frozenset("math mfrac mi mn mo mover mroot mrow ms msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics annotation".split())
INLINE = frozenset("a span label".split())
BOILER_TAGS = frozenset("nav footer aside form button dialog menu".split())
CONTENT_TAGS = frozenset("article main".split())
# Words of class, id and role that mark boilerplate or content.
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs captcha comment comments contentinfo cookie"
    " cookies consent copyright dialog discussion disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice"
    " notices pager pagination paywall popup promo promoted promotion related replies reply respond search share sharing sidebar signup social"
    " sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
WRAP_WORDS = frozenset("container has layout outer with wrap wrapper".split())
CONTENT_WORDS = frozenset("article articlebody content entry main mainbody maincontent post story".split())
# The classifier's weights.
MARKED, WORDS_GAIN, WORDS_MOST, LINKS, SENTENCE, HEADING, BIAS = 12.0, 0.06, 60, 5.0, 0.8, 0.6, -0.4
ADJACENT, CONTAINER = 1.2, 0.8

_OPEN = r"<!--.*?-->|<!--.*\Z|<[!?][^>]*>"
_BROKEN = r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>"
_TAG = re.compile(_OPEN + r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|" + _BROKEN, re.S)
#: For pages with quotes that never close: each such tag is read to the page's end first, which is done BROKEN_TAGS times.
BROKEN_TAGS = 50
_PLAIN_TAG = re.compile(_OPEN + r"|<()()()(?!)|" + _BROKEN, re.S)
_MARKS = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_TOKEN = re.compile(r"[a-z0-9]+")
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("ul ol dl table body html article section div main td th blockquote".split())


def _mark(tag: str, attributes: str, inside: int) -> int:
    """1 content, -1 boilerplate, 0 no marker of its own; ``inside`` is the parent's."""
    words: set[str] = set()
    for name, value in _MARKS.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return -1
        if name in ("class", "id", "role"):
            words.update(_TOKEN.findall(value))
    if words & BOILER_WORDS and words & WRAP_WORDS and words & CONTENT_WORDS:
        return 0
    if tag in BOILER_TAGS or (tag not in ("body", "html") and words & BOILER_WORDS and not (tag in CONTENT_TAGS and inside == 0 and not words & {"comment", "comments", "reply", "ad", "sponsored", "related"})):
        return -1
    if tag == "header":
        return 0 if inside == 1 else -1
    return 1 if tag in CONTENT_TAGS or words & CONTENT_WORDS else 0


def blocks(page: str) -> list[tuple]:
    """(text, mark, share of linked characters, heading, container, depth, top) in page order.

    ``top`` is the least depth passed since the block before."""
    stack: list[tuple] = [("", 0, 0, False)]  # tag, mark, number, block level
    found, parts = [], []
    at = number = linked = links = 0
    top = 0

    def flush():
        nonlocal linked, top
        if parts:
            raw = "".join(parts)
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                box = next(e for e in reversed(stack) if e[3] or not e[0])
                heading = any(e[0] in ("h1", "h2", "h3", "h4", "h5", "h6") for e in stack[-2:])
                parent = next((e for e in reversed(stack) if e[3] and e[2] != box[2]), stack[0])
                found.append((text, stack[-1][1], min(1.0, linked / len(raw)), heading, parent[2], len(stack), top))
                top = len(stack)
        parts.clear()
        linked = 0

    # behind the last ">" no tag ends; what a comment or declaration opens there goes
    last = page.rfind(">") + 1
    cut = re.compile("<[!?]").search(page, last)
    stop = cut.start() if cut else len(page)
    pattern, broken, unclosed = _TAG, 0, set()
    while True:
        tag = pattern.search(page, at, last) if at < last else None
        if tag is not None and tag[5] and pattern is _TAG:
            broken += 1
            pattern = _TAG if broken < BROKEN_TAGS else _PLAIN_TAG
        if tag is not None and tag.end() == last and tag[0].startswith("<!--") and not tag[0].endswith("-->"):
            last = stop = tag.start()
            tag = None
        end = tag.start() if tag else max(at, stop)
        if end > at:
            piece = page[at:end]
            parts.append(piece)
            linked += len(piece) if links else 0
        if tag is None:
            break
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        if tag[1] or tag[4]:  # an end tag
            if name in PLAIN_INLINE:
                continue
            if name not in INLINE:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    if name in INLINE and stack[k][1] != stack[k - 1][1]:
                        flush()
                    links -= sum(e[0] == "a" for e in stack[k:])
                    del stack[k:]
                    top = min(top, len(stack))
                    break
                if name in INLINE and stack[k][3]:
                    break
            continue
        if name in RAW:
            close = None if name in unclosed else re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            if close is None:
                unclosed.add(name)
                if name in ("svg", "object", "select", "iframe"):
                    continue
                break
            at = page.find(">", close.start()) + 1 or len(page)
            continue
        if name in VOID:
            if name == "hr":
                flush()
            parts.append(" ")
            continue
        if name in PLAIN_INLINE:
            continue
        block = name not in INLINE
        if block:
            flush()
            shut = _CLOSES.get(name, {"p"} if name not in ("body", "html") else ())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in shut or (stack[k][0] == "p" and stack[k][3]):
                    links -= sum(e[0] == "a" for e in stack[k:])
                    del stack[k:]
                    top = min(top, len(stack))
                    break
                if stack[k][0] in _SCOPES:
                    break
        inside = stack[-1][1]
        own = _mark(name, tag[3] or tag[6] or "", inside)
        if own and own != inside and not block:
            flush()
        number += 1
        links += name == "a"
        stack.append((name, own or inside, number, block))
    flush()
    return found


def _score(block: tuple) -> float:
    """Above 0: content is likelier."""
    text, mark, share, heading = block[:4]
    words = text.count(" ") + 1
    return BIAS + MARKED * mark + WORDS_GAIN * min(words, WORDS_MOST) - LINKS * share + SENTENCE * text.endswith((".", "!", "?", "…", "。")) + HEADING * heading


def source_side(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Blocks on the source side of a minimum cut (Dinic's algorithm)."""
    n = len(scores)
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, there: float, back: float) -> None:
        graph[a].append(len(to))
        to.append(b)
        room.append(there)
        graph[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, s in enumerate(scores):
        if s > 0:
            join(source, i, s, 0.0)
        else:
            join(i, sink, -s, 0.0)
    for a, b, w in edges:
        join(a, b, w, w)
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if room[e] > 1e-9 and to[e] not in level:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if sink not in level:
            return [i in level for i in range(n)]
        next_edge = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                push = min(room[e] for e in path)
                for e in path:
                    room[e] -= push
                    room[e ^ 1] += push
                cut = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while next_edge[a] < len(graph[a]):
                e = graph[a][next_edge[a]]
                if room[e] > 1e-9 and level.get(to[e], -1) == level[a] + 1:
                    break
                next_edge[a] += 1
            else:
                if a == source:
                    break
                e = path.pop()
                a = to[e ^ 1]
                next_edge[a] += 1
                continue
            path.append(e)
            a = to[e]


def main_blocks(page: str) -> list[str]:
    found = blocks(page)
    edges, last = [], {}
    for i, (_, _, _, _, parent, depth, top) in enumerate(found):
        if i:
            apart = (depth - top) + (found[i - 1][5] - top)
            edges.append((i - 1, i, ADJACENT / (1 + max(0, apart))))
        if last.get(parent, i - 1) < i - 1:
            edges.append((last[parent], i, CONTAINER))
        last[parent] = i
    keep = source_side([_score(b) for b in found], edges)
    return [b[0] for b, kept in zip(found, keep) if kept]


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with text (the article's blocks, joined by an empty line) and n_chars.

    Null and empty pages, and pages without an article, have the empty text.
    Pages of any length are read whole; repeated rows are extracted each;
    columns of ``pages`` named text or n_chars are replaced, others kept."""

    @F.pandas_udf("string")
    def main_text(batch: pd.Series) -> pd.Series:
        return pd.Series(["\n\n".join(main_blocks(p)) if p else "" for p in batch], dtype=object)

    return pages.withColumn("text", main_text(F.col(html_col))).withColumn("n_chars", F.length("text").cast("long"))
