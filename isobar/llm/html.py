"""Main text of web pages: blocks are labelled content or boilerplate by a minimum cut.

A page becomes blocks of text in page order. A classifier scores each block by its tags, names, links, length and
punctuation; a positive score is what calling it boilerplate costs, a negative one what calling it content costs. Every
feature is bounded, and scores and edges are of one order. Neighbours in page order and in the same container pay for
differing labels. The labelling of least total cost is the minimum cut between two terminals, found by maximum flow.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches

#: Text, a comment or declaration, or a tag. A tag starts with a letter and holds no "<" outside of quoted values; a "<" that
#: starts none of these is text.
_TOKEN = re.compile(r"[^<]++|<!--.*?(?:-->|\Z)|<![^>]*+>?|<\?[^>]*+>?|</?[a-zA-Z][^\s/><]*+(?:[^<>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[=\"'])*+>|<", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements whose inside is no text of the page.
_SILENT = {"script", "style", "head", "title", "noscript", "template", "svg", "iframe", "object", "select", "textarea", "button", "canvas", "audio", "video", "math"}
#: Elements whose inside is not read as markup: only their own end tag ends them.
_RAW = {"script", "style", "title", "textarea", "noscript", "iframe"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: What a form is filled in by, and characters of text for each from which on a form is a wrapper of the page.
_CONTROLS, _WRAPPING = {"input", "select", "textarea", "button", "label"}, 60
#: A tag that the page's end cuts off: markup, as browsers have it.
_UNFINISHED = re.compile(r"</?[a-zA-Z][^<>]*+\Z")
#: Blocks that are lines of the block around them, which is their container.
_LINES = set("p li h1 h2 h3 h4 h5 h6 pre dt dd tr td th caption figcaption hr center".split())
_BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
_CONTENT = {"article", "main"}
_BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumb\w*|footer|header|masthead|sidebar|side|rail|widget\w*|cookie\w*|consent|notice|alert|"
    r"popup|modal|overlay|comment\w*|respond|repl(?:y|ies)|disqus|share|sharing|social|related|recommend\w*|newsletter|subscri\w*|signup|login|pagination|pager|tags?|copyright|legal|"
    r"navigation|complementary|contentinfo|search)(?:$|[\s_-])",
    re.I,
)
_GOOD_NAME = re.compile(r"(?:^|[\s_-])(?:article\w*|content|post|entry|story|main|body|text|articlebody)(?:$|[\s_-])", re.I)
#: Names that say what a wrapper has or lacks, and headers of the content itself.
_MODIFIER = re.compile(r"(?:^|(?<=\s))(?:has|with|without|no)[-_]\S*|(?:post|entry|article|story|content)[-_]+header(?=$|[\s_-])", re.I)
_HEADER = re.compile(r"(?:^|(?<=[\s_-]))header(?=$|[\s_-])", re.I)
_SUBJECT = re.compile(r"(?:^|(?<=\s))tag-\S*", re.I)
#: Scores of where a block stands: inside boilerplate's own tags, a bad name, an element of content, a good name; what is left
#: of the latter two inside a bad name. The innermost of them counts, but nothing lifts text out of boilerplate's tags.
TAG, NAME, CONTENT, GOOD, CONTENT_IN_BAD, GOOD_IN_BAD = -5.0, -3.5, 3.0, 1.5, 2.0, 1.0
#: The score that a page's best open block is lifted to if no block's is positive, enough to hold against a neighbour's edges.
LEAST = 2.5
_WORD = re.compile(r"\w")


@dataclass
class Block:
    start: int
    end: int
    text: str
    depth: int
    shared: int  # depth of the innermost element that also holds the block before
    container: int
    place: float
    heading: bool
    linked: int
    form: int  # number of the form around it, 0 for none
    bare: float  # its place if forms were nothing


@dataclass
class _Open:
    """An open element, with what holds for all text inside it, so that no step looks through the whole stack."""

    tag: str
    block: int  # place in the stack of the innermost block, itself included
    container: int  # number of the innermost block that is no line of another
    place: float
    fixed: bool  # inside boilerplate's own tags
    good: bool
    content: bool
    heading: bool
    anchors: int
    form: int
    bare: float


_ROOT = _Open("", -1, 0, 0.0, False, False, False, False, 0, 0, 0.0)


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=list)
    at: dict[str, list[int]] = field(default_factory=dict)
    parts: list[str] = field(default_factory=list)
    start: int = 0
    end: int = 0
    linked: int = 0
    opened: int = 0
    lowest: int = 0
    controls: dict[int, int] = field(default_factory=dict)

    @property
    def top(self) -> _Open:
        return self.stack[-1] if self.stack else _ROOT

    def close(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            o, depth = self.top, len(self.stack)
            self.blocks.append(Block(self.start, self.end, text, depth, min(self.lowest, depth), o.container, o.place, o.heading, self.linked, o.form, o.bare))
            self.lowest = depth
        self.parts, self.linked = [], 0

    def cut(self, n: int) -> None:
        """Closes all but the first ``n`` open elements."""
        while len(self.stack) > n:
            self.at[self.stack.pop().tag].pop()
        self.lowest = min(self.lowest, n)

    def open(self, tag: str, token: str) -> None:
        o = self.top
        names = " ".join(a or b or c for _, a, b, c in _ATTRIBUTE.findall(token))
        own = _MODIFIER.sub(" ", names)
        if o.content:
            own = _HEADER.sub(" ", own)
        bad = bool(own and _BAD_NAME.search(own))
        fixed = o.fixed or tag in _BOILERPLATE and tag != "form" or tag == "header" and not o.good
        named_good = bool(names and _GOOD_NAME.search(names))
        good = o.good or tag in _CONTENT or named_good and not bad
        # A comment or a promoted page can be an article too; tag-x only says what an article is about.
        other = tag == "article" and bool(_BAD_NAME.search(_SUBJECT.sub(" ", own)))

        def within(place: float, forms: bool) -> float:
            if fixed:
                return TAG
            if tag in _CONTENT:
                return min(place, GOOD if named_good else NAME) if other else CONTENT_IN_BAD if place < 0 else CONTENT
            if forms and tag == "form" or bad and tag not in ("html", "body"):
                return NAME
            return (GOOD_IN_BAD if place < 0 else max(place, GOOD)) if named_good else place

        place, bare = within(o.place, True), within(o.bare, False)
        self.opened += 1
        form = o.form
        if tag == "form" and not form:
            form = self.opened
            self.controls[form] = 0
        n, is_block = len(self.stack), tag in _BLOCK
        container = self.opened if is_block and tag not in _LINES else o.container
        heading = o.heading or tag in ("h1", "h2", "h3", "blockquote", "pre")
        self.stack.append(_Open(tag, n if is_block else o.block, container, place, fixed, good, o.content or tag in _CONTENT, heading, o.anchors + (tag == "a"), form, bare))
        self.at.setdefault(tag, []).append(n)


def _silent_end(html: str, tag: str, at: int, never: set[str]) -> int:
    """Where the element of no text that starts before ``at`` ends; ``at`` itself if nothing ends it (a raw one ends with the page)."""
    if tag not in never:
        deep, edge = 1, re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>?", re.I)
        for m in edge.finditer(html, at):
            deep += -1 if m.group(1) else 0 if tag in _RAW or m.group().endswith("/>") else 1
            if not deep:
                return m.end()
        never.add(tag)
    return len(html) if tag in ("script", "style") else at


def blocks_of(html: str) -> list[Block]:
    """The page's blocks of text in page order; scripts, styles and the like give none. Broken markup never fails.

    An element of no text that is never closed is only its start tag, but for scripts and styles, which go on to the end.
    """
    page, never, pos = _Page(), set(), 0
    while pos < len(html):
        m = _TOKEN.match(html, pos)
        token, begin, pos = m.group(), pos, m.end()
        if token == "<" and _UNFINISHED.match(html, begin):
            break
        if token[0] != "<" or token == "<":
            if not page.parts:
                page.start = begin
            text = unescape(token)
            page.parts.append(text)
            page.end = pos
            if page.top.anchors:
                page.linked += len(" ".join(text.split()))
            continue
        name = _NAME.match(token)
        if not name:
            continue
        tag, closing = name.group(1).lower(), token[1] == "/"
        if tag in _CONTROLS and not closing and page.top.form:
            page.controls[page.top.form] += 1
        if tag in _SILENT:
            if not closing and tag != "head" and not token.endswith("/>"):
                pos = _silent_end(html, tag, pos, never)
            continue
        if tag == "br":
            page.parts.append(" ")
            continue
        if tag in _BLOCK:
            page.close()
        if closing:
            at = page.at.get(tag)
            if at and (tag in _BLOCK or at[-1] > page.top.block):
                page.cut(at[-1])
            continue
        if tag in _VOID or token.endswith("/>"):
            continue
        if tag in _BLOCK:
            # An open paragraph ends where another block begins, with whatever inline marks were left open in it.
            at = page.top.block
            if at >= 0 and (page.stack[at].tag == "p" or page.stack[at].tag == tag == "li"):
                page.cut(at)
        page.open(tag, token)
    page.close()
    _unwrapped(page)
    return page.blocks


def _unwrapped(page: _Page) -> None:
    """A form that holds most of the page's text, and much of it for each control, says nothing about what it holds."""
    inside = dict.fromkeys(page.controls, 0)
    total = 0
    for b in page.blocks:
        if b.place > TAG:
            total += len(b.text)
            if b.form:
                inside[b.form] += len(b.text)
    wrappers = {f for f, n in inside.items() if 2 * n >= total and n >= _WRAPPING * page.controls[f]}
    for b in page.blocks:
        if b.form in wrappers:
            b.place = b.bare


def _owned(text: str) -> bool:
    return text.startswith("©") or "all rights reserved" in text.lower()


def score(b: Block) -> float:
    """How much the block looks like content (positive) or boilerplate (negative): a sum of bounded features."""
    words, share = b.text.count(" ") + 1, b.linked / max(len(b.text), 1)
    x = b.place
    x += min(max(0.7 * log2(words / 12), -1.2), 1.2)
    x += 0.4 if b.text[-1] in ".!?…\"”»。！？" else -0.3
    x += -(1.2 if b.place > 0 else 2.5) * share if share > 0.5 else 0.3 if share < 0.2 else 0.0
    x += 0.6 if b.heading else 0.0
    if _owned(b.text):
        x -= 2.5
    return x


def scores_of(blocks: list[Block]) -> list[float]:
    """The blocks' scores, relative to their page: where nothing speaks for any block, the best of those that nothing but their
    size speaks against is lifted to LEAST, and the others of that kind with it."""
    scores = [score(b) for b in blocks]
    if max(scores, default=0.0) > 0:
        return scores
    open_ = [b.place >= 0 and 2 * b.linked <= len(b.text) and bool(_WORD.search(b.text)) and not _owned(b.text) for b in blocks]
    lift = LEAST - max((x for x, ok in zip(scores, open_, strict=True) if ok), default=0.0)
    return [x + lift if ok else x for x, ok in zip(scores, open_, strict=True)]


def minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each node whether it stays on the source's side of a minimum cut; edges cost their weight in either direction.

    Flow goes along shortest paths in levels until none is left.
    """
    n = len(source)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b), cap.append(forth)
        out[b].append(len(to))
        to.append(a), cap.append(back)

    for i in range(n):
        through = min(source[i], sink[i])
        if source[i] > through:
            add(s, i, source[i] - through, 0.0)
        if sink[i] > through:
            add(i, t, sink[i] - through, 0.0)
    for a, b, w in edges:
        add(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if cap[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                push = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push
                k = next(i for i, e in enumerate(path) if cap[e] <= 1e-12)
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            while at[u] < len(out[u]):
                e = out[u][at[u]]
                if cap[e] > 1e-12 and level[to[e]] == level[u] + 1:
                    break
                at[u] += 1
            if at[u] < len(out[u]):
                path.append(out[u][at[u]])
                u = to[path[-1]]
            elif u == s:
                break
            else:
                level[u] = -1
                u = to[path.pop() ^ 1]


def main_blocks(html: str, *, adjacent: float = 0.8, same_container: float = 1.2) -> list[Block]:
    """The blocks that the minimum cut labels content, in page order.

    Neighbours in page order pay ``adjacent`` for differing labels, less the less of their path from the root they share;
    successive blocks of one container pay ``same_container``.
    """
    blocks = blocks_of(html)
    if not blocks:
        return []
    scores = scores_of(blocks)
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, adjacent * (1 + b.shared) / (1 + max(b.depth, blocks[i - 1].depth))))
        if b.container in last:
            edges.append((last[b.container], i, same_container))
        last[b.container] = i
    return [b for b, kept in zip(blocks, _kept(scores, edges), strict=True) if kept]


def _kept(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    return minimum_cut([max(x, 0.0) for x in scores], [max(-x, 0.0) for x in scores], edges)


def extract(pages: DataFrame, *, html: str = "html") -> DataFrame:
    """``pages`` without its html, with ``text`` and ``spans`` (start, end of each kept block in the html).

    Character references are decoded, white space in a block becomes one blank, blocks are trimmed and joined in page order
    by one blank. Null and empty pages and pages without content have an empty text and no spans; a page whose only text is short
    keeps it, one of links, menus, forms and notices doesn't. Each row is worked on by
    itself; other columns pass through, but columns named text or spans are replaced.
    """
    small_batches(pages.sparkSession, 256)
    kept = [c for c in pages.columns if c not in (html, "text", "spans")]
    inner = [f"_{k}" for k in range(len(kept))]  # names of columns can hold anything
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for page in batch.column(len(kept)).to_pylist():
                found = main_blocks(page or "")
                texts.append(" ".join(b.text for b in found))
                spans.append([{"start": b.start, "end": b.end} for b in found])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(spans, span)], names=[*inner, "text", "spans"])

    source = pages.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(kept, inner, strict=True)), F.col(f"`{html}`").cast("string").alias("_html"))
    schema = "".join(f"{k} {source.schema[k].dataType.simpleString()}, " for k in inner)
    return source.mapInArrow(run, f"{schema}text string, spans array<struct<start:int,end:int>>").toDF(*kept, "text", "spans")
