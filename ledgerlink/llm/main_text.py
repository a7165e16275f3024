"""Main text of HTML pages by a minimum cut over their blocks.

A page is read once from start to end.  Text between two block boundaries is a block; it carries its size, its share of
linked characters and the evidence of the elements around it.  A linear classifier turns these into log odds for
"content", whose two sides are the capacities from the source and to the sink.  Smoothness edges join each block to
the next one (adjacency) and to the previous block of the same parent element (DOM proximity); an edge weakens as the
evidence around its two blocks differs, so that an advert between two paragraphs isn't swept along.  The blocks on the
source's side of a minimum cut are the main text.

The classifier's weights are fixed (pages have no labels): a page's text depends on that page alone.

The cut is exact.  A block whose own capacity exceeds all its smoothness edges lies on the same side of every minimum
cut, so it's merged into its terminal; what stays open goes through augmenting paths, one connected part at a time.

Defined results.  Null, empty or text-free html: the empty text.  Character references are decoded once; white space
inside a block (also no-break spaces and line breaks) becomes one space; blocks are joined by one space in page order.
Script, style, template, head and form controls never give text.  Elements left open end with the page; end tags
without a start are passed over.  Ties of the cut go to boilerplate.  Repeated rows are read alike; an empty table gives no
rows; extra columns are kept.  Very long pages are read in time linear in their length; a task holds one batch of
pages and one page's blocks.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlink.llm.frames import fresh, modest_batches

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
SILENT = frozenset("script style title textarea xmp iframe noembed noframes head template noscript svg canvas audio video object select option "
                   "optgroup datalist button map".split())
CLOSES_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
                 "thead": ("table",), "tbody": ("table",), "tfoot": ("table",), "option": ("select",)}
SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "thead": ("thead", "tbody", "tfoot"),
        "tbody": ("thead", "tbody", "tfoot"), "tfoot": ("thead", "tbody", "tfoot")}

# Evidence, in log odds for content.
AWAY, NEAR_TITLE, TOWARDS, HINTED = -6.0, -1.5, 3.0, 1.5
AWAY_TAGS = frozenset("nav footer aside form menu dialog".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
AWAY_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising adsbygoogle sponsor sponsored sponsors promo promos promotion banner menu menus nav navbar "
    "navigation breadcrumb breadcrumbs sidebar sidebars aside footer foot masthead topbar toolbar cookie cookies consent gdpr notice notices alert alerts "
    "popup modal overlay newsletter subscribe subscription signup login register search share sharing social related recommended recommendations teaser "
    "teasers comment comments commentlist reply replies respond disqus feedback reactions widget widgets copyright legal disclaimer pagination pager tagcloud "
    "skip hidden".split())
TITLE_WORDS = frozenset(["header", "head"])
TOWARDS_WORDS = frozenset("article articlebody content post entry story main body text prose".split())
LAYOUT_WORDS = frozenset("has with no without layout".split())
BIAS, PER_WORD, MOST_WORDS, LINKED, SENTENCE, PARAGRAPH, LEGAL = -0.8, 0.1, 30, -4.0, 0.5, 0.5, -2.0
LEGAL_TEXT = re.compile(r"©|\bcopyright\b|all rights reserved|\bcookies?\b", re.I)
ADJACENT, SIBLING = 0.4, 1.2
#: Capacities are whole numbers: thousandths.
SCALE = 1000

_TOKEN = re.compile(r"<!--(?:>|->|.*?(?:-->|\Z))|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TELLING = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SENTENCE_END = re.compile(r"[.!?…。！？:;][\"'”’»)\]]*$")


def _attribute_evidence(attributes: str) -> tuple[float, bool]:
    """(evidence, whether it names a title area) of an element's attributes."""
    score, title = 0.0, False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _UNSEEN.search(value):
            score = AWAY
        elif name == "role":
            if value in AWAY_ROLES:
                score = AWAY
            elif value in ("main", "article"):
                score = score or TOWARDS
        elif name in ("class", "id", "itemprop"):
            for token in value.split():
                words = set(re.findall(r"[a-z]+", token))
                if words & LAYOUT_WORDS:
                    continue
                if words & AWAY_WORDS:
                    score = AWAY
                elif words & TITLE_WORDS:
                    title = True
                elif words & TOWARDS_WORDS:
                    score = score or HINTED
    return score, title


class _Reader:
    """Reads pages; keeps the evidence of attribute strings met before."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[float, bool]] = {}

    def _evidence(self, tag: str, attributes: str, inside: bool) -> tuple[float, float]:
        """(evidence against, evidence for) that an element adds; ``inside``: it stands in an article or main element."""
        score, title = 0.0, tag == "header"
        if attributes and _TELLING.search(attributes):
            if attributes not in self.known:
                if len(self.known) > 10_000:
                    self.known.clear()
                self.known[attributes] = _attribute_evidence(attributes)
            score, named = self.known[attributes]
            title = title or named
        if tag in AWAY_TAGS or score <= AWAY:
            return AWAY, 0.0
        if title:
            return (NEAR_TITLE if inside else AWAY), 0.0
        return 0.0, TOWARDS if tag in ("article", "main") else score

    def blocks(self, page: str) -> list[tuple[str, int, float, int, str]]:
        """(text, linked characters, evidence, number of the parent element, tag) of each block in page order."""
        found: list[tuple[str, int, float, int, str]] = []
        # open elements: (tag, number, against, for, inside an article or main, silent, against by a form)
        stack: list[tuple[str, int, float, float, bool, bool, float]] = [("", 0, 0.0, 0.0, False, False, 0.0)]
        number, links, linked, pieces, at, end = 0, 0, 0, [], 0, len(page)

        def flush() -> None:
            nonlocal linked
            if pieces:
                text = " ".join("".join(pieces).split())
                pieces.clear()
                if text:
                    k = len(stack) - 1
                    while k and stack[k][0] in INLINE:
                        k -= 1
                    tag, _, against, toward, _, _, form = stack[k]
                    found.append((text, linked, against + form + min(toward, TOWARDS), stack[max(k - 1, 0)][1], tag))
            linked = 0

        def close(k: int) -> None:
            """End the element at place ``k`` of the stack and all inside it."""
            nonlocal links
            if any(x[0] not in INLINE for x in stack[k:]):
                flush()
            links -= sum(x[0] == "a" for x in stack[k:])
            del stack[k:]

        def add(text: str) -> None:
            nonlocal linked
            if text and not stack[-1][5]:
                if "&" in text:
                    text = html.unescape(text)
                pieces.append(text)
                if links:
                    linked += len(text)

        while at < end:
            m = _TOKEN.search(page, at)
            if m is None:
                add(page[at:])
                break
            add(page[at:m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        close(k)
                        break
                    if tag in INLINE and stack[k][0] not in INLINE:
                        break  # an inline element doesn't end the blocks it stands in
                else:
                    if tag not in INLINE:
                        flush()
                continue
            if tag in INLINE:
                if tag in VOID:
                    continue
            else:
                if tag in CLOSES_ITSELF:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] in SAME.get(tag, (tag,)):
                            close(k)
                            break
                        if stack[k][0] in CLOSES_ITSELF[tag]:
                            break
                if tag == "br":
                    pieces.append(" ")
                    continue
                for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] not in INLINE:
                        break
                flush()
                if tag in VOID:
                    continue
            number += 1
            _, _, against, toward, inside, silent, form = stack[-1]
            minus, plus = self._evidence(tag, m[3], inside)
            if tag in ("article", "main") and not minus:
                inside, form = True, 0.0  # a form around an article holds the page, not fields
            if tag == "form":
                minus, form = 0.0, AWAY
            if tag == "a":
                links += 1
            if tag in RAW:
                ending = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                at = ending.start() if ending else end
            stack.append((tag, number, min(against, minus), toward + plus, inside, silent or tag in SILENT, form))
        close(1)
        flush()
        return found


def score(block: tuple[str, int, float, int, str]) -> float:
    """Log odds that a block is content."""
    text, linked, evidence, _, tag = block
    words = text.count(" ") + 1
    out = BIAS + evidence + PER_WORD * min(words, MOST_WORDS) + LINKED * min(1.0, linked / len(text))
    if _SENTENCE_END.search(text[-8:]):
        out += SENTENCE
    if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote"):
        out += PARAGRAPH
    if words <= MOST_WORDS and LEGAL_TEXT.search(text):
        out += LEGAL
    return out


def edges_of(blocks: list[tuple[str, int, float, int, str]]) -> dict[tuple[int, int], int]:
    """Smoothness: (earlier, later) -> capacity."""
    edges: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for j, b in enumerate(blocks):
        for i, weight in ((j - 1, ADJACENT), (last.get(b[3], -1), SIBLING)):
            if i >= 0 and (w := round(SCALE * weight * math.exp(-abs(blocks[i][2] - b[2])))):
                edges[i, j] = edges.get((i, j), 0) + w
        last[b[3]] = j
    return edges


def minimum_cut(unary: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """Which nodes lie on the source's side of the least minimum cut.  ``unary``: capacity from the source less that to the sink."""
    n = len(unary)
    own, near = list(unary), [{} for _ in range(n)]
    for (i, j), w in edges.items():
        near[i][j] = near[i].get(j, 0) + w
        near[j][i] = near[j].get(i, 0) + w
    side: list[bool | None] = [None] * n
    pull = [sum(x.values()) for x in near]
    ready = [i for i in range(n) if abs(own[i]) > pull[i]]
    while ready:  # merge what no cut can part from its terminal
        i = ready.pop()
        if side[i] is not None:
            continue
        side[i] = own[i] > 0
        for j, w in near[i].items():
            if side[j] is None:
                own[j] += w if side[i] else -w
                pull[j] -= w
                if abs(own[j]) > pull[j]:
                    ready.append(j)
    for i in range(n):
        if side[i] is None:
            part, queue = {i}, deque([i])
            while queue:
                for j in near[queue.popleft()]:
                    if side[j] is None and j not in part:
                        part.add(j)
                        queue.append(j)
            reached = _max_flow(part, own, near)
            for j in part:
                side[j] = j in reached
    return side  # type: ignore[return-value]


def _max_flow(part: set[int], own: list[int], near: list[dict[int, int]]) -> set[int]:
    """What the source still reaches after shortest augmenting paths have carried the maximum flow."""
    spare = {i: max(own[i], 0) for i in part}
    room = {i: max(-own[i], 0) for i in part}
    left = {i: {j: w for j, w in near[i].items() if j in part} for i in part}
    while True:
        before: dict[int, int | None] = {i: None for i in part if spare[i]}
        queue, goal = deque(before), None
        while queue:
            i = queue.popleft()
            if room[i]:
                goal = i
                break
            for j, w in left[i].items():
                if w and j not in before:
                    before[j] = i
                    queue.append(j)
        if goal is None:
            return set(before)
        path = [goal]
        while (i := before[path[-1]]) is not None:
            path.append(i)
        flow = min(spare[path[-1]], room[goal], *[left[i][j] for j, i in zip(path, path[1:], strict=False)])
        spare[path[-1]] -= flow
        room[goal] -= flow
        for j, i in zip(path, path[1:], strict=False):
            left[i][j] -= flow
            left[j][i] += flow


def extract(page: str | None, reader: _Reader | None = None) -> str:
    """The main text of one page."""
    blocks = (reader or _Reader()).blocks(page or "")
    side = minimum_cut([round(SCALE * score(b)) for b in blocks], edges_of(blocks))
    return " ".join(b[0] for b, kept in zip(blocks, side, strict=True) if kept)


def main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text", keep_html: bool = True) -> DataFrame:
    """``pages`` with its main text (a column under another name if ``text_col`` is taken)."""
    modest_batches(pages.sparkSession)
    kept = [c for c in pages.columns if keep_html or c != html_col]
    name = fresh(pages.select(*kept), text_col)
    schema = T.StructType([*[pages.schema[c] for c in kept], T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader()
        for b in batches:
            texts = pa.array([extract(x.as_py(), reader) for x in b.column(html_col)], type=pa.string())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], texts], names=[*kept, name])

    return pages.mapInArrow(run, schema)
