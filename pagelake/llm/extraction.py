"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines, one for each block of the page. A line weighs the length
of its text outside links, and nothing inside menus, headers, footers, sidebars,
notices, adverts, forms and comments. The weights are summed over a sliding window of
lines; where the sum surges over the threshold a passage begins, at an empty line from
which it dives below the passage ends, and the weighing lines between are kept. The mark
of an article raises the weight of each of its lines to a surge of its own; lines outside
it keep their weight, and its ends separate passages. On a page without a surge the
heaviest window is one.

Short blocks join a passage of their container, also past an advert; blocks of links only
do so if they are paragraphs or headings, or stand between kept blocks. A container named
like something beside the text is none if it holds most of the page's weight, and a
heading is never one by its name.

Defined cases: null and empty html give an empty text; a cut-off tag at the end is
dropped, cut-off character references stay as they are; repeated pages each give
their text; other columns pass through, and a clash with ``out`` raises
``ValueError``.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

WINDOW = 3
SURGE = 86  # characters in a window that start a passage

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|textarea|title|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(/?)>"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<[a-zA-Z/][^<>]*(?:>|\Z)",
    re.S | re.I,
)
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li "
    "main menu nav ol optgroup option p pre section select summary table tbody td tfoot th "
    "thead tr ul".split()
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BESIDE = frozenset(
    "head nav footer aside form menu dialog button select option label fieldset".split()
)
_NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo "
    "promotion sidebar widget menu nav navbar navigation breadcrumb breadcrumbs footer header "
    "masthead topbar cookie cookies consent gdpr notice alert newsletter subscribe signup login "
    "popup modal overlay share sharing social related recommended recommendations comment "
    "comments discussion disqus respond reply replies pagination pager toolbar".split()
)
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu".split()
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
_NEVER = frozenset(["html", "body", "main"])
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Blocks of text: their lines belong to the container around them.
_PROSE = _HEADINGS | {"p", "pre", "blockquote"}
_TEXTUAL = _PROSE | frozenset(
    "address caption center dd details dl dt figcaption figure hr legend li ol summary table "
    "tbody td tfoot th thead tr ul".split()
)


def _beside(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether this element stands beside the main text, by its tag or role, and by its
    name alone.
    """
    if tag in _NEVER:
        return False, False
    if tag in _BESIDE or (tag == "header" and not in_article):
        return True, False
    named = False
    for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        words = _PARTS.split(value.lower())
        if name.lower() == "role":
            if not _ROLES.isdisjoint(words):
                return True, False
        elif not _NAMED.isdisjoint(words):
            named = tag not in _HEADINGS
    return False, named


class _Lines:
    """Lines of a page: text, weight, whether inside an article, container, and whether
    a paragraph or heading.

    ``spared``: numbers of elements that their names do not put beside the text; None
    spares all and measures them, for ``held``: number, weight inside.
    """

    def __init__(self, surge: int, spared: frozenset[int] | None) -> None:
        self.surge, self.spared = surge, spared
        self.lines: list[tuple[str, int, bool, int, bool]] = []
        # tag, beside, article, link; container of own text, of blocks inside; prose;
        # weight before, if it is measured
        self.open: list[tuple[str, bool, bool, bool, int, int, bool, int | None, int]] = []
        self.held: dict[int, int] = {}
        self.total = self.number = 0
        self.count: dict[str, int] = {}
        self.deep = [0, 0, 0]
        self.parts: list[str] = []
        self.linked = 0

    def text(self, raw: str) -> None:
        if not self.deep[0]:
            self.parts.append(raw)
            if self.deep[2]:
                self.linked += len(raw)

    def end_line(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                weight = max(0, len(text) - self.linked)
                inside = self.deep[1] > 0
                if inside:  # a line of links only is still a line of the article
                    weight += self.surge + 1
                self.total += weight
                home, prose = (self.open[-1][4], self.open[-1][6]) if self.open else (0, False)
                self.lines.append((text, weight, inside, home, prose))
            self.parts, self.linked = [], 0

    def gap(self) -> None:
        """What stands beside the text separates passages as an empty line does."""
        self.lines.append(("", 0, False, -1, False))

    def start(self, tag: str, attributes: str, closed: bool) -> None:
        if tag in _BLOCKS:
            self.end_line()
            if self.open and self.open[-1][0] == "p":
                self.pop()
            if tag in ("li", "dt", "dd", "option", "tr", "td", "th"):
                if self.open and self.open[-1][0] == tag:
                    self.pop()
        elif tag == "br":
            self.text(" ")
        if closed or tag in _VOID:
            return
        self.number += 1
        beside, named = _beside(tag, attributes, self.deep[1] > 0)
        measured = named and self.spared is None
        if named and self.spared is not None and self.number not in self.spared:
            beside = True
        if beside and not self.deep[0]:
            self.gap()
        article = tag in ("article", "main") and not beside and not self.deep[0]
        if article:
            self.gap()
        home, box, prose = self.open[-1][4:7] if self.open else (0, 0, False)
        if tag in _TEXTUAL:
            home, prose = box, tag in _PROSE
        elif tag in _BLOCKS and tag not in ("html", "body"):
            # Text right in a block is a block of the container around it.
            home = box if box and not article else self.number
            box, prose = self.number, False
        state = (
            tag, beside, article, tag == "a", home, box, prose,
            self.total if measured else None, self.number,
        )
        self.open.append(state)
        self.count[tag] = self.count.get(tag, 0) + 1
        for i in range(3):
            self.deep[i] += state[i + 1]

    def pop(self) -> str:
        tag, *state = self.open.pop()
        self.count[tag] -= 1
        for i in range(3):
            self.deep[i] -= state[i]
        if state[1]:
            self.gap()
        if state[6] is not None:
            self.held[state[7]] = self.total - state[6]
        return tag

    def end(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.end_line()
        if self.count.get(tag):
            while True:
                if self.open[-1][0] in _BLOCKS:
                    self.end_line()
                if self.pop() == tag:
                    break


def _read(page: str, surge: int, spared: frozenset[int] | None) -> _Lines:
    out, at = _Lines(surge, spared), 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            out.text(page[at : m.start()])
        at = m.end()
        if m[3]:
            tag = m[3].lower()
            if m[2]:
                out.end(tag)
            else:
                out.start(tag, m[4], bool(m[5]))
    out.text(page[at:])
    out.end_line()
    while out.open:
        out.pop()
    return out


def page_lines(page: str, surge: int = SURGE) -> list[tuple[str, int, bool, int, bool]]:
    """The page's lines."""
    out = _read(page, surge, None)
    if not out.held:
        return out.lines
    most = (k for k, w in out.held.items() if w >= surge and 2 * w > out.total)
    return _read(page, surge, frozenset(most)).lines


def passages(weights: list[int], surge: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Ranges of lines from a surge point to the dive after it."""
    sums, total = [], sum(weights[: window - 1])
    for i in range(len(weights)):
        total += weights[i + window - 1] if i + window - 1 < len(weights) else 0
        sums.append(total)
        total -= weights[i]
    found, i = [], 0
    while i < len(sums):
        if sums[i] <= surge:
            i += 1
            continue
        ahead = weights[i : i + window]
        # What an empty line parts from the surge is not of the passage.
        peak = i if weights[i] > surge else i + ahead.index(max(ahead))
        start = max((k + 1 for k in range(i, peak) if not weights[k]), default=i)
        i = peak
        while i < len(sums) and (weights[i] or sums[i] > surge):
            i += 1
        found.append((start, i))
    return found


def main_text(page: str | None, surge: int = SURGE, window: int = WINDOW) -> str:
    if not page:
        return ""
    lines = page_lines(page, surge)
    weights = [line[1] for line in lines]
    heaviest = max((sum(weights[i : i + window]) for i in range(len(weights))), default=0)
    kept = set()
    for a, b in passages(weights, min(surge, heaviest - 1), window) if heaviest else ():
        kept.update(i for i in range(a, b) if weights[i])
    first: dict[int, int] = {}
    last: dict[int, int] = {}
    for i in sorted(kept):
        first.setdefault(lines[i][3], i)
        last[lines[i][3]] = i
    for i, (text, weight, _, home, prose) in enumerate(lines):
        if text and home in first and (weight or prose or first[home] < i < last[home]):
            kept.add(i)
    return "\n".join(lines[i][0] for i in sorted(kept))


@arrow_udf(T.StringType())
def _main_text(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(p.as_py()) for p in pages], pa.string())


def with_main_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each page, blocks apart by one line feed."""
    if out in pages.columns:
        raise ValueError(f"column {out} exists")
    return pages.withColumn(out, _main_text(pages[html]))
