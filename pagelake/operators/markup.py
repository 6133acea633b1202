"""Read values off one page of lenient HTML.

This is the one place where a row is handled in Python: Spark's own ``xpath``
functions need well-formed XML, which captured pages are not. It knows only the
path steps the extraction needs: a tag, at any depth or as a direct child, with
attribute values and a position among its like siblings.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass
from html import unescape
from operator import attrgetter

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)"
    r"(?P<attrs>[^<>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^<>\"']*)*)>"
    r"|<[!?][^>]*>"
    r"|<[/!?]?(?:[a-z][^<>]*)?\Z",
    re.I | re.S,
)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")

_SELF_CLOSED = re.compile(r"""(?:^|[\s"'])/\Z""")

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# A start tag of the first group ends an open paragraph and all inside it.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav"
    " ol p pre section summary table ul".split()
)
# A start tag ends an open element of its kind, up to the nearest such container.
_ENDS_LIKE = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "a": ({"a"}, {"table", "td", "body"}),
}
_P_SCOPE = frozenset({"table", "td", "th", "button", "body"})


@dataclass(frozen=True)
class Step:
    """One path step; build it with :func:`anywhere` or :func:`child`."""

    tag: str
    attrs: tuple[tuple[str, str], ...]
    nth: int | None
    direct: bool


def _attrs(named: dict[str, str]) -> tuple[tuple[str, str], ...]:
    return tuple((k.rstrip("_"), v) for k, v in named.items())


def anywhere(tag: str, nth: int | None = None, **attrs: str) -> Step:
    """``tag`` at any depth below what was matched so far."""
    return Step(tag, _attrs(attrs), nth, direct=False)


def child(tag: str, nth: int | None = None, **attrs: str) -> Step:
    """``tag`` directly below what was matched so far."""
    return Step(tag, _attrs(attrs), nth, direct=True)


class Element:
    """An element with its direct texts; attributes are read when asked for.

    Elements are numbered in document order, so what lies below one is a range
    of numbers: ``order < n <= last``.
    """

    __slots__ = ("tag", "raw", "order", "last", "parent", "kids", "texts",
                 "open_text", "_attrs")

    def __init__(self, tag: str, raw: str, order: int, parent: Element | None):
        self.tag, self.raw, self.parent = tag, raw, parent
        self.order = self.last = order
        self.kids: list[Element] = []
        self.texts: list[str] = []
        self.open_text = False
        self._attrs: dict[str, str] | None = None

    @property
    def attrs(self) -> dict[str, str]:
        if self._attrs is None:
            self._attrs = {}
            for m in _ATTR.finditer(self.raw):
                value = next((g for g in m.groups()[1:] if g is not None), "")
                self._attrs.setdefault(m.group(1).lower(), unescape(value))
        return self._attrs

    def add_text(self, text: str) -> None:
        if "&" in text:
            text = unescape(text)
        # Text is one node until an element or a comment comes in between.
        if self.open_text:
            self.texts[-1] += text
        else:
            self.texts.append(text)
            self.open_text = True


class Page:
    """The elements of a page below an unnamed root, also listed by tag."""

    def __init__(self, html: str):
        self.root = Element("", "", 0, None)
        self.by_tag: dict[str, list[Element]] = defaultdict(list)
        self._read(html)

    def _read(self, html: str) -> None:
        open_, at, every, by_tag = _Open(self.root), 0, [], self.by_tag
        stack = open_.stack
        for m in _TOKEN.finditer(html):
            top = stack[-1]
            start, end = m.span()
            if start > at:
                top.add_text(html[at:start])
            at = end
            _, close, tag, attrs = m.groups()
            if tag is None:
                top.open_text = False
                continue
            tag = tag.lower()
            if close:
                open_.close((tag,), ())
                continue
            if tag in _ENDS_P:
                open_.close(("p",), _P_SCOPE)
            if tag in _ENDS_LIKE:
                open_.close(*_ENDS_LIKE[tag])
            top = stack[-1]
            node = Element(tag, attrs, len(every) + 1, top)
            every.append(node)
            by_tag[tag].append(node)
            top.kids.append(node)
            top.open_text = False
            # A final slash closes the tag, unless it ends an unquoted value.
            if tag in _VOID or (attrs.endswith("/") and _SELF_CLOSED.search(attrs)):
                continue
            open_.add(node)
        if at < len(html):
            stack[-1].add_text(html[at:])
        for node in reversed(every):
            if node.last > node.parent.last:
                node.parent.last = node.last

    def _below(self, node: Element, tag: str) -> list[Element]:
        tagged = self.by_tag.get(tag, [])
        if node is self.root:
            return tagged
        lo = bisect_right(tagged, node.order, key=_order)
        return tagged[lo : bisect_right(tagged, node.last, key=_order)]

    def select(self, path: tuple[Step, ...], start: list[Element] | None = None):
        """Elements at the end of ``path``, in document order, each once."""
        found = [self.root] if start is None else start
        for step in path:
            hits: dict[int, Element] = {}
            place = _Place(step)
            covered = -1
            for node in found:
                if not step.direct:
                    if node.order <= covered:  # it lies below an earlier one
                        continue
                    covered = node.last
                reach = node.kids if step.direct else self._below(node, step.tag)
                for element in reach:
                    if _fits(element, step) and place.is_nth(element):
                        hits[element.order] = element
            found = [hits[n] for n in sorted(hits)]
        return found


_order = attrgetter("order")


class _Open:
    """The open elements, and where in the stack those of each tag are."""

    def __init__(self, root: Element):
        self.stack = [root]
        self.at: dict[str, list[int]] = defaultdict(list)

    def add(self, node: Element) -> None:
        self.at[node.tag].append(len(self.stack))
        self.stack.append(node)

    def _nearest(self, tags) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def close(self, tags, scope) -> None:
        """Close the nearest open element with one of the tags, if the scope has it."""
        found = self._nearest(tags)
        if found and found >= self._nearest(scope):
            while len(self.stack) > found:
                self.at[self.stack.pop().tag].pop()


def _fits(element: Element, step: Step) -> bool:
    if element.tag != step.tag:
        return False
    return not step.attrs or all(element.attrs.get(k) == v for k, v in step.attrs)


class _Place:
    """Numbers the like siblings below a parent once, when first asked."""

    def __init__(self, step: Step):
        self.step, self.seen = step, {}

    def is_nth(self, element: Element) -> bool:
        if self.step.nth is None:
            return True
        parent = element.parent
        if parent.order not in self.seen:
            like = (k for k in parent.kids if _fits(k, self.step))
            self.seen[parent.order] = {k.order: i for i, k in enumerate(like, 1)}
        return self.seen[parent.order][element.order] == self.step.nth
