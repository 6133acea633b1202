"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of the test items. Training words stream
through it: the state is the longest suffix read so far that occurs in an item, so
each word costs a constant number of steps whatever the number of items. A place is
hit when the matching length reaches the window, or a whole item shorter than that.

Items are taken in blocks of at most ``block_words`` words. Each block has an
automaton of its own, broadcast with that size bound, and every document passes all
of them; the union over the blocks is the result.

Defined cases: a null or empty text has no words; a null or wordless item matches
nothing; repeated items and equal items with other ids each report their own id;
repeated documents are judged each; other columns of ``docs`` pass through, and a
clash with ``out`` raises ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pagelake.llm.words import PLAIN, slices, words_of
from pagelake.session import scratch_dir, written

WINDOW = 10
BLOCK_WORDS = 50_000  # at most this many item words in one broadcast automaton
MATCH = "struct<n_words:bigint,starts:array<bigint>,ends:array<bigint>,items:array<string>>"


class SuffixAutomaton:
    """All runs of words of the given ``(id, words)`` items.

    ``end_at[state]``: ids of the items that contain the window ending there;
    ``short[state]``: (length, id) of whole short items ending there.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        coded = [
            (name, [self.ids.setdefault(w, len(self.ids)) for w in words])
            for name, words in items
            if words
        ]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        self._mark(coded)

    def _state(self, step: dict[int, int], link: int, size: int) -> int:
        self.next.append(step)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A state for exactly the strings that reach ``q`` over ``p``."""
        copy = self._state(dict(self.next[q]), self.link[q], self.size[p] + 1)
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # an earlier item went this way
            return q if self.size[q] == self.size[last] + 1 else self._split(last, c, q)
        new, p = self._state({}, 0, self.size[last] + 1), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, c, q)
        return new

    def _holding(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of a longest string of ``state``."""
        while self.size[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _mark(self, coded: list[tuple[str, list[int]]]) -> None:
        n, w = len(self.size), self.window
        self.end_at: list[set[str] | None] = [None] * n
        whole: list[list[tuple[int, str]]] = [[] for _ in range(n)]
        for name, codes in coded:
            state = 0
            for i, c in enumerate(codes, 1):
                state = self.next[state][c]
                if i >= w:
                    at = self._holding(state, w)
                    self.end_at[at] = (self.end_at[at] or set()) | {name}
            if len(codes) < w:
                whole[state].append((len(codes), name))
        self.shortest = min([w, *(len(c) for _, c in coded)]) if coded else 0
        self.window_of, self.short = [0] * n, [()] * n
        for state in sorted(range(1, n), key=self.size.__getitem__):
            up = self.link[state]
            self.short[state] = (*self.short[up], *whole[state])
            if self.size[state] >= w:
                self.window_of[state] = state if self.size[up] < w else self.window_of[up]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit ranges of ``words``, merged, and the ids of the items hit."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        state = size = 0
        step, link, length, ids = self.next, self.link, self.size, self.ids
        for i, word in enumerate(words, 1):
            c = ids.get(word, -1)
            while state and c not in step[state]:
                state = link[state]
                size = length[state]
            state = step[state].get(c, 0)
            size = size + 1 if state else 0
            if size >= self.window:
                at = self.window_of[state]
                found |= self.end_at[at] or set()
                _cover(spans, i - self.window, i)
            for m, name in self.short[state] if size else ():
                if m <= size:
                    found.add(name)
                    _cover(spans, i - m, i)
        return spans, found


def _cover(spans: list[tuple[int, int]], a: int, b: int) -> None:
    while spans and spans[-1][1] >= a:
        a = min(a, spans.pop()[0])
    spans.append((a, b))


def _known_runs(words, vocabulary: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Runs of at least ``least`` words of one row that all are item words."""
    h = words.hashes()
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    known = vocabulary[at] == h
    edge = np.ones(len(h) + 1, bool)
    edge[1:-1] = (known[1:] != known[:-1]) | (words.doc[1:] != words.doc[:-1])
    cuts = np.flatnonzero(edge)
    a, b = cuts[:-1], cuts[1:]
    keep = known[a] & (b - a >= least)
    return zip(a[keep].tolist(), b[keep].tolist())


def _matcher(shared):
    def match(texts: pa.Array) -> pa.Array:
        automaton, vocabulary = shared.value
        parts = [_match(texts[i:j], automaton, vocabulary) for i, j in slices(texts)]
        return pa.concat_arrays(parts) if parts else _match(texts, automaton, vocabulary)

    return match


def _match(texts: pa.Array, automaton: SuffixAutomaton, vocabulary: np.ndarray) -> pa.Array:
    words = words_of(texts, PLAIN, lower=True)
    first, raw = words.first(), words.data.tobytes()
    n = words.n_docs
    starts: list[list[int]] = [[] for _ in range(n)]
    ends: list[list[int]] = [[] for _ in range(n)]
    items: list[set[str]] = [set() for _ in range(n)]
    if automaton.shortest and len(words.start):
        for a, b in _known_runs(words, vocabulary, automaton.shortest):
            bounds = zip(words.start[a:b].tolist(), words.end[a:b].tolist())
            spans, found = automaton.scan([raw[s:e] for s, e in bounds])
            if found:
                row = int(words.doc[a])
                base = a - int(first[row])
                starts[row] += [base + s for s, _ in spans]
                ends[row] += [base + e for _, e in spans]
                items[row] |= found
    return pa.StructArray.from_arrays(
        [
            pa.array(np.diff(first), pa.int64()),
            pa.array(starts, pa.list_(pa.int64())),
            pa.array(ends, pa.list_(pa.int64())),
            pa.array([sorted(x) for x in items], pa.list_(pa.string())),
        ],
        ["n_words", "starts", "ends", "items"],
    )


def _blocks(items: DataFrame, item_id: str, text: str, block_words: int):
    """The items' words, a block at a time. Repeated rows are one item."""
    size = F.size(F.split("body", "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+"))  # words, or a few more
    own = (
        items.select(F.col(item_id).cast("string").alias("name"), F.col(text).alias("body"))
        .filter(F.col("name").isNotNull() & F.col("body").isNotNull())
        .distinct()
        .withColumn("n", size)
    )
    total = own.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // block_words))
    if parts > 1:
        own = written(own, scratch_dir(items.sparkSession, "items"))
    spot = F.pmod(F.xxhash64("name", "body"), F.lit(parts))
    held, words = [], 0
    for b in range(parts):
        for row in own.filter(spot == b).collect():
            # An item longer than a block is a block of its own.
            if held and words + row["n"] > block_words:
                yield _words_of_items(held)
                held, words = [], 0
            held.append(row)
            words += row["n"]
    if held:
        yield _words_of_items(held)


def _words_of_items(rows) -> list[tuple[str, list[bytes]]]:
    words = words_of(pa.array([r["body"] for r in rows], pa.string()), PLAIN, lower=True)
    at = words.first().tolist()
    texts = [w.encode() for w in words.texts().to_pylist()]
    return [(r["name"], texts[i:j]) for r, i, j in zip(rows, at, at[1:])]


def match_items(
    docs: DataFrame,
    items: DataFrame,
    out: str = "match",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with a struct ``out``: number of words, hit word ranges (``starts``
    with it, ``ends`` without; ordered and apart) and the ids of the items hit.
    """
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    spark = docs.sparkSession
    found: list[Column] = []
    for block in _blocks(items, item_id, item_text, block_words) or ():
        found.append(_one(spark, block, window)(F.col(text)))
    if not found:
        found.append(_one(spark, [], window)(F.col(text)))
    if len(found) == 1:
        return docs.withColumn(out, found[0])
    names = [f"{out}_{i}" for i in range(len(found))]
    rest = docs.columns
    wide = docs.select("*", *(c.alias(n) for c, n in zip(found, names)))
    return wide.select(*rest, _merge([F.col(n) for n in names]).alias(out))


def _one(spark, block, window):
    automaton = SuffixAutomaton(block, window)
    known = pa.array([w.decode() for w in automaton.ids])
    vocabulary = np.sort(words_of(known).hashes()) if len(known) else np.zeros(0, np.uint64)
    return arrow_udf(_matcher(spark.sparkContext.broadcast((automaton, vocabulary))), MATCH)


def _merge(parts: list[Column]) -> Column:
    """Union of the blocks' ranges and items."""
    ranges = F.array_sort(
        F.concat(*(F.arrays_zip(p["starts"].alias("s"), p["ends"].alias("e")) for p in parts))
    )
    flat = F.transform(ranges, lambda r: F.struct(r["s"].alias("s"), r["e"].alias("e")))
    empty = F.array().cast("array<struct<s:bigint,e:bigint>>")
    joined = F.aggregate(
        flat,
        empty,
        lambda acc, r: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["e"] >= r["s"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(
                    F.element_at(acc, -1)["s"].alias("s"),
                    F.greatest(F.element_at(acc, -1)["e"], r["e"]).alias("e"),
                )),
            ),
        ).otherwise(F.concat(acc, F.array(r))),
    )
    return F.struct(
        parts[0]["n_words"].alias("n_words"),
        joined["s"].alias("starts"),
        joined["e"].alias("ends"),
        F.array_sort(F.array_distinct(F.concat(*(p["items"] for p in parts)))).alias("items"),
    )


def n_hit(match: Column) -> Column:
    """Words inside the hit ranges."""
    return F.aggregate(
        F.zip_with(match["ends"], match["starts"], lambda e, s: e - s),
        F.lit(0).cast("bigint"),
        lambda a, x: a + x,
    )


@arrow_udf(T.StringType())
def _without(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    out = []
    for text, s, e in zip(texts.to_pylist(), starts.to_pylist(), ends.to_pylist()):
        if s:
            words = words_of(pa.array([text]), PLAIN)
            raw, parts, at = words.data.tobytes(), [], 0
            for a, b in zip(s, e):
                parts.append(raw[at : words.start[a]])
                at = int(words.end[b - 1])
            text = b"".join([*parts, raw[at:]]).decode()
        out.append(text)
    return pa.array(out, pa.string())


def remove_spans(
    docs: DataFrame,
    match: str = "match",
    text: str = "text",
    min_words: int = WINDOW,
    max_share: float = 0.5,
) -> DataFrame:
    """Cut hit ranges of at least ``min_words`` words out of the texts, and drop
    documents of which more than ``max_share`` of the words are hit.
    """
    m = F.col(match)
    long = F.filter(
        F.arrays_zip(m["starts"].alias("s"), m["ends"].alias("e")),
        lambda r: r["e"] - r["s"] >= min_words,
    )
    kept = docs.filter((n_hit(m) == 0) | (n_hit(m) <= F.lit(max_share) * m["n_words"]))
    return kept.withColumn(text, _without(F.col(text), long["s"], long["e"]))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that no item's window occurs in, unchanged."""
    name = "_match" + "_" * sum(len(c) for c in docs.columns)
    marked = match_items(docs, items, name, window=window)
    return marked.filter(F.size(marked[name]["items"]) == 0).drop(name)
