"""Toxicity by noisy-channel restoration of disguised words.

Writers hide words by look-alike signs (``1d10t``), by spacing (``m o r o n``) and by
repetition (``loooser``). A disguised place becomes a lattice of what each sign may
stand for, with the channel's cost on each arc; the Viterbi path under a character
trigram model of the whole corpus is the restored text. A logistic model over words
and word beginnings then scores the text with its restored places.

The character model counts every document. The score model is fitted on a bounded
sample (``PER_CLASS`` rows of each label at most) outside the held-out fold.

Defined cases: null and empty texts have no words and get the score of the bias
alone; repeated documents get equal scores; other columns pass through, and a clash
with ``out`` raises ``ValueError``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pagelake.llm.labels import labelled_sample
from pagelake.llm.words import Words, bytes_of, lists, mix, slices, words_of

PER_CLASS = 3000  # rows of each label that the score is fitted on, at most
FEATURES = 1500  # words and word beginnings that can have a weight, at most
LEAST = 4  # toxic rows that a feature must occur in
BEGINNINGS = (4, 5, 6)  # bytes of a word that are features of their own
COUNTED = 1 << 20  # bytes of text whose signs are counted, or that are scored, at once
KINDS = 28  # model signs: 0 no letter, 1-26 a-z, 27 any other letter

# Signs that stand for letters.
LOOKALIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
BETWEEN = " .-_*~"
# Costs in nats. Dropping a sign saves the model's cost of a letter, so it costs more.
LOOKALIKE_COST, SIGN_COST, REPEAT_COST, BETWEEN_COST = 0.7, 8.0, 2.0, 0.2

_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOKALIKE]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_INNER = np.zeros(256, bool)
_INNER[[ord(c) for c in BETWEEN[1:]]] = True


def kind_of(char: str) -> int:
    low = char.lower()
    if len(low) == 1 and "a" <= low <= "z":
        return ord(low) - 96
    return 27 if char.isalpha() else 0


# By code point up to U+024F; beyond, every sign counts as another letter.
_KIND = np.array([kind_of(chr(i)) for i in range(0x250)], np.int32)


def _kinds(texts: pa.Array) -> np.ndarray:
    """Model signs of all texts in a row, with a gap around each text."""
    data, bounds = bytes_of(texts)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((data & 0xC0) != 0x80)  # code point number to byte
    k = np.where(points < 0x250, _KIND[np.minimum(points, 0x24F)], 27)
    # A gap before each text: the code points there are moved by one place each.
    starts = np.searchsorted(lead, bounds[:-1])
    k = np.append(np.insert(k, starts, 0), 0)
    return k[np.append(True, (k[1:] != 0) | (k[:-1] != 0))]


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """Counts of three signs in a row, texts kept apart, runs of no letter as one."""
    total = np.zeros(KINDS**3, np.int64)
    for i, j in slices(texts):
        own, begun = texts[i:j], False
        for a, b in slices(own, COUNTED):
            k = _kinds(own[a:b])
            if begun:  # the gap before the first of these texts counts, as any between two
                k = np.insert(k, 0, 1)
            begun |= bool(k.any())
            # At a word's start the sign before the gap does not count.
            before = np.where(k[1:-1] == 0, 0, k[:-2])
            code = (before * KINDS + k[1:-1]) * KINDS + k[2:]
            total += np.bincount(code, minlength=KINDS**3)
    return total


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log probability of a sign after two others, from all documents."""

    def count(batches):
        total = np.zeros(KINDS**3, np.int64)
        for batch in batches:
            total += trigram_counts(batch.column(0))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["code", "n"])

    rows = docs.select(text).mapInArrow(count, "code bigint, n bigint")
    sums = rows.groupBy("code").agg(F.sum("n").alias("n")).toArrow()  # KINDS**3 rows at most
    table = np.full(KINDS**3, 0.05)
    table[sums["code"].to_numpy()] += sums["n"].to_numpy()
    table = table.reshape(KINDS, KINDS, KINDS)
    return np.log(table / table.sum(2, keepdims=True))


def _arcs(region: str) -> list[list[tuple[str, int | None, float]]]:
    """For each sign: what it may stand for, that as a model sign (None: nothing is
    written) and the channel's cost.
    """
    signs = re.split("[%s]+" % re.escape(BETWEEN), region)
    spaced = len(signs) > 2 and all(len(x) == 1 and not x.isspace() for x in signs)
    out, before = [], ""
    for c in region.lower():
        k = kind_of(c)
        if k:
            arcs = [(c, k, 0.0)]
            if c == before:
                arcs.append(("", None, REPEAT_COST))
        elif c in LOOKALIKE:
            arcs = [(x, kind_of(x), LOOKALIKE_COST) for x in LOOKALIKE[c]]
            arcs.append((c, 0, SIGN_COST))
            if c == before and c != "!":
                arcs.append(("", None, REPEAT_COST))
        else:
            arcs = [(c, 0, 0.0)]
            if c in BETWEEN and (spaced or c != " "):
                arcs.append(("", None, BETWEEN_COST))
        out.append(arcs)
        before = c
    return out


def restore(region: str, model: np.ndarray) -> str:
    """The likeliest text behind a disguised place. States are the last two signs."""
    best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for arcs in [*_arcs(region), [("", 0, 0.0)]]:
        step: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, path) in best.items():
            for written, k, extra in arcs:
                if k is None:
                    state, total = (a, b), cost + extra
                elif k == 0 and b == 0:
                    state, total = (0, 0), cost + extra
                else:
                    state = (0, 0) if k == 0 else (b, k)
                    total = cost + extra - model[0 if b == 0 else a, b, k]
                if state not in step or total < step[state][0]:
                    step[state] = total, (path, written)
        best = step
    path, out = min(best.values(), key=lambda x: x[0])[1], []
    while path:
        path, written = path
        out.append(written)
    return "".join(reversed(out))


def disguised(words: Words) -> np.ndarray:
    """Ranges of words that may hide another: ``(first word, last word + 1)``.

    A word with a look-alike sign next to a letter after it, or one or two at its end;
    with three equal letters in a row; with two or more joining signs inside; or three
    or more words of one sign in a row, with nothing but spaces between them.
    """
    n = len(words.start)
    if not n:
        return np.zeros((0, 2), np.int64)
    data = words.data
    sign, letter = _SIGN[data], _LETTER[data]
    last = np.append(letter[1:], False)
    inside = np.zeros(len(data) + 1, np.int64)

    def holds(flag: np.ndarray, cut: int) -> np.ndarray:
        np.cumsum(flag, out=inside[1:])
        return inside[np.maximum(words.end - cut, words.start)] - inside[words.start]

    leet = holds(sign & last, 1) > 0
    size = words.end - words.start
    has_letter = holds(letter, 0) > 0
    tail = np.zeros(n, bool)
    for m in (1, 2):
        ok = size > m
        at = words.end[ok] - 1
        flag = letter[at - m] & sign[at]
        if m == 2:
            flag &= sign[at - 1]
        tail[ok] |= flag & (data[at] != 33)  # a final '!' is a mark
    same = np.append((data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & letter[2:], [False] * 2)
    triple = holds(same, 2) > 0
    joined = holds(_INNER[data] & last, 1) > 1
    hit = (leet | tail | triple | joined) & has_letter
    single = (size == 1) & (letter | sign)[words.start]
    edge = np.ones(n + 1, bool)
    edge[1:-1] = (single[1:] != single[:-1]) | (words.doc[1:] != words.doc[:-1])
    np.cumsum((data >= 9) & (data <= 13), out=inside[1:])  # line feeds and the like
    edge[1:-1] |= inside[words.start[1:]] > inside[words.end[:-1]]
    cuts = np.flatnonzero(edge)
    a, b = cuts[:-1], cuts[1:]
    runs = single[a] & (b - a >= 3)
    at = np.flatnonzero(hit & ~single)
    both = np.concatenate([np.stack([at, at + 1], 1), np.stack([a[runs], b[runs]], 1)])
    return both[np.argsort(both[:, 0], kind="stable")]


class Restorer:
    """Restores disguised places; equal places are worked out once."""

    def __init__(self, model: np.ndarray, cache: int = 200_000):
        self.model, self.cache, self.seen = model, cache, {}

    def __call__(self, region: str) -> str:
        out = self.seen.get(region)
        if out is None:
            if len(self.seen) >= self.cache:
                self.seen.clear()
            out = self.seen[region] = restore(region, self.model)
        return out


def restored_text(text: str, restorer: Restorer) -> str:
    """``text`` with its disguised places restored, all else as it is."""
    words = words_of(pa.array([text]))
    raw, parts, at = words.data.tobytes(), [], 0
    for a, b in disguised(words):
        s, e = int(words.start[a]), int(words.end[b - 1])
        parts += [raw[at:s], restorer(raw[s:e].decode()).encode()]
        at = e
    return b"".join([*parts, raw[at:]]).decode()


_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = True
_WORD[128:] = True


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each word and each of its beginnings."""
    rows, out = [words.doc], [words.hashes()]
    for i, k in enumerate(BEGINNINGS, 1):
        long = np.flatnonzero(words.end - words.start > k)
        cut = Words(
            words.n_docs, words.data, words.doc[long], words.start[long],
            words.start[long] + k, words.offsets,
        )
        rows.append(words.doc[long])
        out.append(mix(cut.hashes() + np.uint64(i)))
    return np.concatenate(rows), np.concatenate(out).astype(np.int64)


def features_of(texts: pa.Array, restorer: Restorer) -> tuple[np.ndarray, np.ndarray]:
    """Features of the texts and of what their disguised places restore to."""
    rows, out = _features(words_of(texts, _WORD, lower=True))
    words = words_of(texts)
    places = disguised(words)
    if len(places):
        raw = words.data.tobytes()
        spans = zip(words.start[places[:, 0]].tolist(), words.end[places[:, 1] - 1].tolist())
        plain = pa.array([restorer(raw[s:e].decode()) for s, e in spans])
        more, extra = _features(words_of(plain, _WORD, lower=True))
        rows = np.append(rows, words.doc[places[:, 0]][more])
        out = np.append(out, extra)
    return rows, out


def _unique(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[keep], values[keep]


@dataclass
class ToxicityModel:
    """``known``: sorted feature hashes, with a ``weight`` each."""

    language: np.ndarray
    known: np.ndarray
    weight: np.ndarray
    bias: float

    def hits(self, texts: pa.Array, restorer: Restorer) -> tuple[np.ndarray, np.ndarray]:
        """(row, index of a known feature), each pair once."""
        rows, out = features_of(texts, restorer)
        at = np.minimum(np.searchsorted(self.known, out), max(0, len(self.known) - 1))
        found = self.known[at] == out if len(self.known) else np.zeros(len(out), bool)
        return _unique(rows[found], at[found])

    def scores(self, texts: pa.Array, restorer: Restorer) -> np.ndarray:
        z = np.full(len(texts), self.bias)
        for i, j in slices(texts, COUNTED):
            rows, at = self.hits(texts[i:j], restorer)
            z[i:j] += np.bincount(rows, self.weight[at], j - i)
        return 1 / (1 + np.exp(-z))


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic weights by full gradient steps (Adam); the bias is not shrunk."""
    n, k = x.shape
    w, m, s = (np.zeros(k + 1) for _ in range(3))
    for step in range(1, 501):
        p = 1 / (1 + np.exp(-(x @ w[:k].astype(np.float32) + np.float32(w[k]))))
        g = np.append(x.T @ (p - y) / n + ridge / n * w[:k], (p - y).mean())
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        rate = 0.1 * (1 - step / 501)
        w -= rate * m / (1 - 0.9**step) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return w[:k], float(w[k])


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    per_class: int = PER_CLASS,
    id: str = "doc_id",
    text: str = "text",
) -> ToxicityModel:
    """The character model of all documents and a score fitted on the sample."""
    language = character_model(docs, text)
    rows = labelled_sample(docs, labels, label, per_class, id, text)
    shared = docs.sparkSession.sparkContext.broadcast(language)

    def count(batches):
        restorer = Restorer(shared.value)
        for batch in batches:
            y = batch.column(0).to_numpy()
            for i, j in slices(batch.column(1), COUNTED):
                at, out = _unique(*features_of(batch.column(1)[i:j], restorer))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out), pa.array(y[i:j][at], pa.int32())], ["f", "y"]
                )

    counts = (
        rows.select("label", "text")
        .mapInArrow(count, "f bigint, y int")
        .groupBy("f")
        .agg(F.sum("y").alias("a"), F.count("*").alias("n"))
    )
    size = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    share = pos / max(1, pos + neg)
    gain = (F.col("a") - F.col("n") * share) / F.sqrt(F.col("n") * share + 1)
    best = (
        counts.filter((F.col("a") >= LEAST) & (gain > 0))
        .orderBy(gain.desc(), "f")
        .limit(FEATURES)
        .select("f")
        .toArrow()
    )
    model = ToxicityModel(language, np.sort(best["f"].to_numpy()), np.zeros(0), 0.0)
    if not pos or not neg:  # one label only: its share is all there is to know
        model.bias = 20.0 if pos else -20.0
        model.weight = np.zeros(len(model.known))
        return model
    held = docs.sparkSession.sparkContext.broadcast(model)

    def incidence(batches):
        restorer = Restorer(held.value.language)
        for batch in batches:
            for i, j in slices(batch.column(1), COUNTED):
                at, k = held.value.hits(batch.column(1)[i:j], restorer)
                counted = np.bincount(at, minlength=j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], lists(k, counted, pa.int64())], ["y", "k"]
                )

    table = rows.select("label", "text").mapInArrow(incidence, "y int, k array<bigint>").toArrow()
    y = table["y"].to_numpy().astype(np.float32)
    k = table["k"].combine_chunks()
    x = np.zeros((len(y), len(model.known)), np.float32)
    x[np.repeat(np.arange(len(y)), np.diff(k.offsets.to_numpy())), k.values.to_numpy()] = 1
    order = np.lexsort(x.T[:8]) if len(model.known) else np.arange(len(y))
    model.weight, model.bias = _fit(x[order], y[order])
    return model


def with_score(
    docs: DataFrame, model: ToxicityModel, out: str = "score", text: str = "text"
) -> DataFrame:
    """``docs`` with the probability of label 1."""
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES weights at most

    def score(parts):
        restorer = Restorer(shared.value.language)
        for texts in parts:
            yield pa.array(shared.value.scores(texts, restorer))

    return docs.withColumn(out, _iterated(score)(docs[text]))


def _iterated(fn):
    from collections.abc import Iterator

    fn.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(fn, T.DoubleType())
