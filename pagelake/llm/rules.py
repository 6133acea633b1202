"""Quality rules as a learned decision list, on SQL expressions alone.

Statistics of a text are Spark expressions. From labelled statistics, sequential
covering learns conjunctions of thresholds for label 0: each is grown on two thirds of
the rows by information gain, pruned on the rest, and the rows it covers are taken
away before the next. The ordered list becomes one ``CASE WHEN``, so judging a corpus
is a scan without shuffle or Python. Only the learning of thresholds runs on the
driver, over at most ``2 * PER_CLASS`` rows of numbers outside the held-out fold.

Defined cases: null and empty texts have no words and fail the base rules; equal rows
get equal verdicts; other columns pass through, and a clash with a new column raises
``ValueError``; without labels of both kinds the list is empty and rejects nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.labels import labelled_sample

PER_CLASS = 4000  # rows of each label that rules are learnt from, at most
MOST_RULES, MOST_CONDITIONS, THRESHOLDS = 12, 4, 40
PRECISION = 0.8  # a rule must be right this often on the rows it was not grown on

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_capitals", "n_lines", "n_distinct", "n_chars")


def _without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, ""))


def _windows(words: Column) -> Column:
    """(hash, place) of each three-word window, ordered."""
    h = F.slice(
        F.transform(
            words, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2))
        ),
        F.lit(1),
        F.greatest(F.size(words) - 2, F.lit(0)),
    )
    return F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))


def _twice(placed: Column) -> Column:
    """Places of the windows that stand next to an equal one, ordered."""
    same = F.filter(
        placed,
        lambda x, i: (x["h"] == F.get(placed, i - 1)["h"]) | (x["h"] == F.get(placed, i + 1)["h"]),
    )
    return F.sort_array(F.transform(same, lambda x: x["i"]))


def _covered(at: Column) -> Column:
    """Words inside windows at these places."""
    new = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
    return F.aggregate(new, F.lit(0).cast("bigint"), lambda a, x: a + x)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of :data:`COUNTS` and what else the rules look at."""
    clash = {*COUNTS, *_MORE} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist")
    inner = [f"_{x}_" for x in ("body", "words", "lines", "placed", "twice")]
    while set(inner) & set(docs.columns):
        inner = [f"{x}_" for x in inner]
    body, words, lines, placed, twice = inner
    first = docs.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    split = first.withColumns({
        words: F.filter(F.split(body, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""),
        lines: F.filter(F.split(body, "\n"), lambda x: F.translate(x, SPACES, "") != ""),
    })
    # Columns of their own: what a lambda looks up by place must not be worked out anew.
    split = split.withColumn(placed, _windows(F.col(words)))
    split = split.withColumn(twice, _twice(F.col(placed)))
    size, all_chars = F.size(words), F.char_length(F.col(body))
    counted = split.withColumns({
        "n_words": size.cast("bigint"),
        "word_chars": _without(F.col(body), SPACES).cast("bigint"),
        "n_symbols": (all_chars - _without(F.col(body), SYMBOLS)).cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        "n_repeat_words": _covered(F.col(twice)),
        "n_capitals": (all_chars - _without(F.col(body), CAPITALS)).cast("bigint"),
        "n_lines": F.size(lines).cast("bigint"),
        "n_distinct": F.size(F.array_distinct(words)).cast("bigint"),
        "n_chars": all_chars.cast("bigint"),
    })
    return counted.drop(*inner)


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)


def features() -> dict[str, Column]:
    """Ratios that the learned conditions compare; 0 where there is nothing to divide."""

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {
        "word_length": share("word_chars", "n_words"),
        "symbols": share("n_symbols", "n_words"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
        "distinct": share("n_distinct", "n_words"),
        "words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def column(self) -> Column:
        f = features()[self.feature]
        return f > self.limit if self.above else f <= self.limit

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        x = rows[self.feature]
        return x > self.limit if self.above else x <= self.limit

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.limit:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, rows: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(rows)
    return out


def _grow(rows: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < MOST_CONDITIONS and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best, best_gain = None, 1e-9
        for name, values in rows.items():
            own = values[inside]
            cuts = np.unique(np.quantile(own, np.linspace(0, 1, THRESHOLDS + 2)[1:-1]))
            for limit in cuts.tolist():
                for above in (True, False):
                    hit = own > limit if above else own <= limit
                    p, n = (hit & bad[inside]).sum(), (hit & ~bad[inside]).sum()
                    if p:
                        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if gain > best_gain:
                            best, best_gain = Condition(name, above, limit), gain
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(rows)
    return rule


def _prune(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The beginning of the rule that does best on rows it was not grown on."""

    def worth(r: Rule) -> float:
        hit = _covers(r, rows, len(bad))
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)


def learn(rows: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Rules for the ``bad`` rows, in the order in which they are to be asked."""
    rules: list[Rule] = []
    held = np.arange(len(bad)) % 3 == 2
    while len(rules) < MOST_RULES and (bad & ~held).any() and (~bad).any():
        grow = {k: v[~held] for k, v in rows.items()}
        check = {k: v[held] for k, v in rows.items()}
        rule = _grow(grow, bad[~held])
        if not rule:
            break
        rule = _prune(rule, check, bad[held])
        hit = _covers(rule, check, int(held.sum()))
        if hit.sum() == 0 or bad[held][hit].mean() < PRECISION:
            break
        rules.append(rule)
        rest = ~_covers(rule, rows, len(bad))
        rows, bad, held = {k: v[rest] for k, v in rows.items()}, bad[rest], held[rest]
    return rules


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_class: int = PER_CLASS,
    id: str = "doc_id",
    text: str = "text",
) -> list[Rule]:
    """A decision list from at most ``2 * per_class`` labelled rows that pass the base
    rules, outside the held-out fold.
    """
    sample = with_statistics(labelled_sample(docs, labels, label, per_class, id, text))
    names = features()
    # Filtered here: Spark would push a filter below the columns that lambdas look up.
    found = sample.select(
        "label",
        F.xxhash64("text").alias("h"),
        base_failed().alias("failed"),
        *(c.alias(k) for k, c in names.items()),
    ).collect()
    rows = sorted((r for r in found if not r["failed"]), key=lambda r: r["h"])
    bad = np.array([r["label"] == 0 for r in rows], bool)
    return learn({k: np.array([r[k] for r in rows], float) for k in names}, bad)


def verdict(rules: list[Rule]) -> Column:
    """True where no rule of the list applies."""
    if not rules:
        return F.lit(True)
    out = F
    for rule in rules:
        applies = F.lit(True)
        for c in rule:
            applies = applies & c.column()
        out = out.when(applies, False)
    return out.otherwise(True)


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``docs`` with the statistics, ``base_failed`` and ``kept``."""
    if {"base_failed", "kept"} & set(docs.columns):
        raise ValueError("columns base_failed or kept exist")
    failed = with_statistics(docs, text).withColumn("base_failed", base_failed())
    return failed.withColumn("kept", ~F.col("base_failed") & verdict(rules))
