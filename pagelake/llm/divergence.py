"""How far the sources of a language are from one another, term by term, exactly.

Counts of a group (language and source) are kept as sorted (term id, count) arrays, cut
into blocks of a bounded number of term ids. For each unordered pair of groups the blocks
of both sides are co-grouped, and one merge prices the terms both have, those only one
side has and, by their number alone, those neither has. The price is symmetric, so one
merge serves both directions.

All words are counted within the tasks first, so what is shuffled is one row per group,
term and task. A block has about ``BLOCK`` terms whatever the vocabulary, so no task ever
holds a whole one; only the pairs asked for are formed, from the list of groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelake.llm.words import _class, slices, words_of
from pagelake.session import scratch_dir, written

LEAST_DOCS = 10  # documents of the language that a kept term is in
UNIT = 1_000_000_000
BLOCK = 1 << 14  # term ids of a block
HELD = 1_000_000  # counted rows that a task holds before it merges them
LETTERS = _class((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))  # [^\x00-\x40\x5B-\x60\x7B-\x7F]

_COUNTED = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
    ("n", pa.int64()), ("docs", pa.int64()),
])


def _slice_counts(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """Occurrences and documents of each term of some documents. A group's own row has
    the term '', which no word is, so groups without words are known as well.
    """
    words = words_of(text, LETTERS, lower=True)
    coded = words.texts().dictionary_encode()
    codes, n_terms = coded.indices.to_numpy(), max(1, len(coded.dictionary))
    # A document's terms, with how often it has each; then the groups' terms.
    pair, n = np.unique(words.doc.astype(np.int64) * n_terms + codes, return_counts=True)
    doc, term = pair // n_terms, pair % n_terms
    names = pa.StructArray.from_arrays([lang, source], ["lang", "source"])
    group_of, first = _numbered(names.to_pylist())
    pair, at = np.unique(group_of[doc] * n_terms + term, return_inverse=True)
    total = np.bincount(at, n, len(pair)).astype(np.int64)
    docs = np.bincount(at, minlength=len(pair))
    group = np.append(first[pair // n_terms], first)
    terms = pa.concat_arrays([
        coded.dictionary.cast(pa.string()).take(pa.array(pair % n_terms)),
        pa.array([""] * len(first), pa.string()),
    ])
    none = np.zeros(len(first), np.int64)
    columns = [
        lang.take(pa.array(group)), source.take(pa.array(group)), terms,
        pa.array(np.append(total, none)), pa.array(np.append(docs, none)),
    ]
    return pa.Table.from_arrays(columns, schema=_COUNTED)


def _numbered(names: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row's group, and the first row of each group."""
    seen: dict[tuple, int] = {}
    first = []
    out = np.empty(len(names), np.int64)
    for i, x in enumerate(names):
        key = x["lang"], x["source"]
        if key not in seen:
            seen[key] = len(first)
            first.append(i)
        out[i] = seen[key]
    return out, np.array(first, np.int64)


def _merged(tables: list[pa.Table]) -> pa.Table:
    both = pa.concat_tables(tables).group_by(["lang", "source", "term"])
    return both.aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(_COUNTED.names)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for i, j in slices(batch.column("text")):
            part = batch.slice(i, j - i)
            held.append(_slice_counts(*(part.column(c) for c in ("lang", "source", "text"))))
            size += len(held[-1])
            if size > HELD:
                held = [_merged(held)]
                size = len(held[0])
                if size > HELD // 2:  # little left to merge
                    yield from held[0].to_batches(1 << 16)
                    held, size = [], 0
    if held:
        yield from _merged(held).to_batches(1 << 16)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences of a group's terms, and the rows
    that have them; each group also has one row with term ''.
    """
    rows = docs.select(
        *(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(k) for c, k in ((lang, "lang"), (source, "source"), (text, "text")))
    )
    part = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _same(a: str, b: str, *names: str) -> Column:
    out = F.lit(True)
    for x in names:
        out = out & (F.col(f"{a}.{x}") == F.col(f"{b}.{x}"))
    return out


def share(count: str, total: str, size: str) -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 * size)), in integers."""
    return F.expr(
        f"1 + (cast({UNIT} as decimal(10,0)) * cast({count} + 2 as decimal(20,0)))"
        f" div cast({total} + 2 * {size} as decimal(20,0))"
    )


def price(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most UNIT + 1, so 64 bits suffice."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _shares(count: np.ndarray, total: int, size: int) -> np.ndarray:
    """``share`` of many counts, in integers of any size where 64 bits are too few."""
    if (int(count.max()) + 2) * UNIT >= 1 << 63:
        wide = [1 + UNIT * (int(c) + 2) // (total + 2 * size) for c in count]
        return np.array(wide, np.int64)
    return 1 + UNIT * (count + 2) // (total + 2 * size)


def _prices(p: np.ndarray, q: np.ndarray) -> int:
    gap = p - q
    return int((gap * gap // (p + q)).sum())


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the sorted ids of ``short`` stand in the sorted ids of ``long``, and which of
    them do. Each search starts at the place of the one before and halves from there.
    """
    at = np.searchsorted(long, short)
    inside = at < len(long)
    inside[inside] = long[at[inside]] == short[inside]
    return at, inside


def merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Summed price of the terms that either side has, and their number.

    A side is its sorted term ids, shares in the same order, with its share of an absent
    term as the last element of the shares.
    """
    if len(a[0]) > len(b[0]):
        a, b = b, a
    (x, p), (y, q) = a, b
    at, inside = gallop(x, y)
    alone = np.ones(len(y), bool)
    alone[at[inside]] = False
    value = _prices(p[:-1][inside], q[at[inside]])
    value += _prices(p[:-1][~inside], q[-1:]) + _prices(q[:-1][alone], p[-1:])
    return value, len(x) + int(alone.sum())


_PRICED = pa.schema([
    ("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64()), ("n", pa.int64()),
])


def _side(table: pa.Table) -> tuple[np.ndarray, np.ndarray, int, int] | None:
    if not len(table):
        return None
    ids, count = (table[c].combine_chunks()[0].values.to_numpy() for c in ("ids", "counts"))
    return ids, count, table["total"][0].as_py(), table["size"][0].as_py()


def _price_pair(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """One block of one pair: at most one row a side."""
    sides = [_side(left), _side(right)]
    known = next(s for s in sides if s is not None)
    # A side without terms in the block still has its total, sent along with the other.
    other = (left if len(left) else right)["other_total"][0].as_py()
    none = np.zeros(0, np.int64)
    ready = []
    for s in sides:
        ids, count, total, size = s or (none, none, other, known[3])
        ready.append((ids, _shares(np.append(count, 0), total, size)))
    value, n = merge(*ready)
    names = [k.as_py() if hasattr(k, "as_py") else k for k in key[:3]]
    return pa.Table.from_arrays([pa.array([x]) for x in (*names, value, n)], schema=_PRICED)


@dataclass
class Divergence:
    """``groups``: every group and its counts; ``entries``: kept terms that a group has;
    ``pairs``: the prices of group pairs.
    """

    groups: DataFrame
    entries: DataFrame
    pairs: DataFrame


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    block: int = BLOCK,
) -> Divergence:
    """Compare all groups (language and source) with each other, language by language.

    Null texts, languages and sources are ''. A term is a run of letters (all characters
    but ASCII ones that are no letters), A-Z lower-cased. A language keeps the terms in at
    least ``least_docs`` of its rows; repeated rows count each time. Other columns are
    ignored, an empty table gives empty results, a group without any kept term is priced
    like the others, and a language without kept terms has prices 0.

    ``groups``: lang, source, total (count over kept terms), size (kept terms of the
    language), lang_total. ``entries``: lang, source, term, n, lang_n and the group's
    columns. ``pairs``: lang, a < b, value (a bigint), one row per unordered pair.

    Counts, kept terms and blocks are written below the shared scratch folder.
    """
    spark = docs.sparkSession

    def kept_at(df: DataFrame, name: str) -> DataFrame:
        return written(df, scratch_dir(spark, f"divergence-{name}"))

    counts = kept_at(term_counts(docs, text, lang, source), "counts")
    by_term = counts.filter("term != ''").groupBy("lang", "term")
    kept = by_term.agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("d"))
    kept = kept_at(kept.filter(F.col("d") >= least_docs).drop("d"), "terms")
    # Written, so that Spark knows its size when it chooses how to join.
    size = kept.groupBy("lang").agg(F.count("*").alias("size"), F.sum("lang_n").alias("lang_total"))
    size = kept_at(size, "sizes")

    # A term's block is its hash, its id the place among the block's terms.
    held = kept.join(size, "lang").withColumn(
        "block", F.expr(f"cast(pmod(xxhash64(term), 1 + size div {int(block)}) as int)")
    )
    in_block = Window.partitionBy("lang", "block").orderBy("term")
    held = held.withColumn("id", F.row_number().over(in_block))
    entries = counts.drop("docs").join(held, ["lang", "term"])
    entries = kept_at(entries, "entries")

    seen = counts.filter("term = ''").select("lang", "source")
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = seen.join(totals, ["lang", "source"], "left").join(size, "lang", "left")
    groups = kept_at(groups.fillna(0, ["total", "size", "lang_total"]), "groups")

    # Blocks hold no more than the ids of a block, so a list never grows with the data.
    pair = F.struct(F.col("id").cast("bigint").alias("id"), "n")
    blocks = entries.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(pair)).alias("e"))
    blocks = kept_at(
        blocks.select("lang", "source", "block", F.col("e.id").alias("ids"), F.col("e.n").alias("counts")),
        "blocks",
    )
    one, two = groups.alias("x"), groups.alias("y")
    pairs = one.join(two, _same("x", "y", "lang") & F.expr("x.source < y.source")).select(
        "x.lang", F.col("x.source").alias("a"), F.col("y.source").alias("b"),
        F.col("x.total").alias("a_total"), F.col("y.total").alias("b_total"), "x.size",
    )
    pairs = kept_at(pairs, "pairs")

    def sides(own: str, other: str) -> DataFrame:
        held = pairs.alias("p").join(blocks.alias("k"), _same("p", "k", "lang") & F.expr(f"p.{own} = k.source"))
        names = ["lang", "a", "b", "block", "ids", "counts", "total", "other_total", "size"]
        return held.select(
            "p.lang", "p.a", "p.b", "k.block", "k.ids", "k.counts", f"p.{own}_total", f"p.{other}_total", "p.size"
        ).toDF(*names)  # new columns: both sides come from the same tables

    key = ["lang", "a", "b", "block"]
    priced = (
        sides("a", "b").groupBy(*key).cogroup(sides("b", "a").groupBy(*key))
        .applyInArrow(_price_pair, "lang string, a string, b string, value long, n long")
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    )
    # Terms that neither side has all cost the same.
    absent = pairs.join(priced, ["lang", "a", "b"], "left").fillna(0, ["value", "n"])
    absent = absent.filter("size > 0").withColumn("p", share("0", "a_total", "size"))
    absent = absent.withColumn("q", share("0", "b_total", "size"))
    full = absent.withColumn("value", F.col("value") + (F.col("size") - F.col("n")) * price("p", "q"))
    empty = pairs.filter("size = 0").withColumn("value", F.lit(0).cast("bigint"))
    columns = ["lang", "a", "b", "value"]
    return Divergence(groups, entries, full.select(columns).union(empty.select(columns)))


def ranked_sources(found: Divergence) -> DataFrame:
    """``(lang, source, item, value, rank)``: the other sources, the farthest first."""
    pairs = found.pairs
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return both.withColumn("rank", F.row_number().over(order))


def ranked_terms(found: Divergence, top: int = 10) -> DataFrame:
    """``(lang, source, item, value, rank)``: the ``top`` kept terms that a group has more
    of than its language, by price. The limit goes below the shuffle.
    """
    e = found.entries.join(found.groups.select("lang", "source", "total"), ["lang", "source"])
    e = e.withColumn("p", share("n", "total", "size")).withColumn("q", share("lang_n", "lang_total", "size"))
    over = e.filter("n > 0 AND p > q").select("lang", "source", F.col("term").alias("item"), price("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
