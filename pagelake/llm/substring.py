"""Removes passages of words that an earlier document has as well.

Matching is done by FM-indexes, one per shard. So that each document meets only the
shards that can hold its passages, windows are dealt by content: the smallest hash
among a window's short word runs is its anchor, equal windows have equal anchors, and
a run of windows with one anchor is a piece of text that goes to the anchor's shard.
Only anchors that occur in two documents or more are followed, and equal pieces are
merged before they are sent. In the shard, the pieces are indexed and streamed:
backward search finds for every window the smallest document that has it.

An anchor in more places than a share ``HOT`` of the documents would fill its shard with pieces that have
little in common but the anchor. Their windows are counted first, by the hash of the
whole window, which spreads them evenly; windows of one document only are cut off, and
the rest, now mostly equal pieces, goes on as above. This changes no result.

Working tables lie below the shared scratch folder. Defined cases: null texts have no
words; a row with a null id takes no part and loses nothing; rows that share an id
are judged each, and never against one another; other columns are not looked at; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.fmindex import FMIndex
from pagelake.llm.jaccard import whole_groups
from pagelake.llm.words import Words, grams, lists, slices, words_of
from pagelake.session import scratch_dir, written

WINDOW = 50
ANCHOR = 8  # words of the runs whose hash anchors a window
HOT = 1 / 2000  # places of an anchor, by documents, from which on windows are counted first
BLOCK = 400_000  # words of one index, about; an anchor's pieces stay together


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    done, out = 1, x
    while done * 2 <= n:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[: len(x) - n + 1], out[n - done :]) if done < n else out


def _runs(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor of each run."""
    h = words.hashes()
    none = np.zeros(0, np.int64)
    if len(h) < window:
        return none, none, none
    anchor = _sliding_min(grams(h, min(ANCHOR, window)), window - min(ANCHOR, window) + 1)
    own = words.doc[: len(anchor)] == words.doc[window - 1 :]
    first = np.ones(len(anchor), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (words.doc[1 : len(anchor)] != words.doc[: len(anchor) - 1])
    first[1:] |= own[1:] != own[:-1]
    at = np.flatnonzero(first)
    size = np.diff(np.append(at, len(anchor)))
    keep = own[at]
    return at[keep], size[keep], anchor[at[keep]].view(np.int64)


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """``(h, doc, t, s, n)``: windows ``s`` to ``s + n - 1`` of the text have anchor ``h``."""

    def run(batches):
        for batch in batches:
            for i, j in slices(batch.column(2)):
                words = words_of(batch.column(2)[i:j])
                at, size, h = _runs(words, window)
                row = words.doc[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h),
                        batch.column(0)[i:j].take(pa.array(row)),
                        batch.column(1)[i:j].take(pa.array(row)),
                        pa.array((at - words.first()[row]).astype(np.int32)),
                        pa.array(size.astype(np.int32)),
                    ],
                    ["h", "doc", "t", "s", "n"],
                )

    return docs.mapInArrow(run, "h bigint, doc bigint, t bigint, s int, n int")


def _pieces(docs_with_runs: DataFrame, window: int) -> DataFrame:
    """The followed runs' text, and for hot anchors a hash of each window."""

    def run(batches):
        for batch in batches:
            for i, j in slices(batch.column("text")):
                part = batch.slice(i, j - i)
                words = words_of(part.column("text"))
                base = words.first()
                runs = part.column("runs")
                flat = runs.flatten()
                count = pc.list_value_length(runs).to_numpy()
                row = np.repeat(np.arange(j - i), count)
                h, s, n, hot = (flat.field(k) for k in ("h", "s", "n", "hot"))
                a = base[row] + s.to_numpy()
                size = n.to_numpy()
                is_hot = hot.to_numpy(zero_copy_only=False)
                windows = grams(words.hashes(), window).view(np.int64)
                w = [windows[x : x + m] if f else [] for x, m, f in zip(a, size, is_hot)]
                yield pa.RecordBatch.from_arrays(
                    [
                        h,
                        part.column("doc").take(pa.array(row)),
                        part.column("t").take(pa.array(row)),
                        s,
                        n,
                        _joined(words, a, a + size + window - 1),
                        pa.array(w, pa.list_(pa.int64())),
                    ],
                    ["h", "doc", "t", "s", "n", "piece", "w"],
                )

    schema = "h bigint, doc bigint, t bigint, s int, n int, piece string, w array<bigint>"
    return docs_with_runs.mapInArrow(run, schema)


def _joined(words: Words, a: np.ndarray, b: np.ndarray) -> pa.Array:
    """Words ``a`` to ``b - 1``, one space between two."""
    raw = words.data.tobytes()
    start, end = words.start.tolist(), words.end.tolist()
    return pa.array(
        [b" ".join([raw[start[k] : end[k]] for k in range(x, y)]).decode() for x, y in zip(a, b)],
        pa.string(),
    )


def _cut(pieces: DataFrame, window: int) -> DataFrame:
    """Pieces of hot anchors, cut to the windows that two documents or more have."""
    hot = pieces.filter(F.size("w") > 0)
    each = hot.select("h", "doc", "t", "s", F.posexplode("w").alias("k", "v"))
    live = (
        each.groupBy("h", "v")
        .agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
        .filter("lo < hi")
        .select("h", "v")
    )
    at = (
        each.join(live, ["h", "v"])
        .groupBy("h", "doc", "t", "s")
        .agg(F.array_sort(F.collect_set("k")).alias("ks"))
    )

    def run(batches):
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                words, ks = x["piece"].split(" "), x["ks"]
                breaks = [i for i in range(1, len(ks)) if ks[i] != ks[i - 1] + 1]
                for i, j in zip([0, *breaks], [*breaks, len(ks)]):
                    a, n = ks[i], j - i
                    text = " ".join(words[a : a + n + window - 1])
                    out.append((x["h"], x["doc"], x["t"], x["s"] + a, n, text))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                ["h", "doc", "t", "s", "n", "piece"],
            )

    schema = "h bigint, doc bigint, t bigint, s int, n int, piece string"
    return hot.select("h", "doc", "t", "s", "piece").join(
        at, ["h", "doc", "t", "s"]
    ).mapInArrow(run, schema)


def repeated_places(
    pieces: list[str] | pa.Array, owner: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """(piece, window in it) for each window that a smaller owner's piece has."""
    parts = pc.split_pattern(pa.array(pieces, pa.string()), " ")
    count = pc.list_value_length(parts).to_numpy()
    coded = pc.dictionary_encode(parts.flatten()).indices.to_numpy().astype(np.int64) + 1
    end = np.cumsum(count + 1) - 1
    start = end - count
    text = np.zeros(int(count.sum()) + len(count), np.int64)
    inside = np.ones(len(text), bool)
    inside[end] = False
    text[inside] = coded
    index = FMIndex(text, np.repeat(owner, count + 1), window)
    found = [
        (who[first < owner[who]], (place - start[who])[first < owner[who]])
        for who, place, first in index.first_owner(text, start, end)
    ]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _searched(unique: DataFrame, window: int) -> DataFrame:
    """For each piece, the windows that its first document is not the first to have."""

    def blocks(batches):
        held, size = [], 0
        for table in whole_groups(batches, "h"):
            words = int(pc.sum(pc.count_substring(table["piece"], " ")).as_py() or 0)
            if held and size + words > BLOCK:
                yield pa.concat_tables(held)
                held, size = [], 0
            held.append(table)
            size += words
        if held:
            yield pa.concat_tables(held)

    def run(batches):
        for table in blocks(batches):
            who, at = repeated_places(
                table["piece"].combine_chunks(), table["first"].to_numpy(), window
            )
            order = np.lexsort((at, who))
            count = np.bincount(who, minlength=len(table))
            yield pa.RecordBatch.from_arrays(
                [
                    *(table[c].combine_chunks() for c in ("h", "p", "first")),
                    lists(at[order], count, pa.int32()),
                ],
                ["h", "p", "first", "at"],
            )

    schema = "h bigint, p bigint, first bigint, at array<int>"
    return unique.repartition("h").sortWithinPartitions("h").mapInArrow(run, schema)


def _kept(marked: DataFrame, window: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for i, j in slices(batch.column(1)):
                words = words_of(batch.column(1)[i:j])
                base = words.first()
                runs = batch.column(2)[i:j]
                count = pc.fill_null(pc.list_value_length(runs), 0).to_numpy()
                row = np.repeat(np.arange(j - i), count)
                flat = runs.flatten()
                a = base[row] + flat.field("s").to_numpy()
                b = a + flat.field("n").to_numpy() + window - 1
                depth = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(depth, a, 1)
                np.add.at(depth, b, -1)
                gone = np.cumsum(depth)[:-1] > 0
                stay = Words(
                    words.n_docs, words.data, words.doc[~gone], words.start[~gone],
                    words.end[~gone], words.offsets,
                )
                left = stay.first()
                n = np.diff(base)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j],
                        pa.array(n),
                        pa.array(n - np.diff(left)),
                        _joined(stay, left[:-1], left[1:]),
                    ],
                    ["id", "n_words", "n_removed", "kept"],
                )

    return marked.mapInArrow(run, "id bigint, n_words bigint, n_removed bigint, kept string")


def _whole_or(at: Column, s: Column, n: Column, whole: Column) -> Column:
    """Window ranges of a run to be removed: all of it, or those at the places given."""
    each = F.transform(at, lambda k: F.struct((s + k).alias("s"), F.lit(1).alias("n")))
    return F.when(whole, F.array(F.struct(s.alias("s"), n.alias("n")))).otherwise(each)


def remove_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    hot: float = HOT,
) -> DataFrame:
    """``(id, n_words, n_removed, kept)`` of every row: each word is removed that lies
    in ``window`` words in a row which also start in a document with a smaller id.
    """
    spark = docs.sparkSession
    own = docs.select(
        F.col(id).cast("bigint").alias("doc"),
        F.xxhash64(text).alias("t"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    named = own.filter("doc IS NOT NULL")
    runs = written(_anchors(named, window), scratch_dir(spark, "runs"))
    many = hot * docs.count()
    followed = (
        runs.groupBy("h")
        .agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("c"))
        .filter("lo < hi")
        .select("h", (F.col("c") > many).alias("hot"))
    )
    by_doc = (
        runs.join(followed, "h")
        .groupBy("doc", "t")
        .agg(F.collect_set(F.struct("h", "s", "n", "hot")).alias("runs"))
    )
    cut_from = named.dropDuplicates(["doc", "t"]).join(by_doc, ["doc", "t"])
    named_piece = F.xxhash64("piece")
    first = written(
        _pieces(cut_from, window).withColumn("p", named_piece), scratch_dir(spark, "pieces")
    )
    cut = written(_cut(first, window).withColumn("p", named_piece), scratch_dir(spark, "cut"))
    pieces = first.filter(F.size("w") == 0).drop("w").union(cut)
    unique = pieces.groupBy("h", "p", "piece").agg(F.min("doc").alias("first"))
    answer = _searched(unique, window)
    later = F.col("doc") > F.col("first")
    spans = (
        pieces.select("h", "p", "doc", "t", "s", "n")
        .join(answer, ["h", "p"])
        .filter(later | (F.size("at") > 0))
        .groupBy("doc", "t")
        .agg(
            F.flatten(
                F.collect_list(_whole_or(F.col("at"), F.col("s"), F.col("n"), later))
            ).alias("gone")
        )
    )
    marked = own.join(spans, ["doc", "t"], "left").select("doc", "text", "gone")
    return _kept(marked, window).withColumnRenamed("id", id)
