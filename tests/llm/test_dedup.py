"""Substring dedup, Jaccard join and line dedup against brute force."""

import collections

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagelake.llm import jaccard, linededup, substring
from pagelake.llm.fmindex import FMIndex, WaveletMatrix
from pagelake.llm.graph import components
from tests.llm.conftest import SPACED, lower


def windows_removed(rows, n):
    first, out = {}, {}
    for d, t in sorted(rows):
        w, gone = SPACED.findall(t or ""), set()
        for i in range(len(w) - n + 1):
            if first.setdefault(tuple(w[i : i + n]), d) < d:
                gone.update(range(i, i + n))
        out[d] = len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)
    return out


@pytest.mark.parametrize("window,hot", [(50, 1 / 2000), (50, 1e9), (50, 0), (12, 0)])
def test_substring(docs, rows, window, hot):
    got = substring.remove_repeats(docs, window=window, hot=hot).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == windows_removed(rows, window)


def test_substring_odd_rows(spark, empty):
    long = " ".join(f"v{i}" for i in range(80))
    table = spark.createDataFrame(
        [(None, long, 1), (5, long, 2), (5, long, 3), (5, "other " + long, 4), (7, long, 5)],
        "doc_id long, text string, h int",
    )
    got = sorted(
        (r.doc_id or -1, r.n_removed) for r in substring.remove_repeats(table).collect()
    )
    assert got == [(-1, 0), (5, 0), (5, 0), (5, 0), (7, 80)]
    assert substring.remove_repeats(empty).collect() == []


def test_wavelet_matrix_counts():
    x = np.random.default_rng(1).integers(0, 37, 1000)
    w = WaveletMatrix(x, 37)
    at, c = np.arange(1001), np.arange(1001) % 37
    assert (w.rank(c, at) == [(x[:i] == k).sum() for i, k in zip(at, c)]).all()


def test_index_finds_smallest_owner():
    rng = np.random.default_rng(2)
    pieces = [rng.integers(1, 3, 30) for _ in range(20)]
    text = np.concatenate([np.append(p, 0) for p in pieces])
    owner = np.repeat(np.arange(20)[::-1], 31)
    end = np.arange(20) * 31 + 30
    index = FMIndex(text, owner, 6)
    seen = 0
    for who, place, first in index.first_owner(text, end - 30, end):
        for p, f in zip(place, first):
            same = [i for i in range(len(text) - 5) if (text[i : i + 6] == text[p : p + 6]).all()]
            assert f == min(owner[i] for i in same)
            seen += 1
    assert seen == 20 * 25


def sets_of(rows):
    out = {}
    for d, t in rows:
        w = SPACED.findall(lower(t))
        grams = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        out[d] = grams if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def linked_groups(sets):
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def test_jaccard(docs, rows):
    got = jaccard.near_duplicates(docs.withColumn("s", F.lit(1)).withColumn("g", F.lit(2)))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == linked_groups(sets_of(rows))


def test_jaccard_at_the_limit(spark):
    """Pairs just over and just under three quarters, of every size from 3 up."""
    rows, d = [], 0
    for n in (7, 8, 9, 12, 20, 45, 90, 200):
        base = [f"b{n}_{i}" for i in range(n)]
        for cut in range(0, n // 2, max(1, n // 20)):
            rows.append((d, " ".join(base[cut:])))
            d += 1
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == linked_groups(sets_of(rows))


def test_every_near_pair_shares_a_signature():
    rng = np.random.default_rng(3)
    for n in (3, 4, 5, 8, 13, 30, 77, 300):
        for _ in range(20):
            x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            drop = len(x) // 4  # |y| = 3/4 |x|, all of it in x
            y = np.sort(rng.choice(x, len(x) - drop, replace=False))
            rows = np.repeat([0, 1], [len(x), len(y)])
            row, sig = jaccard.signatures(
                rows, np.concatenate([x, y]), np.array([len(x), len(y)])
            )
            if drop:
                assert set(sig[row == 0]) & set(sig[row == 1])


def test_a_pair_is_given_out_by_one_of_its_groups():
    """Fifty groups with the same four sets, of which each pair may be linked."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    vectors = [jaccard.parities(base, np.array([60]))[0]] * 4
    groups = rng.permutation(1000)[:50]
    rows = [(g, s, s, 60, vectors[s], sorted(groups.tolist())[:16]) for g in sorted(groups.tolist()) for s in range(4)]
    # A fifth set is in one late group only.
    rows += [(int(max(groups)), 9, 9, 60, vectors[0], [int(max(groups))])]
    rows.sort(key=lambda r: r[:2])
    names = ["g", "s", "label", "n", "v", "least"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    out = [
        (r["a"], r["b"])
        for g in groups.tolist()  # each group in a task of its own
        for part in [batch.filter(pa.compute.equal(batch["g"], g))]
        for b in jaccard._across(True)(iter([part]))
        for r in b.to_pylist()
    ]
    assert sorted(out) == [(a, b) for a in range(4) for b in (*range(a + 1, 4), 9)]


def test_jaccard_odd_rows(spark, empty):
    table = spark.createDataFrame(
        [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A b c d e f"),
         (2, None), (3, "")],
        "doc_id long, text string",
    )
    got = sorted(tuple(r) for r in jaccard.near_duplicates(table).collect())
    assert got == [(2, 0, 2), (3, 0, 3), (4, 2, 4), (4, 2, 4), (9, 2, 4)]
    assert jaccard.near_duplicates(empty).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()
    assert {r.node: r.label for r in got} == {
        **dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)
    }


def lines_removed(rows, m):
    first, out = {}, {}
    for d, t in sorted(rows):
        lines = [x.strip(" ") for x in (t or "").split("\n") if x.strip(" ")]
        gone = set()
        for i in range(len(lines) - m + 1):
            key = tuple(lines[i : i + m])
            if key in first:
                gone.update(range(i, i + m))
            first.setdefault(key, (d, i))
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out[d] = len(lines), len(gone), kept if gone else t
    return out


@pytest.mark.parametrize("m", [1, 2, 3])
def test_line_dedup(docs, rows, m):
    got = linededup.dedup_lines(docs.select("doc_id", "text"), min_lines=m).collect()
    assert {r.doc_id: (r.n_lines, r.n_deleted, r.text) for r in got} == lines_removed(rows, m)


def test_line_dedup_takes_long_single_lines(spark):
    """One line of fifty words is a run, one of forty-nine is not."""
    long, short = (" ".join(f"{x}{i}" for i in range(n)) for x, n in (("l", 50), ("s", 49)))
    table = spark.createDataFrame(
        [(1, f"a\n{long}\n{short}\nb"), (2, f"c\n {long}\nd\n{short}\ne"), (3, long)],
        "doc_id long, text string",
    )
    got = linededup.dedup_lines(table, long_words=50).orderBy("doc_id").collect()
    assert [r.n_deleted for r in got] == [0, 1, 1]
    assert [r.text for r in got[1:]] == [f"c\nd\n{short}\ne", ""]
    # In the pipeline a document that is a copy as a whole goes.
    after = corpus_pipeline.dedup_lines(spark, table, "").orderBy("doc_id").collect()
    assert [r.text for r in after] == [r.text for r in got if r.text]


def test_line_dedup_of_long_copies(spark):
    """Two copies of one long document: its blocks overlap at every line."""
    text = "\n".join(f"line {i}" for i in range(30_000))
    table = spark.createDataFrame([(1, text), (2, "own\n" + text + "\nend")], "doc_id long, text string")
    got = linededup.dedup_lines(table).orderBy("doc_id").collect()
    assert [r.n_deleted for r in got] == [0, 30_000]
    assert got[0].text == text and got[1].text == "own\nend"


def test_merged_runs(spark):
    blocks = [(1, 0, 0, 2), (1, 0, 1, 4), (1, 0, 5, 1), (1, 0, 9, 2), (2, 0, 3, 1), (2, 0, 4, 0)]
    table = spark.createDataFrame(blocks, "doc long, t long, pos int, size int")
    got = sorted(tuple(r) for r in linededup.merged_runs(table).collect())
    assert got == [(1, 0, 0, 6), (1, 0, 9, 11), (2, 0, 3, 4)]


def test_line_dedup_odd_rows(spark, empty):
    t = "one two\nthree four\nfive"
    table = spark.createDataFrame(
        [(None, t, 1), (5, t, 2), (5, t, 3), (6, t, 4), (7, None, 5)],
        "doc_id long, text string, pos int",
    )
    got = sorted((r.doc_id or -1, r.text, r.pos) for r in linededup.dedup_lines(table).collect())
    assert got == [(-1, t, 1), (5, t, 2), (5, t, 3), (6, "", 4), (7, None, 5)]
    assert linededup.dedup_lines(empty).collect() == []
    with pytest.raises(ValueError):
        linededup.dedup_lines(table.withColumn("n_lines", F.lit(1)))


def test_line_dedup_runs_no_python(docs):
    plan = linededup.dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_repeated_blocks_reach_the_longest_run(spark):
    run = "\n".join(f"line {i}" for i in range(11))
    table = spark.createDataFrame([(1, run), (2, "x\n" + run)], "doc long, text string")
    table = table.select("doc", F.lit(0).cast("long").alias("t"), F.split("text", "\n").alias("lines"))
    size = {(r.doc, r.pos): r.size for r in linededup.repeated_blocks(table).collect()}
    assert size == {(2, i): s for i, s in zip(range(1, 11), [8, 8, 8, 8, 4, 4, 4, 4, 2, 2])}
    counts = collections.Counter(d for d, _ in size)
    assert counts == {2: 10}
