"""Edit fingerprints against the walk step by step."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.llm import editprints as ep
from tests.llm.conftest import prose, sha


def walked(text):
    """The digits of one text, with every step of every walk taken one by one."""
    kinds = ep._classes(np.array([ord(c) for c in text], np.int64)).tolist()
    level = int(ep.level_of(np.array([len(text)]))[0])
    codes = np.array([ord(c) for c in text], np.int64)
    places = []
    for w in range(ep.WALKS):
        wanted, place, seen = ep._steps(level)[w].tolist(), 0, {}
        for t in range(ep.SAMPLES << level):
            seen[t] = min(place, len(text))
            if place < len(text) and ep._BITS[kinds[place], t % ep.PERIOD, w]:
                place += 1
        places += [seen[t] for t in wanted]
    first = np.zeros(len(places), np.int64)
    return level, ep._digit_at(codes, first, first + len(text), np.array(places)).tolist()


def test_walks():
    rng = random.Random(1)
    texts = ["", "a", "ab", "日本語", prose(rng, 9), prose(rng, 40), prose(rng, 300), "x" * 500]
    level, digits = ep.digits_of(texts)
    assert [(int(l), d.tolist()) for l, d in zip(level, digits)] == [walked(t) for t in texts]


def test_long_texts_walk_the_same_way(monkeypatch):
    rng = random.Random(2)
    texts = [prose(rng, 900), prose(rng, 30)]
    usual = ep.digits_of(texts)
    monkeypatch.setattr(ep, "LONG", 10)
    alone = ep.digits_of(texts)
    assert (usual[0] == alone[0]).all() and (usual[1] == alone[1]).all()


def test_sampled_steps_are_nested():
    for level in range(12):
        low, high = ep._steps(level), ep._steps(level + 1)
        for w in range(ep.WALKS):
            assert (np.diff(low[w]) > 0).all() and low[w][-1] < ep.SAMPLES << level
            assert set(high[w][: ep.SAMPLES // 2]) <= set(low[w])


def test_few_edits_leave_prints_near():
    rng = random.Random(3)
    base = prose(rng, 400)
    at = len(base) // 2
    edits = [base, base[:at] + "new words " + base[at:], base[:at] + base[at + 12 :], "head " + base, prose(rng, 400)]
    level, digits = ep.digits_of([base] * 5 + edits)
    near = ep.agreement((level[:5], digits[:5]), (level[5:], digits[5:]))
    assert near[0] == 1 and (near[1:4] > 0.6).all() and near[4] < 0.2


def test_levels_meet():
    """Texts on both sides of a level's limit are compared on the higher level."""
    rng = random.Random(4)
    base = prose(rng, 400)
    limit = next(n for n in range(1000, 4000) if ep.level_of(np.array([n]))[0] < ep.level_of(np.array([n + 1]))[0])
    text = (base * 9)[: limit + 1]
    level, digits = ep.digits_of([text[:limit], text])
    assert level[0] + 1 == level[1]
    assert ep.agreement((level[:1], digits[:1]), (level[1:], digits[1:]))[0] > 0.9


def by_hand(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (i, t), (_, f) in zip(order, order[1:] + order[:1]):
        t, f = t or "", f or ""
        half = len(t) // 2
        out[i] = len(t), sha(t[: len(t) - half] + f[:half])
    return out


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_against_next(spark, rows, tasks):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit(1))
    docs = docs.withColumn("part", F.lit(2)).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        got = ep.against_next(docs).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == by_hand(rows)
    prints = {r.doc_id: r.fingerprint for r in got}
    texts = {i: t or "" for i, t in rows}
    for i, fp in prints.items():
        assert fp == ep.spelled(*ep.digits_of([texts[i]]))[0]
    order = sorted(texts, reverse=True)
    for i, j in zip(order, order[1:] + order[:1]):
        row = next(r for r in got if r.doc_id == i)
        half = len(texts[i]) // 2
        new = texts[i][: len(texts[i]) - half] + texts[j][:half]
        a, b, c = (ep.digits_of([x]) for x in (texts[i], new, texts[j]))
        assert row.edited_fingerprint == ep.spelled(*b)[0]
        assert row.near_edited == ep.agreement(a, b)[0] and row.near_next == ep.agreement(a, c)[0]


def test_odd_tables(spark, empty):
    assert ep.against_next(empty).collect() == []
    assert ep.near_copies(ep.with_fingerprint(empty), "doc_id").collect() == []
    one = spark.createDataFrame([(7, "some words")], "doc_id long, text string")
    (row,) = ep.against_next(one).collect()
    assert row.edited_sha256 == sha("some some ") and row.near_next == 1
    same = spark.createDataFrame([(5, "abc def")] * 60 + [(None, "x"), (None, None)], "doc_id long, text string")
    got = ep.against_next(same).collect()
    assert len(got) == 62 and sum(r.doc_id is None for r in got) == 2
    with pytest.raises(ValueError):
        ep.with_fingerprint(one.withColumn("fingerprint", F.lit(1)))


def test_near_copies(spark, docs, rows):
    got = ep.near_copies(ep.with_fingerprint(docs), "doc_id").collect()
    found = {r.doc_id: r.copy_of for r in got}
    first = {}
    for i, t in rows:
        first.setdefault(t or "", i)
    assert len(found) == len(rows)
    for i, t in rows:
        if i < 12:  # no prose of its own is a copy of another
            assert found[i] == i
        assert found[i] == found[first[t or ""]]
    near = [i for i, t in rows if "changed" in (t or "")]
    assert [found[i] for i in near] == [2, 3, 4, 5]


def test_a_band_of_many_unlike_rows_settles(spark):
    """Texts that share a band and little else are compared in rounds."""
    base = np.zeros((1, ep.DIGITS), np.uint8)
    shared = (np.arange(ep.DIGITS) < ep.SAMPLES) & (np.arange(ep.DIGITS) % 2 == 0)
    base[:, shared] = 3
    rng = np.random.default_rng(5)
    digits = np.repeat(base, 9, axis=0)
    digits[:, ~shared] = rng.integers(1, 16, (9, (~shared).sum()))
    digits[6:] = digits[2]
    digits[6:, 1] = 15 - digits[2, 1]
    digits[7:, 3] = 1 + digits[2, 3] % 15
    prints = ep.spelled(np.full(9, 5), digits)
    df = spark.createDataFrame(list(enumerate(prints)), "n long, fingerprint string")
    got = {r.n: r.copy_of for r in ep.near_copies(df, "n").collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 2, 7: 2, 8: 2}


def by_all_pairs(prints, least):
    level, digits = ep._read(prints)
    label = list(range(len(prints)))
    for i in range(len(prints)):
        one = np.full(len(prints), i)
        near = ep.agreement((level[one], digits[one]), (level, digits)) >= least
        for j in np.flatnonzero(near):
            low, high = sorted((label[i], label[j]))
            label = [low if x == high else x for x in label]
    return dict(enumerate(label))


def copies_of(spark, prints, least=ep.NEAR):
    df = spark.createDataFrame(list(enumerate(prints)), "n long, fingerprint string")
    return {r.n: r.copy_of for r in ep.near_copies(df, "n", least=least).collect()}


def test_no_run_of_samples_need_agree(spark):
    """Every fourth sample differs, from the first or the second one on."""
    rng = np.random.default_rng(6)
    digits = np.repeat(rng.integers(1, 16, (1, ep.DIGITS)).astype(np.uint8), 4, axis=0)
    for row, every, first in ((1, 4, 0), (2, 4, 1), (3, 3, 0)):
        digits[row, first::every] = 1 + digits[row, first::every] % 15
    prints = ep.spelled(np.full(4, 5), digits)
    assert copies_of(spark, prints) == by_all_pairs(prints, ep.NEAR) == {0: 0, 1: 0, 2: 0, 3: 3}


@pytest.mark.parametrize("least", [0.3, 0.75, 0.9, 1.0])
def test_near_copies_by_all_pairs(spark, least):
    """Chains of edits, on one level and across two, on and around the threshold."""
    rng = random.Random(7)
    texts = ["", "a", "ab", "abc", "x" * 40]
    for n in (3, 5, 9, 20, 60, 61, 130):
        text = prose(rng, n, 5000)
        for _ in range(12):
            words = text.split()
            words[rng.randrange(len(words))] = f"new{rng.randrange(99)}"
            texts += [text, " ".join(words[: rng.randrange(len(words)) + 1])]
            text = " ".join(words)
    prints = sorted({*ep.spelled(*ep.digits_of(texts))})
    want = by_all_pairs(prints, least)
    assert copies_of(spark, prints, least) == want
    assert least == 1 or len({*want.values()}) < len(want)


def test_pairs_alike_share_a_signature():
    """With samples beyond either text, and as many differences as may be."""
    rng = np.random.default_rng(8)
    pairs = []
    for _ in range(3000):
        ends = rng.integers(0, ep.SAMPLES + 1, ep.WALKS)
        others = np.clip(ends + rng.integers(-6, 7, ep.WALKS), 0, ep.SAMPLES)
        x = rng.integers(1, 16, (ep.WALKS, ep.SAMPLES))
        y = x.copy()
        for w in range(ep.WALKS):
            x[w, ends[w] :], y[w, others[w] :] = 0, 0
        x, y = x.reshape(-1), y.reshape(-1)
        inside = np.flatnonzero((x > 0) | (y > 0))
        spare = int(((x == y) & (x > 0)).sum() - np.ceil(ep.NEAR * len(inside)))
        if spare > 0:
            at = rng.choice(np.flatnonzero((x == y) & (x > 0)), spare, replace=False)
            y[at] = 1 + y[at] % 15
        pairs.append((x, y))
    x, y = (np.array(p, np.uint8) for p in zip(*pairs))
    level = np.full(len(x), 3)
    near = ep.agreement((level, x), (level, y)) >= ep.NEAR
    (r1, s1), (r2, s2) = (ep._signatures(d, level, ep.NEAR) for d in (x, y))
    shared = {r for r, _ in {*zip(r1.tolist(), s1.tolist())} & {*zip(r2.tolist(), s2.tolist())}}
    assert near.sum() > 1000 and {*np.flatnonzero(near)} <= shared


def test_unlike_prints_seldom_share_a_signature():
    """Pairs of prints without likeness grow with the square of the table."""
    rng = np.random.default_rng(11)
    n = 20_000
    digits = rng.integers(1, 16, (n, ep.WALKS, ep.SAMPLES)).astype(np.uint8)
    ends = rng.integers(28, 58, (n, 1, 1)) + rng.integers(-1, 2, (n, ep.WALKS, 1))
    digits[np.broadcast_to(np.arange(ep.SAMPLES) >= ends, digits.shape)] = 0
    _, sigs = ep._signatures(digits.reshape(n, -1), np.full(n, 5), ep.NEAR)
    shared = np.unique(sigs, return_counts=True)[1].astype(np.int64)
    assert (shared * (shared - 1) // 2).sum() < n // 4


def test_a_group_in_blocks(spark, monkeypatch):
    """A large component, some that only one member of it is like, and some unlike all."""
    monkeypatch.setattr(ep, "BLOCK", 4)
    monkeypatch.setattr(ep, "CENTRES", 2)
    rng = np.random.default_rng(9)
    base = rng.integers(1, 16, ep.DIGITS).astype(np.uint8)
    digits = []
    for edits in [30] * 20 + [90] * 20:
        row = base.copy()
        at = 8 + rng.choice(ep.DIGITS - 8, edits, replace=False)
        row[at] = 1 + (row[at] + rng.integers(0, 14, edits)) % 15
        digits.append(row)
        if edits == 90:
            other = row.copy()
            other[8:50] = base[8:50]
            digits.append(other)
    prints = ep.spelled(np.full(len(digits), 4), np.array(digits))
    assert copies_of(spark, prints) == by_all_pairs(prints, ep.NEAR)


def test_ids_that_repeat_over_texts(spark):
    rng = random.Random(10)
    a, b = prose(rng, 90, 5000), prose(rng, 90, 5000)
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ep.near_copies(ep.with_fingerprint(docs), "doc_id").collect()
    assert sorted((r.doc_id, r.copy_of) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 1)]
    with pytest.raises(ValueError):
        ep.near_copies(ep.with_fingerprint(docs), "doc_id", least=0)
