"""Quality, toxicity, rules, decontamination and licences."""

import collections
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagelake.llm import decontaminate, labels, licenses, quality, rules, toxicity
from tests.llm.conftest import PLAIN, SPACED, lower, prose

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def accuracy(spark, scored, truth, label, threshold):
    r = scored.join(truth, "doc_id").filter(labels.held_out("doc_id")).select("score", label)
    return np.mean([(x.score >= threshold) == (x[label] == 1) for x in r.collect()])


def test_held_out_is_the_stated_fold(spark):
    got = spark.range(200).select("id", labels.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_sample_is_bounded_and_outside_the_fold(spark, given):
    docs, truth = given
    rows = labels.labelled_sample(docs, truth, "quality", 20).collect()
    assert max(collections.Counter(r.label for r in rows).values()) <= 20
    fold = {r.text for r in docs.filter(labels.held_out("doc_id")).collect()}
    train = {r.text for r in docs.filter(~labels.held_out("doc_id")).collect()}
    assert not {r.text for r in rows} & (fold - train)


def test_quality_network(spark, docs, empty):
    texts, truth = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    net = quality.train(texts, truth, per_class=400)
    assert accuracy(spark, quality.with_score(texts, net), truth, "quality", 0.3) >= 0.93
    odd = quality.with_score(docs, net).select("text", "score").collect()
    assert all(0 <= r.score <= 1 for r in odd)
    assert len({r.score for r in odd if not r.text}) == 1
    assert quality.with_score(empty, net).collect() == []
    with pytest.raises(ValueError):
        quality.with_score(docs.withColumn("score", F.lit(1)), net)


def test_network_reads_to_the_last_byte():
    net = quality.ByteNetwork()
    a = "plain " * 3000
    one, two = net.scores(pa.array([a + "plain", a + "####!"]))
    assert one != two
    both = net.scores(pa.array([a, "x", None, "", a]))
    assert np.allclose(both, [net.scores(pa.array([t]))[0] for t in (a, "x", None, "", a)], atol=1e-6)


def test_toxicity(spark, given, docs, empty):
    texts, truth = given
    model = toxicity.train(texts, truth)
    assert accuracy(spark, toxicity.with_score(texts, model), truth, "toxic", 0.5) >= 0.93
    restorer = toxicity.Restorer(model.language)
    assert toxicity.restored_text("you looooser and 1d!", restorer).startswith("you loser and")
    odd = toxicity.with_score(docs, model).collect()
    assert all(0 <= r.score <= 1 for r in odd)
    assert toxicity.with_score(empty, model).collect() == []


def test_restoring_disguised_words():
    rng = random.Random(4)
    known = ["idiot", "moron", "loser", "stupid", "garden", "table", "window"]
    texts = [" ".join(rng.choice(known) for _ in range(200)) for _ in range(20)]
    counts = toxicity.trigram_counts(pa.array(texts))
    n = toxicity.KINDS
    table = counts.reshape(n, n, n) + 0.05
    restorer = toxicity.Restorer(np.log(table / table.sum(2, keepdims=True)))
    for given_, want in {
        "1d10t": "idiot", "m0r0n": "moron", "l o s e r": "loser", "s.t.u.p.i.d": "stupid",
        "looooser": "loser", "$tupid": "stupid", "garden table": "garden table",
        "cafe 12 30": "cafe 12 30", "": "", "é è": "é è",
    }.items():
        assert toxicity.restored_text(given_, restorer) == want


def test_copies_of_one_item_over_a_block(spark):
    """Repeated rows are one item before blocks are measured."""
    one = " ".join(f"i{k}" for k in range(20))
    rows = [("a", one)] * 30 + [("b", one)] + [(f"c{n}", f"c{n} {one}") for n in range(8)]
    items = spark.createDataFrame(rows, "item_id string, text string")
    blocks = list(decontaminate._blocks(items, "item_id", "text", 50))
    assert sorted(name for b in blocks for name, _ in b) == ["a", "b", *(f"c{n}" for n in range(8))]
    assert all(sum(len(words) for _, words in b) <= 50 for b in blocks)
    long = list(decontaminate._blocks(items, "item_id", "text", 15))
    assert [len(b) for b in long] == [1] * 10
    found = decontaminate.match_items(
        spark.createDataFrame([(1, f"x {one} y")], "doc_id long, text string"), items, block_words=50
    ).first()["match"]
    assert (found["starts"], found["ends"]) == ([1], [21])
    assert found["items"] == ["a", "b", *(f"c{n}" for n in range(8))]


def test_restoring_long_and_broken_spaced_texts():
    """A spaced text is one place however long, and ends where its line ends."""
    rng = random.Random(4)
    known = ["idiot", "moron", "loser", "stupid", "garden", "table", "window"]
    counts = toxicity.trigram_counts(pa.array([" ".join(rng.choices(known, k=4000))]))
    n = toxicity.KINDS
    table = counts.reshape(n, n, n) + 0.05
    restorer = toxicity.Restorer(np.log(table / table.sum(2, keepdims=True)))
    words = rng.choices(known, k=150)
    spaced = "   ".join(" ".join(w) for w in words)
    assert len(spaced) > 1200
    assert toxicity.restored_text(spaced, restorer).split() == words
    assert toxicity.restored_text("m o r o n\nI lose", restorer) == "moron\nI lose"
    assert toxicity.restored_text("m o r o n\r\ni d i o t", restorer) == "moron\r\nidiot"


def test_trigrams_of_parts_of_a_slice(monkeypatch):
    """Texts counted a few bytes at a time, with odd ones at the cuts, give the same."""
    rng = random.Random(13)
    odd = [None, "", "  ", "a b", "日本x", "1d10t !!"]
    texts = pa.array([rng.choice([*odd, prose(rng, 9)]) for _ in range(300)], pa.string())
    whole = toxicity.trigram_counts(texts)
    for size in (1, 7, 60):
        monkeypatch.setattr(toxicity, "COUNTED", size)
        assert (toxicity.trigram_counts(texts) == whole).all()


def test_counting_and_scoring_hold_little():
    """4 MB of text took more than 100 MB beside it, in each of an executor's workers."""
    rng = random.Random(14)
    texts = pa.array([prose(rng, 400) for _ in range(2500)])
    model = toxicity.ToxicityModel(np.zeros((toxicity.KINDS,) * 3), np.arange(9), np.ones(9), 0.0)
    restorer = toxicity.Restorer(model.language)
    for work in (toxicity.trigram_counts, lambda t: model.scores(t, restorer)):
        work(texts[:9])
        tracemalloc.start()
        work(texts)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 64 << 20


def test_trigrams_against_a_loop():
    texts = ["Ab c", None, "", "éa  b1", "zz"]
    want = collections.Counter()
    for t in texts:
        k = [0]
        for c in t or "":
            x = toxicity.kind_of(c)
            if x or k[-1]:
                k.append(x)
        k.append(0)
        for i in range(1, len(k) - 1):
            if k[i] or k[i + 1]:
                want[(0 if k[i] == 0 else k[i - 1], k[i], k[i + 1])] += 1
    got = toxicity.trigram_counts(pa.array(texts)).reshape((toxicity.KINDS,) * 3)
    letters = {k: v for k, v in want.items() if k[1]}
    assert {tuple(map(int, x)): int(got[tuple(x)]) for x in np.argwhere(got) if x[1]} == letters


def brute_statistics(t):
    t = t or ""
    w, seen, dup = SPACED.findall(t), set(), 0
    for line in t.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    grams = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = set()
    for i in range(len(w) - 2):
        if grams[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def test_rule_statistics(docs, rows, empty):
    got = {r.doc_id: tuple(r[c] for c in rules.COUNTS) for r in rules.with_statistics(docs).collect()
           } if "n_chars" not in docs.columns else {
        r.doc_id: tuple(r[c] for c in rules.COUNTS)
        for r in rules.with_statistics(docs.drop("n_chars")).collect()
    }
    assert got == {d: brute_statistics(t) for d, t in rows}
    assert rules.with_statistics(empty.drop("n_chars")).collect() == []


def test_learned_rules(spark, given):
    texts, truth = given
    found = rules.train(texts, truth)
    judged = rules.judge(texts.select("doc_id", "text"), found).join(truth, "doc_id").collect()
    open_ = [r for r in judged if not r.base_failed]
    assert found and np.mean([r.kept == (r.quality == 1) for r in open_]) >= 0.97
    plan = rules.judge(texts.select("text"), found)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rules_find_a_planted_threshold():
    rng = np.random.default_rng(1)
    x = {"a": rng.random(600), "b": rng.random(600)}
    bad = (x["a"] > 0.7) & (x["b"] <= 0.5)
    found = rules.learn(x, bad)
    assert found
    hit = np.zeros(600, bool)
    for rule in found:
        own = np.ones(600, bool)
        for c in rule:
            own &= (x[c.feature] > c.limit) == c.above
        hit |= own
    assert (hit == bad).mean() > 0.95
    assert rules.learn(x, np.zeros(600, bool)) == []


def brute_match(text, items, n=10):
    w, hit, ids = PLAIN.findall(lower(text)), set(), set()
    for name, item in items:
        v = PLAIN.findall(lower(item))
        size = min(n, len(v))
        for i in range(len(v) - size + 1 if size else 0):
            for j in range(len(w) - size + 1):
                if w[j : j + size] == v[i : i + size]:
                    hit.update(range(j, j + size))
                    ids.add(str(name))
    return len(w), sorted(hit), sorted(ids)


@pytest.mark.parametrize("block", [50_000, 30])
def test_decontamination(spark, docs, rows, empty, block):
    rng = random.Random(8)
    whole = [t for _, t in rows if t and len(t.split()) > 30]
    items = [(i, " ".join(t.split()[5:25])) for i, t in enumerate(whole[:4])]
    items += [(20, items[0][1]), (21, "ünï"), (22, None), (23, "!!"), (24, "a b c"), (25, "b c")]
    items += [(30 + i, prose(rng, 15, 3)) for i in range(3)]
    table = spark.createDataFrame(items, "item_id long, text string")
    more = [(1000 + i, prose(rng, 200, 3)) for i in range(3)]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(more, "a long, b string"))
    got = decontaminate.match_items(both, table, block_words=block).collect()
    texts = {**dict(rows), **dict(more)}
    for r in got:
        hit = [k for s, e in zip(r.match.starts, r.match.ends) for k in range(s, e)]
        want = brute_match(texts[r.doc_id], [x for x in items if x[1]])
        assert (r.match.n_words, hit, list(r.match["items"])) == want
    assert decontaminate.match_items(empty, table).collect() == []
    assert all(not r.match["items"] for r in decontaminate.match_items(both, table.limit(0)).collect())


def test_spans_are_cut_and_documents_dropped(spark):
    item = " ".join(f"q{i}" for i in range(12))
    rows = [(1, f"before {item} after " + "word " * 40), (2, item), (3, None), (4, "clean text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    cut = decontaminate.remove_spans(decontaminate.match_items(docs, items))
    got = {r.doc_id: r.text for r in cut.collect()}
    assert got == {1: "before  after " + "word " * 40, 3: None, 4: "clean text"}
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {3, 4}


def test_licences(spark, docs, empty):
    rows = [
        (1, "text\nReleased under the MIT License.\nmore"),
        (2, "LICENSED under the apache license version 2.0!"),
        (3, "All rights reserved."), (4, None), (5, ""), (6, "reserved"),
        (7, "This is released under the terms of something else entirely, not a license."),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {
        r.doc_id: [(x.line, x.licence) for x in r.notices]
        for r in licenses.with_notices(table).collect()
    }
    assert got == {
        1: [(1, "MIT")], 2: [(0, "Apache-2.0")], 3: [(0, "reserved")], 4: [], 5: [], 6: [], 7: [],
    }
    assert all(r.notices == [] for r in licenses.with_notices(docs).collect())
    assert licenses.with_notices(empty).collect() == []
