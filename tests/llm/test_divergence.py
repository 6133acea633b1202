"""Source divergence against sums over all terms."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.llm import divergence
from tests.llm.conftest import lower

TERMS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def by_hand(rows, least):
    docs = [(l or "", s or "", Counter(TERMS.findall(lower(t)))) for _, t, l, s in rows]
    out = {}
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for _, _, c in own for t in c)
        kept = sorted(t for t in seen if seen[t] >= least)
        counts = {s: Counter() for _, s, _ in own}
        for _, s, c in own:
            counts[s].update({t: c[t] for t in kept if c[t]})
        whole = sum(counts.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        def price(p, q):
            return (p - q) ** 2 // (p + q)

        shares, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s, p in shares.items():
            pairs = [(-sum(price(p[t], r[t]) for t in kept), o) for o, r in shares.items() if o != s]
            terms = [(-price(p[t], q[t]), t) for t in kept if counts[s][t] and p[t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:10])):
                for rank, (value, item) in enumerate(found, 1):
                    out[lang, s, part, item] = -value, rank
    return out


def result(found):
    got = {}
    for part, rows in (("pair", divergence.ranked_sources(found)), ("term", divergence.ranked_terms(found))):
        for r in rows.collect():
            got[r.lang, r.source, part, r.item] = r.value, r["rank"]
    return got


def table(n, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"wörd{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["ÄB", "Cd"]
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None])
        lang = rng.choice(["x", "x", "y"])
        words = [vocabulary[min(121, int(rng.expovariate(0.03)))] for _ in range(rng.randrange(60))]
        rows.append((i, rng.choice([" ", "1", "-"]).join(words), lang, source))
    odd = [(None, None, "x", "silent"), (1, "", "z", "only"), (1, "123", None, None), (2, "rare", "z", "q"), (2, "x " * 30000, "x", "hot")]
    return rows + odd + rows[:20]


@pytest.mark.parametrize("block", [1 << 14, 7])
def test_audit(spark, block):
    rows = table(150)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    clash = docs.withColumn("a", F.lit(1)).withColumn("term", F.lit("t")).withColumn("size", F.lit(2))
    assert result(divergence.audit(clash, block=block)) == by_hand(rows, 10)


def test_empty(spark):
    found = divergence.audit(spark.createDataFrame([], SCHEMA))
    assert result(found) == {} and found.groups.collect() == []


def test_merge_and_large_counts():
    rng = np.random.default_rng(4)
    for _ in range(30):
        sides, full = [], []
        for total in (3 * 10**10, 900):
            ids = np.sort(rng.choice(60, rng.integers(0, 40), replace=False))
            count = rng.integers(1, 10**10 if total > 900 else 9, len(ids))
            dense = np.zeros(60, np.int64)
            dense[ids] = count
            full.append([1 + 10**9 * (int(c) + 2) // (total + 120) for c in dense])
            sides.append((ids, divergence._shares(np.append(count, 0), total, 60)))
        value, n = divergence.merge(*sides)
        either = set(sides[0][0]) | set(sides[1][0])
        assert n == len(either)
        assert value == sum((p - q) ** 2 // (p + q) for k, (p, q) in enumerate(zip(*full)) if k in either)


def test_task_merges_what_it_holds(monkeypatch, spark):
    monkeypatch.setattr(divergence, "HELD", 40)
    rows = [(l or "", s or "", t or "") for _, t, l, s in table(60)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["lang", "source", "text"])
    total = Counter()
    for b in divergence._count(iter([batch, batch.slice(3, 9)])):
        for r in b.to_pylist():
            total[r["lang"], r["source"], r["term"]] += r["n"]
    want = Counter()
    for l, s, t in rows + rows[3:12]:
        want.update((l, s, x) for x in TERMS.findall(lower(t)))
    assert +total == want
