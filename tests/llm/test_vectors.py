"""Vector codes against rounds by plain loops."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(n, dims=32, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:  # a third of the rows are one vector
            v = [0.25] * dims
        else:
            v = [float(np.float32(rng.gauss(0, 0.2))) for _ in range(dims)]
        rows.append((i, v, rng.choice([None, 1, 2])))
    return rows


def by_hand(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows]
    size = len(kept[0][1]) // parts
    cut = {i: [v[m * size : (m + 1) * size] for m in range(parts)] for i, v, _ in kept}
    first = sorted(cut)[:entries]
    books = [[cut[i][m] for i in first] for m in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for m in range(parts):
            of = {}
            for i in cut:
                of.setdefault(nearest(cut[i][m], books[m])[1], []).append(cut[i][m])
            for k, xs in of.items():
                books[m][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out = {}
    for i, _, _ in kept:
        found = [nearest(cut[i][m], books[m]) for m in range(parts)]
        out[i] = "".join(f"{k:02x}" for _, k in found), sum(g for g, _ in found)
    text = ",".join(str(x) for book in books for e in book for x in e)
    return out, hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("n,dims", [(1, 16), (40, 32), (300, 64)])
def test_codes(spark, n, dims):
    rows = table(n, dims)
    found = vectors.compress(spark.createDataFrame(rows, SCHEMA).repartition(4))
    want, digest = by_hand(rows)
    got = found.rows.collect()
    assert {r.vec_id: (r.code, r.error) for r in got} == want
    assert found.digest() == digest
    sums = {}
    for r in got:
        sums[r.label] = sums.get(r.label, 0) + r.error
    for r in vectors.with_label_error(found.rows).collect():
        assert r.label_error == sums[r.label]


def test_odd_rows(spark):
    rows = table(70, 16)
    inf, nan = float("inf"), float("nan")
    odd = [
        (100, None, 1), (101, [inf] * 16, 1), (102, [nan] + [0.0] * 15, 1), (103, [None] * 16, 1),
        (104, [], 2), (105, [0.5] * 8, 2), (106, [1e30] + [0.0] * 15, 2), (107, [0.1] * 17, 2),
        (None, rows[1][1], None), (1, rows[1][1], 7),
    ]
    wide = spark.createDataFrame(rows + odd, SCHEMA).withColumn("v", F.lit(1)).withColumn("code", F.lit("x"))
    found = vectors.compress(wide)
    got = found.rows.collect()
    assert found.rows.columns == ["vec_id", "label", "code", "error"]
    assert len(got) == 70 + 6
    assert {r.vec_id for r in got if r.code is None} == {104, 105, 106, 107}
    same = {r.code for r in got if r.vec_id in (1, None)}
    assert len(same) == 1
    none = vectors.compress(spark.createDataFrame([], SCHEMA))
    assert none.rows.collect() == [] and none.rows.columns == got[0].__fields__
    assert vectors.with_label_error(none.rows).collect() == []


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        n = 1 << (dims * bits)
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(n, dims)
        turn = vectors.hilbert_index(grid, bits)
        assert sorted(turn) == list(range(n))
        path = grid[np.argsort(turn)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(1)
    points, book = rng.integers(-90, 90, (4000, 4)), rng.integers(-90, 90, (64, 4))
    book[9] = book[3]
    flat = vectors.flatten(points)
    near = vectors.shortlists(flat.low, flat.high, book)
    gap = np.square(flat.at[:, None] - book[None]).sum(axis=2)
    block = np.arange(4000) // vectors.BLOCK
    assert near[block, gap.argmin(axis=1)].all()
    assert near.mean() < 0.6  # boxes do rule entries out
    index, error = vectors.assign(flat, book)
    full = np.square(points[:, None] - book[None]).sum(axis=2)
    assert (index == full.argmin(axis=1)).all() and (error == full.min(axis=1)).all()
