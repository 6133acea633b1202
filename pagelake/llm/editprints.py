"""Document fingerprints by randomised edit embedding.

A walk goes through the characters of a text. At step t it stands on one character and
moves on if a random bit of (t, character) is set, else it stays; all texts share these
bits. The sequence of characters it stands on is the embedding. Two walks that differ by
an edit soon stand on the same character again and agree from then on, so few edits give
a small Hamming distance. ``WALKS`` independent walks make this reliable.

A fingerprint is a fixed sample of the steps: on level l the walk's first ``SAMPLES`` *
2^l steps are cut into ``SAMPLES`` equal strata with one sampled step each. The steps of
level l + 1 are a subset of those of level l, so texts of any lengths can be compared on
the higher of their levels. A sample is one hex digit, a hash of the ``GRAM`` characters
from there on, or 0 after the end of the text.

Near copies are found by signatures that no two of them fail to share: a part of the
samples less ``SPARE`` of its ``SUBPARTS``. Candidates are compared as a whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.graph import components
from pagelake.llm.jaccard import BUCKET, PACKED, groups_of, packed, whole_groups
from pagelake.llm.words import mix
from pagelake.session import scratch_dir, written

WALKS = 4
SAMPLES = 64  # of each walk
GRAM = 3
SLACK = 1.125  # steps kept for a text, in multiples of the 2 steps a character takes
PERIOD = 1024  # the bits repeat after so many steps
CLASSES = 32  # characters are hashed to so many classes, which share their bits
DIGITS = WALKS * SAMPLES
HEAD = 2  # hex digits that name the level
NEAR = 0.75
SUBPARTS = 5  # of a part of the samples
SPARE = 2  # subparts that a signature leaves out
CENTRES = 6  # members that all others of a group are compared with first
BLOCK = 4096  # members of a group's main component that one task compares the others with
FEWEST = 6  # samples in the text that make a signature
SLICE = 2048  # fingerprints whose signatures are made at once
TOGETHER = 1 << 21  # characters embedded at once
LONG = 1 << 16  # characters from which on a text is walked through alone

_rng = np.random.default_rng(20250713)
_BITS = _rng.integers(0, 2, (CLASSES, PERIOD, WALKS), dtype=np.int8)
_BITS[:, -1] = 1  # every walk moves on at least once in a period
# Which of a stratum's halves holds its sampled step, by level and walk.
_HALVES = _rng.integers(0, 2, (40, WALKS, SAMPLES), dtype=np.int64)


@cache
def _moves() -> np.ndarray:
    """Steps that a walk spends on a character, by (class, step, walk), flat."""
    out = np.zeros((CLASSES, 2 * PERIOD, WALKS), np.int32)
    twice = np.concatenate([_BITS, _BITS], axis=1)
    left = np.zeros((CLASSES, WALKS), np.int32)
    for t in range(2 * PERIOD - 1, -1, -1):
        left = np.where(twice[:, t] == 1, 1, left + 1)
        out[:, t] = left
    return np.ascontiguousarray(out[:, :PERIOD]).reshape(-1)


@cache
def _steps(level: int) -> np.ndarray:
    """The sampled steps of each walk on a level, ascending."""
    at = np.tile(np.arange(SAMPLES), (WALKS, 1))
    for k in range(level, 0, -1):
        at = 2 * at + np.take_along_axis(_HALVES[k - 1], at % SAMPLES, axis=1)
    return at


def _halved(digits: np.ndarray, level: int) -> np.ndarray:
    """Digits of the level above ``level``, for rows of digits."""
    out = np.zeros_like(digits).reshape(-1, WALKS, SAMPLES)
    old = digits.reshape(-1, WALKS, SAMPLES)
    lower = np.arange(SAMPLES // 2)
    for w in range(WALKS):
        # The choice on the top level is that of the stratum itself.
        pick = 2 * lower + _HALVES[level, w, lower]
        out[:, w, : SAMPLES // 2] = old[:, w, pick]
    return out.reshape(len(digits), DIGITS)


def level_of(n: np.ndarray) -> np.ndarray:
    """The lowest level whose steps hold the walk through ``n`` characters."""
    need = np.maximum(np.ceil(2 * SLACK * np.asarray(n, np.float64) / SAMPLES), 1)
    return np.ceil(np.log2(need)).astype(np.int64)


def _classes(codes: np.ndarray) -> np.ndarray:
    return (mix(codes.astype(np.uint64)) % np.uint64(CLASSES)).astype(np.int32)


def _digit_at(codes: np.ndarray, first: np.ndarray, last: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Digits of the characters at ``place`` of texts ``codes[first:last]``."""
    h = np.zeros(len(place), np.uint64)
    for k in range(GRAM):
        at = first + place + k
        inside = at < last
        code = np.where(inside, codes[np.where(inside, at, 0)] + 1, 0) if len(codes) else np.zeros(len(place), int)
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + code.astype(np.uint64) + np.uint64(1))
    return np.where(first + place < last, 1 + h % np.uint64(15), 0).astype(np.uint8)


def _walk_many(kinds: list[np.ndarray]) -> list[np.ndarray]:
    """Place of each sampled step, for texts as arrays of classes, the longest first."""
    n = np.array([len(k) for k in kinds])
    wide, table = len(kinds), _moves()
    rows = np.zeros((n[0], wide), np.int32)
    for d, k in enumerate(kinds):
        rows[: len(k), d] = k
    rows *= PERIOD * WALKS
    # A state is WALKS * step + walk, so its low bits are the place in a class's moves.
    state = np.empty((n[0] + 1, wide, WALKS), np.int32)
    state[0] = np.arange(WALKS)
    active = np.searchsorted(-n, -np.arange(n[0]), "left")
    at, moved = np.empty((wide, WALKS), np.int32), np.empty((wide, WALKS), np.int32)
    scaled = table * np.int32(WALKS)
    for i in range(n[0]):
        a = active[i]
        np.bitwise_and(state[i, :a], PERIOD * WALKS - 1, out=at[:a])
        at[:a] += rows[i, :a, None]
        np.take(scaled, at[:a], out=moved[:a], mode="clip")
        np.add(state[i, :a], moved[:a], out=state[i + 1, :a])
    ends = np.ascontiguousarray(state[1:].reshape(n[0], -1).T)
    del state
    out, level = [], level_of(n)
    for d in range(wide):
        steps = _steps(int(level[d])) * WALKS + np.arange(WALKS)[:, None]
        own = ends[d * WALKS : (d + 1) * WALKS, : n[d]]
        out.append(np.concatenate([np.searchsorted(own[w], steps[w], "right") for w in range(WALKS)]))
    return out


def _walk_one(kinds: np.ndarray) -> np.ndarray:
    """The same for one long text, which would leave ``_walk_many`` with narrow rows."""
    table = _moves().reshape(CLASSES, PERIOD, WALKS)
    text, out = kinds.tolist(), []
    for w in range(WALKS):
        moves = [table[c, :, w].astype(np.uint8).tobytes() for c in range(CLASSES)]
        steps = iter([*_steps(int(level_of(len(text)))).tolist()[w], float("inf")])
        at, due = 0, next(steps)
        for place, c in enumerate(text):
            at += moves[c][at % PERIOD]
            while due < at:
                out.append(place)
                due = next(steps)
        out += [len(text)] * ((w + 1) * SAMPLES - len(out))
    return np.array(out)


def _together(n: np.ndarray) -> Iterator[np.ndarray]:
    """Texts to walk through side by side, the longest first."""
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    i = 0
    while i < len(order):
        j = i + 1 if n[order[i]] > LONG else i + max(1, TOGETHER // int(n[order[i]]))
        yield order[i:j]
        i = j


def digits_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Level and digits of each text."""
    n = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.append(0, np.cumsum(n))
    digits = np.zeros((len(texts), DIGITS), np.uint8)
    for rows in _together(n):
        kinds = [_classes(codes[first[r] : first[r + 1]]) for r in rows]
        places = [_walk_one(kinds[0])] if len(kinds[0]) > LONG else _walk_many(kinds)
        place = np.concatenate(places)
        start, stop = (np.repeat(first[x], DIGITS) for x in (rows, rows + 1))
        digits[rows] = _digit_at(codes, start, stop, place).reshape(len(rows), DIGITS)
    return level_of(n), digits


_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def spelled(level: np.ndarray, digits: np.ndarray) -> list[str]:
    """Fingerprints as strings: the level in two hex digits, then the samples."""
    full = np.column_stack([level >> 4, level & 15, digits]).astype(np.int64)
    text = _HEX[full].tobytes().decode()
    size = HEAD + DIGITS
    return [text[i : i + size] for i in range(0, len(text), size)]


def _read(prints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer("".join(prints).encode(), np.uint8).reshape(len(prints), -1).astype(np.int64)
    value = np.where(raw >= 97, raw - 87, raw - 48)
    return value[:, 0] * 16 + value[:, 1], value[:, HEAD:].astype(np.uint8)


def agreement(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Equal digits among those that lie within either text, on the higher level."""
    top = np.maximum(a[0], b[0])
    sides = []
    for level, digits in (a, b):
        level, digits = level.copy(), digits.copy()
        while (low := level < top).any():
            for k in np.unique(level[low]):
                rows = low & (level == k)
                digits[rows] = _halved(digits[rows], int(k))
            level[low] += 1
        sides.append(digits)
    x, y = sides
    inside = (x > 0) | (y > 0)
    same = ((x == y) & inside).sum(axis=1)
    return np.where(inside.any(axis=1), same / np.maximum(inside.sum(axis=1), 1), 1.0)


def with_fingerprint(docs: DataFrame, out: str = "fingerprint", text: str = "text") -> DataFrame:
    """Add the fingerprint of the whole ``text``; null counts as empty. Raises
    ``ValueError`` if there is a column ``out``.
    """
    if out in docs.columns:
        raise ValueError(f"column {out} exists")

    @F.pandas_udf("string")
    def mark(texts: pd.Series) -> pd.Series:
        return pd.Series(spelled(*digits_of([t or "" for t in texts])))

    return docs.withColumn(out, mark(F.col(f"`{text}`")))


def likeness(a: str | Column, b: str | Column) -> Column:
    """Share of equal samples of two fingerprints, 0 to 1; 1 for two empty texts."""

    @F.pandas_udf("double")
    def compare(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(agreement(_read(x.tolist()), _read(y.tolist())) if len(x) else [], dtype=float)

    return compare(a, b)


def _cut(digits: np.ndarray, size: int) -> np.ndarray:
    """Digits in parts of ``size``, the last one filled with zeros. The first parts lie in
    one walk each, so that texts that begin alike share few; the others go through all
    walks at once, so that few of them lie around a text's end.
    """
    place = np.arange(DIGITS).reshape(WALKS, SAMPLES)
    order = np.concatenate([place[:, :size].ravel(), place[:, size:].T.ravel()])
    return np.pad(digits[:, order], ((0, 0), (0, -DIGITS % size))).reshape(len(digits), -(-DIGITS // size), size)


def _hashed(parts: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Hashes over the last axis."""
    h = np.broadcast_to(mix(seed.astype(np.uint64)), parts.shape[:-1])
    for c in range(parts.shape[-1]):
        h = mix(h + parts[..., c].astype(np.uint64) + np.uint64(1))
    return h


def _signatures(digits: np.ndarray, level: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of fingerprints; any two on one level with a likeness of ``least``
    or more have one in common.

    Of a fingerprint with n samples in the text, d of which differ from another one that
    has z samples beyond, n - d >= least * (n + z), so d + least * z <= (1 - least) * n.
    A difference costs 1 within the text, or ``least`` beyond. As a signature is a part
    less ``SPARE`` subparts, one more must differ to spoil all of a part. Where what it costs
    to spoil all parts is more than that bound, the two share a signature. Signatures with
    less than ``FEWEST`` samples in the text would be common and are left out, which counts
    as spoiled. A fingerprint for which the rest is too little (a very short text) adds
    runs of digits that are so short that they always suffice.
    """
    slack = max(1 - least, 1 / DIGITS)
    size = min(max(int((SPARE + 1) / slack + 1e-9) - 1, SUBPARTS), SAMPLES // 2)
    whole = _cut(digits, size)
    ends = np.arange(SUBPARTS + 1) * size // SUBPARTS
    tag = mix(level.astype(np.uint64))[:, None] + np.arange(whole.shape[1], dtype=np.uint64) * np.uint64(16)
    h, some, cost = [], [], []
    for k, (i, j) in enumerate(zip(ends, ends[1:])):
        sub = whole[:, :, i:j]
        some.append((sub > 0).sum(-1, dtype=np.int8))
        cost.append(np.where((sub > 0).all(-1), 1, least))
        h.append(_hashed(sub, np.array([k])))
    rows, sigs = [], []
    spoil = np.sort(cost, axis=0)[: SPARE + 1].sum(0)
    any_left = np.zeros(spoil.shape, bool)
    can_differ = {}
    for k, left_out in enumerate(combinations(range(SUBPARTS), SPARE)):
        rest = [j for j in range(SUBPARTS) if j not in left_out]
        given = sum(some[j] for j in rest) >= FEWEST
        row, part = np.nonzero(given)
        rows.append(row)
        own = sum(h[j][row, part] for j in rest)
        sigs.append(mix(own + mix(tag[row, part] + np.uint64(k))))
        any_left |= given
        for m in range(1, SPARE + 1):
            for few in combinations(left_out, m):
                can_differ[few] = can_differ.get(few, False) | given
    # Subparts that no signature given out leaves out together need not differ with more.
    for few, stands in can_differ.items():
        spoil = np.where(stands, spoil, np.minimum(spoil, sum(cost[j] for j in few)))
    n = (digits > 0).sum(1)
    weak = np.flatnonzero((n > 0) & ((spoil * any_left).sum(1) <= n * (1 - least) + 1e-6))
    if len(weak):
        size = min(max(math.ceil(1 / slack - 1e-9) - 1, 1), SAMPLES)
        while size > 1 and least <= (size - 1) * (slack + 1e-9):
            size -= 1
        runs = _cut(digits[weak], size)
        row, run = np.nonzero((runs > 0).any(-1))
        own = _hashed(runs, np.arange(runs.shape[1]) + SUBPARTS)
        rows.append(weak[row])
        sigs.append(mix(own[row, run] + mix(level[weak[row]].astype(np.uint64) + np.uint64(256))))
    none = np.flatnonzero(n == 0)
    rows.append(none)
    sigs.append(mix(level[none].astype(np.uint64) + np.uint64(512)))
    return np.concatenate(rows), np.concatenate(sigs)


def _packed(prints: DataFrame, least: float, smallest: dict[int, int], buckets: int) -> DataFrame:
    """Signatures of ``(s, fp)`` on its own level and on all higher ones where it may be
    like a fingerprint of that level, of which the smallest has ``smallest`` samples in
    the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                batch = whole.slice(at, SLICE)
                level, digits = _read(batch.column(1).to_pylist())
                row = np.arange(len(level))
                found = [_signatures(digits, level, least)]
                rows, sigs = [found[0][0]], [found[0][1]]
                while len(row):
                    for k in np.unique(level):
                        digits[level == k] = _halved(digits[level == k], int(k))
                    level = level + 1
                    n = (digits > 0).sum(1)
                    goes_on = np.zeros(len(row), bool)
                    meets = np.zeros(len(row), bool)
                    for k, few in smallest.items():
                        enough = n >= least * few - 1e-6
                        goes_on |= enough & (level <= k)
                        meets |= enough & (level == k)
                    r, sig = _signatures(digits[meets], level[meets], least)
                    rows.append(row[meets][r])
                    sigs.append(sig)
                    row, level, digits = row[goes_on], level[goes_on], digits[goes_on]
                ids = batch.column(0).to_numpy().view(np.uint64)
                yield packed(np.concatenate(rows), np.concatenate(sigs), ids, buckets)

    return prints.select("s", "fp").mapInArrow(run, PACKED)


def _links_within(level: np.ndarray, digits: np.ndarray, label: np.ndarray, main: int, least: float) -> list:
    """Pairs of places that are alike, enough to join all that are; those with one label
    are joined, and two that have the label ``main`` are not asked.
    """
    out, joined, at, now = [], label.copy(), digits.copy(), level.copy()
    for top in np.unique(level):
        while (low := now < top).any():
            for k in np.unique(now[low]):
                at[low & (now == k)] = _halved(at[low & (now == k)], int(k))
            now[low] += 1
        below = np.flatnonzero(level <= top)
        for i in np.flatnonzero(level == top):
            j = below[(level[below] < top) | (below > i)]
            j = j[joined[j] != joined[i]]
            j = j[label[j] != main] if label[i] == main else j
            if not len(j):
                continue
            x, y = at[i], at[j]
            inside = (x > 0) | (y > 0)
            n = inside.sum(1)
            same = ((x == y) & inside).sum(1)
            for k in j[np.where(n > 0, same / np.maximum(n, 1), 1.0) >= least]:
                if joined[k] != joined[i]:
                    joined[joined == joined[k]] = joined[i]
                    out.append((i, k))
    return out


def _across(least: float):
    """Links between components within each block of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "k"):
            k, s, label, main = (table[c].to_numpy() for c in ("k", "s", "label", "main"))
            level, digits = _read(table["fp"].to_pylist())
            first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            pairs = set()
            for i, j in zip(first, np.append(first[1:], len(k))):
                for a, b in _links_within(level[i:j], digits[i:j], label[i:j], main[i], least):
                    pairs.add((min(s[i + a], s[i + b]), max(s[i + a], s[i + b])))
            found = sorted(pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[c] for p in found], pa.int64()) for c in (0, 1)], ["a", "b"]
            )

    return run


def near_copies(prints: DataFrame, id: str, fingerprint: str = "fingerprint", least: float = NEAR) -> DataFrame:
    """``(id, copy_of)``: the smallest id among the near copies that a row hangs together
    with, itself included. Rows with a null id are left out. Near copies have a likeness of
    ``least`` or more; no such pair is lost. Raises ``ValueError`` unless 0 < least <= 1.

    Equal fingerprints are one, known by a number. Others that share a signature form
    a group and are compared as a whole, first with ``CENTRES`` members of it. Then the
    members of a group that still lie in different components are compared with each
    other: those of its largest component are dealt to blocks, the others go to each block.
    So copies are never paired out; members that are unlike all others of a large group
    are. Steps are written below the shared scratch folder.
    """
    if not 0 < least <= 1:
        raise ValueError(f"least is {least}, not in (0, 1]")
    spark: SparkSession = prints.sparkSession
    rows = prints.select(F.col(f"`{id}`").alias("id"), F.col(f"`{fingerprint}`").alias("fp")).filter("id IS NOT NULL")

    def kept_at(df: DataFrame) -> DataFrame:
        return written(df, scratch_dir(spark, "copies"))

    own = rows.groupBy("fp").agg(F.min("id").alias("id"))
    own = kept_at(own.withColumn("s", F.monotonically_increasing_id()))
    short = own.select("s", F.unhex("fp").alias("fp"))
    samples = F.expr(f"length(replace(substr(fp, {HEAD + 1}), '0', ''))")
    sizes = own.groupBy(F.expr(f"conv(substr(fp, 1, {HEAD}), 16, 10)").cast("int").alias("level"))
    sizes = sizes.agg(F.min(samples).alias("few"), F.sum(samples).alias("total")).collect()
    smallest = {r.level: r.few for r in sizes}
    least_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least_buckets, math.ceil(sum(r.total for r in sizes) / BUCKET))
    shared = _packed(own, least, smallest, buckets).groupBy("b").applyInArrow(groups_of, "g bigint, s bigint")
    groups = kept_at(shared.distinct())

    ends = [F.min("s"), F.max("s")]
    some = [F.min_by("s", F.xxhash64("s", F.lit(k))) for k in range(CENTRES - 2)]
    centre = groups.groupBy("g").agg(F.array_distinct(F.array(*ends, *some)).alias("centres"))
    star = groups.join(centre, "g").select("s", F.explode("centres").alias("c")).filter("s != c")
    both = star.select(F.least("s", "c").alias("a"), F.greatest("s", "c").alias("b")).distinct()
    for end, fp in (("a", "x"), ("b", "y")):
        both = both.join(short.toDF(end, fp), end)
    x, y = (F.lower(F.hex(c)) for c in ("x", "y"))
    links = kept_at(both.filter(likeness(x, y) >= least).select("a", "b"))
    label = components(links, "a", "b").toDF("s", "label")

    # A group of three or less has been compared as a whole.
    placed = groups.join(label, "s", "left").withColumn("label", F.coalesce("label", "s"))
    parts = placed.groupBy("g", "label").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("g").agg(F.max_by("label", "n").alias("main"), F.sum("n").alias("n"), F.max("n").alias("most"))
    mixed = mixed.filter("n > 3 AND n != most").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    block = F.when(
        F.col("label") == F.col("main"), F.array(F.pmod(F.xxhash64("s"), "blocks").cast("int"))
    ).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = placed.join(mixed, "g").withColumn("block", F.explode(block))
    dealt = dealt.select(F.xxhash64("g", "block").alias("k"), "s", "label", "main").join(short, "s")
    ordered = dealt.repartition("k").sortWithinPartitions("k", "s").withColumn("fp", F.lower(F.hex("fp")))
    more = kept_at(ordered.mapInArrow(_across(least), "a bigint, b bigint"))
    if not more.isEmpty():
        label = components(links.union(more), "a", "b").toDF("s", "label")
    named = own.join(label, "s", "left").select("fp", "id", F.coalesce("label", "s").alias("label"))
    lowest = named.groupBy("label").agg(F.min("id").alias("copy_of"))
    joined = rows.join(named.select("fp", "label").join(lowest, "label"), "fp")
    return joined.select(F.col("id").alias(id), "copy_of")


# -- Each document against an edit of itself and against its neighbour ----------------

_EDITED = "edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, after: str) -> str:
    """``text`` with its last half replaced by the beginning of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _against_next(texts: list[str], follow: list[str], own: tuple, nxt: tuple) -> dict[str, list]:
    """The columns of ``_EDITED`` for texts and those that follow them, by both's digits."""
    made = [edited(t, f) for t, f in zip(texts, follow)]
    new = digits_of(made)
    return {
        "edited_sha256": [hashlib.sha256(m.encode("utf-8", "surrogatepass")).hexdigest() for m in made],
        "fingerprint": spelled(*own),
        "edited_fingerprint": spelled(*new),
        "near_edited": agreement(own, new),
        "near_next": agreement(own, nxt),
    }


def _chained(schema: pa.Schema):
    """Rows in order to results. A task's last row lacks its follower: it and the task's
    first row carry their texts, by which the rest is joined later.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def out(*columns):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        def chained(ids, texts, first):
            n = len(texts) - 1
            level, digits = digits_of(texts)
            both = (level[:-1], digits[:-1]), (level[1:], digits[1:])
            made = _against_next(texts[:-1], texts[1:], *both)
            heads = [texts[0] if first else None] + [None] * (n - 1)
            return out(ids[:-1], [len(t) for t in texts[:-1]], [part] * n, heads, [None] * n, *made.values())

        held, begin = None, True
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            if not texts:
                continue
            if held is not None:
                ids, texts = [held[0], *ids], [held[1], *texts]
            if len(texts) > 1:
                yield chained(ids, texts, begin)
                begin = False
            held = ids[-1], texts[-1]
        if held is not None:
            later = [[None]] * (len(schema) - 5)
            yield out([held[0]], [len(held[1])], [part], [held[1] if begin else None], [held[1]], *later)

    return run


def against_next(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's fingerprint, that of its edited text, and how near its own is to that
    and to the next row's: ``(id, n_chars, edited_sha256, ...)`` as in ``_EDITED``.

    The next row is that with the next smaller id, and the first one's after the last.
    Rows with equal ids follow one another in the order of a hash of their texts, null
    ids come last. Null texts are empty; the fingerprint of an empty text is all zeros,
    and the likeness of two of them is 1. A single row is its own next. An empty table
    gives no rows. Other columns are ignored.

    One shuffle cuts the rows into ranges of ids; a task passes through its range in
    order. Only the last row of each range waits for the first one of the range after.
    Results are written below the shared scratch folder.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    # The last column spreads the copies of one row.
    order = [F.desc_nulls_last("id"), "h", "i"]
    keyed = rows.withColumns({"h": F.xxhash64("text"), "i": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    kind = rows.schema["id"].dataType
    plain = f"n_chars long, part int, head string, tail string, {_EDITED}"
    schema = T.StructType([T.StructField("id", kind), *T.StructType.fromDDL(plain).fields])
    from pyspark.sql.pandas.types import to_arrow_type

    to_arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])
    done = written(ordered.mapInArrow(_chained(to_arrow), schema), scratch_dir(spark, "edited"))

    # One row a task: the text it begins with, and the number of the task before it.
    heads = done.filter(F.col("head").isNotNull()).select("part", "head")
    around = Window.orderBy("part")
    last = F.max("part").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    turn = heads.select("part", F.coalesce(F.lag("part").over(around), last).alias("before"))
    follow = heads.join(turn, "part").select(F.col("before").alias("part"), F.col("head").alias("follow"))
    waiting = done.filter(F.col("tail").isNotNull()).select("id", "n_chars", "part", "tail").join(follow, "part")

    @F.pandas_udf(_EDITED)
    def resolve(texts: pd.Series, after: pd.Series) -> pd.DataFrame:
        own, follow = texts.tolist(), after.tolist()
        return pd.DataFrame(_against_next(own, follow, digits_of(own), digits_of(follow)))

    names = [f.name for f in T.StructType.fromDDL(_EDITED)]
    ends = waiting.withColumn("r", resolve("tail", "follow")).select("id", "n_chars", *(f"r.{n}" for n in names))
    full = done.filter(F.col("tail").isNull()).select("id", "n_chars", *names)
    return full.union(ends).withColumnRenamed("id", id)
