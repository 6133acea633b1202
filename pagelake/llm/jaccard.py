"""Joins texts whose sets of word n-grams are alike, by PartEnum signatures.

Two sets with Jaccard similarity of 3/4 or more have like sizes and differ in few
elements. So sets are dealt to size bands, and within a band the domain of all
elements is partitioned twice: into parts, and each part into ``SUBPARTS``. A
signature is a set's elements within one subset of ``SUBPARTS - SPARE`` subparts of a
part. Sets that differ in too few elements to touch every such subset share one.

A part of the domain in which a set has nothing proves nothing, so only non-empty
signatures are written, and each set counts how many differences they can stand. If
that is not enough (small sets, rarely), the set also writes its first elements in
hash order, enough for any two such sets to share one. No link is lost.

Sets that share a signature are candidates. Equal sets are one node from the start.
Candidates are compared by parity vectors, whose distance is never more than the sets'
own, and pairs that pass are checked element by element. Each candidate group is first
compared with three of its members only. Then, between components only, enough pairs
are checked to join all that may be joined; and where some of these fail, the rest.

Elements and sets are known by 64-bit hashes. Working tables lie below the shared
scratch folder. Defined cases: null texts and texts without words have the empty set
and no links; repeated rows are one set; a null id is left out; other columns are not
looked at, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pagelake.llm.graph import components
from pagelake.llm.words import SPACED, grams, mix, slices, words_of
from pagelake.session import scratch_dir, written

WORDS = 5
NUM, DEN = 3, 4  # similarity of NUM/DEN or more links
SUBPARTS, SPARE = 2, 1
FILL = 0.4  # subparts for each element of a band's largest set
BUCKET = 3_000_000  # signatures that one task sorts at once, about
_ONE = np.uint64(0x9E3779B97F4A7C15)
_TWO = np.uint64(0xC2B2AE3D27D4EB4F)


def _band_ends() -> np.ndarray:
    ends, low = [], 1
    while low < 1 << 40:
        ends.append(low * DEN // NUM)
        low = ends[-1] + 1
    return np.array(ends, np.int64)


BANDS = _band_ends()


def elements(texts: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each text's distinct n-grams, ordered. Fewer words: one."""
    words = words_of(texts, SPACED, lower=True)
    h, first = words.hashes(), words.first()
    count = np.diff(first)
    whole = grams(h, n)
    fits = np.flatnonzero(np.append(words.doc, -1)[n - 1 : n - 1 + len(whole)] == words.doc[: len(whole)])
    rows, values = [words.doc[fits]], [whole[fits]]
    for size in range(1, n):
        short = np.flatnonzero(count == size)
        if len(short):
            rows.append(short)
            values.append(mix(grams(h, size)[first[short]] + np.uint64(size)))
    rows, values = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[keep], values[keep]


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first) if len(values) else values[:0]


def set_ids(rows: np.ndarray, values: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and hash of each row's set."""
    size = np.bincount(rows, minlength=n_rows)
    ids = np.zeros(n_rows, np.uint64)
    have = np.flatnonzero(size)
    first = np.searchsorted(rows, have)
    ids[have] = mix(_sums(mix(values ^ _TWO), first) + size[have].astype(np.uint64) * _ONE)
    return size, ids


def signatures(rows: np.ndarray, values: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of all sets, in the band of each set as the smaller one of a
    pair and in the band below as the larger one.
    """
    band = np.searchsorted(BANDS, size)
    out_rows, out = [], []
    for lower in (0, 1):
        tag = band - lower
        own = np.flatnonzero((size > 0) & (tag >= 0))
        if not len(own):
            continue
        parts = np.ones(len(size), np.int64)
        parts[own] = np.ceil(FILL * BANDS[tag[own]] / SUBPARTS)
        wide = np.where((size > 0) & (tag >= 0), parts * SUBPARTS, 0)
        start = np.zeros(len(size) + 1, np.int64)
        np.cumsum(wide, out=start[1:])
        use = wide[rows] > 0
        r, v = rows[use], values[use]
        spread = mix(v + tag[r].astype(np.uint64) * _TWO) >> np.uint64(33)
        at = start[r] + ((spread * wide[r].astype(np.uint64)) >> np.uint64(31)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        at, v = at[order], mix(v[order] ^ _ONE)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        content = np.zeros(start[-1], np.uint64)
        content[at[first]] = _sums(v, first)
        full = np.zeros(start[-1], bool)
        full[at[first]] = True
        content, full = content.reshape(-1, SUBPARTS), full.reshape(-1, SUBPARTS)
        part_row = np.repeat(np.arange(len(size)), wide // SUBPARTS)
        number = np.arange(len(part_row)) - (start[:-1] // SUBPARTS)[part_row]
        where = mix(number.astype(np.uint64) * _ONE + tag[part_row].astype(np.uint64) * _TWO)
        for code, pick in enumerate(combinations(range(SUBPARTS), SUBPARTS - SPARE)):
            some = full[:, pick].any(1)
            sums = content[:, pick].sum(1, dtype=np.uint64)
            out_rows.append(part_row[some])
            out.append(mix(sums[some] + where[some] + np.uint64(code)))
        stands = np.bincount(
            part_row, np.minimum(SPARE + 1, full.sum(1)), minlength=len(size)
        ).astype(np.int64)
        differs = size * 2 * (DEN - NUM) // (DEN + NUM) if lower else size * (DEN - NUM) // NUM
        few = np.flatnonzero((wide > 0) & (stands <= differs))
        for i in few:  # enough elements in hash order for two such sets to share one
            a = np.searchsorted(rows, i)
            prefix = size[i] - -(-size[i] * NUM // DEN) + 1
            out_rows.append(np.full(prefix, i))
            out.append(mix(values[a : a + prefix] + np.uint64(77)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_rows), np.concatenate(out)


def sets_of(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``(doc, n, s, v)``: id, size, hash and parity vector of each row's set."""

    def run(batches):
        for batch in batches:
            for i, j in slices(batch.column(1)):
                rows, values = elements(batch.column(1)[i:j])
                size, ids = set_ids(rows, values, j - i)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j],
                        pa.array(size),
                        pa.array(ids.view(np.int64)),
                        pa.array(parities(values, size), pa.binary()),
                    ],
                    ["doc", "n", "s", "v"],
                )

    own = docs.select(F.col(id).cast("bigint").alias("doc"), F.col(text).alias("body"))
    schema = "doc bigint, n bigint, s bigint, v binary"
    return own.filter("doc IS NOT NULL").mapInArrow(run, schema)


_PACKED = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
PACKED = "b int, sig binary, place binary, sets binary"


def packed(row: np.ndarray, sig: np.ndarray, ids: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Signatures by bucket, a row for each bucket of a slice of sets: the rest of the
    signatures (32 bits), for each the place of its set, and the sets.
    """
    bucket = ((sig >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.lexsort((row, bucket))
    row, sig, bucket = row[order], sig[order], bucket[order]
    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(row) else []
    out = []
    for a, b in zip(cut, [*cut[1:], len(row)]):
        some, place = np.unique(row[a:b], return_inverse=True)
        out.append((
            int(bucket[a]), sig[a:b].astype(np.uint32).tobytes(),
            place.astype(np.uint32).tobytes(), ids[some].tobytes(),
        ))
    columns = zip(*out) if out else [[]] * len(_PACKED)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, _PACKED)], ["b", "sig", "place", "sets"]
    )


def _packed(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """Each text's signatures, ``packed``."""

    def run(batches):
        for batch in batches:
            for i, j in slices(batch.column(0)):
                rows, values = elements(batch.column(0)[i:j])
                size, ids = set_ids(rows, values, j - i)
                _, once = np.unique(ids, return_index=True)
                new = np.zeros(j - i, bool)
                new[once] = True
                use = new[rows]
                yield packed(*signatures(rows[use], values[use], np.where(new, size, 0)), ids, buckets)

    return docs.select(text).mapInArrow(run, PACKED)


def groups_of(_key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """``(g, s)``: sets that share a signature, each different group once."""
    sigs, sets = [], []
    for row in table.select(["sig", "place", "sets"]).to_pylist():
        sigs.append(np.frombuffer(row["sig"], np.uint32))
        sets.append(np.frombuffer(row["sets"], np.uint64)[np.frombuffer(row["place"], np.uint32)])
    sig, s = np.concatenate(sigs), np.concatenate(sets)
    del sigs, sets
    order = np.lexsort((s, sig))
    sig, s = sig[order], s[order]
    keep = np.ones(len(s), bool)
    keep[1:] = (sig[1:] != sig[:-1]) | (s[1:] != s[:-1])
    sig, s = sig[keep], s[keep]
    first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
    size = np.diff(np.append(first, len(sig)))
    several = size > 1
    name = mix(_sums(mix(s), first) + size.astype(np.uint64))
    _, once = np.unique(np.where(several, name, 0), return_index=True)
    chosen = once[several[once]]
    at = np.repeat(first[chosen] - np.cumsum(size[chosen]) + size[chosen], size[chosen])
    at += np.arange(len(at))
    g = np.repeat(name[chosen], size[chosen])
    return pa.table({"g": g.view(np.int64), "s": s[at].view(np.int64)})


def _width(size: int) -> int:
    """Cells of a parity vector: a power of two, about four for each element."""
    return 1 << min(16, max(6, int(size).bit_length() + 1))


def parities(values: np.ndarray, size: np.ndarray) -> list[bytes]:
    """For each set one bit a cell: whether an odd number of elements falls in it. Two
    vectors differ in no more cells than their sets in elements.
    """
    out, end = [], 0
    for n in size.tolist():
        width = _width(n)
        cells = (values[end : end + n] & np.uint64(width - 1)).astype(np.int64)
        odd = np.bincount(cells, minlength=width).astype(np.uint8) & 1
        out.append(np.packbits(odd).tobytes())
        end += n
    return out


def _fold(vector: np.ndarray, n_bytes: int) -> np.ndarray:
    return np.bitwise_xor.reduce(vector.reshape(-1, n_bytes))


def _near(n1: np.ndarray, n2: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes may differ in so few elements and be linked."""
    return distance * (DEN + NUM) <= (n1 + n2) * (DEN - NUM)


@arrow_udf(T.BooleanType())
def _may_link(v1: pa.Array, v2: pa.Array, n1: pa.Array, n2: pa.Array) -> pa.Array:
    out = []
    for a, b, m, n in zip(v1.to_pylist(), v2.to_pylist(), n1.to_pylist(), n2.to_pylist()):
        x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
        size = min(len(x), len(y))
        differ = np.bitwise_count(_fold(x, size) ^ _fold(y, size)).sum(dtype=np.int64)
        out.append(bool(_near(m, n, differ)))
    return pa.array(out, pa.bool_())


def _each_set(texts: pa.Array) -> list[np.ndarray]:
    rows, values = elements(texts)
    return np.split(values, np.searchsorted(rows, np.arange(1, len(texts)))) if len(texts) else []


@arrow_udf(T.BooleanType())
def _linked(a: pa.Array, b: pa.Array) -> pa.Array:
    out = []
    for i, j in slices(a):
        for x, y in zip(_each_set(a[i:j]), _each_set(b[i:j])):
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(DEN * both >= NUM * (len(x) + len(y) - both))
    return pa.array(out, pa.bool_())


def _bodies(docs: DataFrame) -> DataFrame:
    """``(s, body)`` of ``(doc, body)``: a text of each set."""

    def run(batches):
        for batch in batches:
            for i, j in slices(batch.column(1)):
                _, ids = set_ids(*elements(batch.column(1)[i:j]), j - i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids.view(np.int64)), batch.column(1)[i:j]], ["s", "body"]
                )

    return docs.mapInArrow(run, "s bigint, body string")


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of one or more whole groups of rows that come ordered by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cut = np.flatnonzero(keys != keys[-1])
        if len(cut):
            cut = int(cut[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and held[-1].column(key)[0].as_py() != keys[-1]:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _across(full: bool):
    """Pairs of a group's sets in different components that may be linked.

    Without ``full``, a pair is left out if earlier pairs of the group would join its
    components anyway, and the group's name is given out instead (``a`` null, ``b`` the
    name): if those pairs turn out not to be linked, it has to be asked again.

    With it, every pair counts, but in one of the groups it shares: sets bring the
    ``LEAST`` smallest of their groups' names, and a pair is given out by the smallest that
    both bring. Only pairs without such a name are given out by each of their groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "g"):
            g = table["g"].to_numpy()
            s, label, n = (table[c].to_numpy() for c in ("s", "label", "n"))
            vectors = [np.frombuffer(x, np.uint8) for x in table["v"].to_pylist()]
            first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            brought = [set(x) for x in table["least"].to_pylist()] if full else []
            pairs, again = set(), []
            for a, b in zip(first, np.append(first[1:], len(g))):
                size = min(len(vectors[i]) for i in range(a, b))
                v = np.stack([_fold(vectors[i], size) for i in range(a, b)])
                joined = label[a:b].copy()
                left_out = False
                for i in range(b - a - 1):
                    far = np.bitwise_count(v[i + 1 :] ^ v[i]).sum(1, dtype=np.int64)
                    ok = _near(n[a + i], n[a + i + 1 : b], far)
                    ok &= label[a + i + 1 : b] != label[a + i]
                    for j in np.flatnonzero(ok) + i + 1:
                        if not full:
                            if joined[i] == joined[j]:
                                left_out = True
                                continue
                            joined[joined == joined[j]] = joined[i]
                        elif min(brought[a + i] & brought[a + j], default=g[a]) != g[a]:
                            continue
                        pairs.add((min(s[a + i], s[a + j]), max(s[a + i], s[a + j])))
                if left_out:
                    again.append((None, g[a]))
            rows = [*sorted(pairs), *again]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

    return run


LEAST = 16  # names of groups that a set brings to each of its groups
BROADCAST = 2_000_000  # ids that may be sent to every executor, at most


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc`` is among ``ids``. Few ids, as counted, go to the
    documents; otherwise both sides are shuffled.
    """
    ids = ids.distinct()
    few = ids.limit(BROADCAST + 1).count() <= BROADCAST
    return docs.join(F.broadcast(ids) if few else ids, "doc", "left_semi")


def _checked(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """The pairs that are linked."""
    wide = pairs.join(bodies.toDF("a", "x"), "a").join(bodies.toDF("b", "y"), "b")
    return wide.filter(_linked("x", "y")).select("a", "b")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row of ``docs`` with an id.

    ``component_id`` is the smallest id reachable over links, the row's own included.
    """
    spark = docs.sparkSession
    sets = written(sets_of(docs, id, text), scratch_dir(spark, "sets"))
    total = sets.agg(F.sum("n")).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, math.ceil(2 * FILL * total / BUCKET))
    shared = (
        _packed(docs.filter(F.col(id).isNotNull()), text, buckets)
        .groupBy("b")
        .applyInArrow(groups_of, "g bigint, s bigint")
        .distinct()
    )
    groups = written(shared, scratch_dir(spark, "groups"))
    full = sets.filter("n > 0")
    nodes = full.groupBy("s").agg(F.min("doc").alias("doc"))
    vectors = full.dropDuplicates(["s"]).select("s", "n", "v")
    texts = docs.select(F.col(id).cast("bigint").alias("doc"), F.col(text).alias("body"))

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs that are linked, compared element by element."""
        pairs = written(pairs, scratch_dir(spark, "pairs"))
        ends = pairs.select(F.col("a").alias("s")).union(pairs.select(F.col("b").alias("s")))
        wanted = ends.distinct().join(nodes, "s").select("doc")
        bodies = written(
            _bodies(_only(texts, wanted)).dropDuplicates(["s"]), scratch_dir(spark, "bodies")
        )
        return written(_checked(pairs, bodies), scratch_dir(spark, "links"))

    def mixed(label: DataFrame, among: DataFrame, brought: DataFrame | None = None) -> DataFrame:
        """Groups with sets of several components, ordered, with all that is needed
        to compare them.
        """
        placed = among.join(label, "s", "left").withColumn("label", F.coalesce("label", "s"))
        several = (
            placed.groupBy("g")
            .agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
            .filter("lo != hi")
            .select("g")
        )
        wide = placed.join(several, "g").join(vectors, "s")
        wide = (wide if brought is None else wide.join(brought, "s")).repartition("g")
        return wide.sortWithinPartitions("g", "s")

    centre = groups.groupBy("g").agg(
        F.min("s").alias("x"), F.max("s").alias("y"), F.min_by("s", F.xxhash64("s")).alias("z")
    )
    star = (
        groups.join(centre, "g")
        .select("s", F.explode(F.array_distinct(F.array("x", "y", "z"))).alias("c"))
        .filter("c != s")
        .select(F.least("c", "s").alias("a"), F.greatest("c", "s").alias("b"))
    )
    compared = star.distinct().join(vectors.toDF("a", "n1", "v1"), "a")
    compared = compared.join(vectors.toDF("b", "n2", "v2"), "b")
    links = linked(compared.filter(_may_link("v1", "v2", "n1", "n2")).select("a", "b"))
    label = components(links, "a", "b").toDF("s", "label")
    out = "a bigint, b bigint"
    found = mixed(label, groups).mapInArrow(_across(False), out).distinct()
    found = written(found, scratch_dir(spark, "across"))
    links = links.union(linked(found.filter("a IS NOT NULL")))
    label = components(links, "a", "b").toDF("s", "label")
    again = groups.join(found.filter("a IS NULL").select(F.col("b").alias("g")), "g")
    again = again.select("g", "s")
    names = F.array_sort(F.collect_list("g"))
    brought = again.groupBy("s").agg(F.slice(names, 1, LEAST).alias("least"))
    rest = mixed(label, again, brought).mapInArrow(_across(True), out).distinct()
    more = linked(rest)
    if not more.isEmpty():
        label = components(links.union(more), "a", "b").toDF("s", "label")
    named = nodes.join(label, "s", "left").withColumn("label", F.coalesce("label", "s"))
    lowest = named.groupBy("label").agg(F.min("doc").alias("component_id"))
    reached = named.join(lowest, "label").select("s", "component_id")
    return sets.join(reached, "s", "left").select(
        F.col("doc").alias(id),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc").alias("component_id"),
    )
