"""Product-quantised vector codes, learnt and assigned in exact integers.

Vectors are stored once as flat chunks: in every chunk the subvectors of each part are
sorted along a Hilbert curve and cut into small blocks, each with the box (minimum and
maximum) and the sum of its members. A round of k-means then looks at boxes first: an
entry whose least distance to the box exceeds another's greatest can be nearest to no
member, so it is off the block's shortlist (a plane halfway to the best entry rules out
more). A block with one entry left is settled by its
sum and count alone; the others are evaluated against their shortlist only. Both bounds
are integers, so shortlists never lose the nearest entry nor the lowest of tied ones.

Chunks need no shuffle; a round shuffles partial sums, at most ``entries`` times the
vector's length rows a task. What comes to the driver is the codebook, of that size too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.session import scratch_dir, written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
CHUNK = 8192  # vectors stored side by side
BLOCK = 64  # subvectors of one box
LARGEST = 1 << 24  # scaled components below this keep errors within 64 bits


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point (rows of ``bits``-bit numbers) along the Hilbert curve.

    The bits of all dimensions must fit one 64-bit number.
    """
    x = [points[:, k].astype(np.int64) for k in range(points.shape[1])]
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:  # undo the rotations, from the largest cube to the smallest
        p = q - 1
        for k in range(n):
            inside = (x[k] & q) != 0
            swap = np.where(inside, 0, (x[0] ^ x[k]) & p)
            x[0] = np.where(inside, x[0] ^ p, x[0] ^ swap)
            if k:
                x[k] = x[k] ^ swap
        q >>= 1
    for k in range(1, n):  # Gray code
        x[k] = x[k] ^ x[k - 1]
    turn, q = np.zeros(len(points), np.int64), top
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    out = np.zeros(len(points), np.int64)
    for b in range(bits - 1, -1, -1):
        for k in range(n):
            out = (out << 1) | (((x[k] ^ turn) >> b) & 1)
    return out


def hilbert_order(points: np.ndarray) -> np.ndarray:
    """Rows in the order of the curve over their own bounding box."""
    used = points[:, :62]  # an order only: more dimensions would not fit the index
    bits = max(1, min(8, 62 // used.shape[1]))
    low = used.min(axis=0)
    span = np.maximum(used.max(axis=0) - low, 1)
    cells = (used - low) * ((1 << bits) - 1) // span
    return np.argsort(hilbert_index(cells, bits), kind="stable")


@dataclass
class Flat:
    """One part of a chunk: subvectors in curve order and their blocks' boxes and sums."""

    order: np.ndarray  # row of the chunk at each place
    at: np.ndarray  # places, by part dimensions
    starts: np.ndarray  # first place of each block
    low: np.ndarray
    high: np.ndarray
    total: np.ndarray


def flatten(points: np.ndarray, block: int = BLOCK) -> Flat:
    order = hilbert_order(points)
    at, starts = points[order], np.arange(0, len(points), block)
    return Flat(
        order,
        at,
        starts,
        np.minimum.reduceat(at, starts),
        np.maximum.reduceat(at, starts),
        np.add.reduceat(at, starts),
    )


def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Which entries can be nearest to a point of each box: blocks by entries.

    Out go those whose least distance to the box exceeds another's greatest, and those
    that have the whole box on the other side of the plane halfway to the box's best.
    """
    under, over = low[:, None, :] - book[None], book[None] - high[:, None, :]
    least = np.square(np.maximum(np.maximum(under, over), 0)).sum(axis=2)
    # -under and -over are the distances to the two faces where these are positive.
    most = np.square(np.maximum(np.abs(under), np.abs(over))).sum(axis=2)
    best = book[most.argmin(axis=1)][:, None, :]
    # Largest value over the box of (distance to best) - (distance to the entry).
    turn = 2 * (book[None] - best)
    corner = np.where(turn > 0, high[:, None, :], low[:, None, :])
    gain = (best * best - book[None] * book[None] + turn * corner).sum(axis=2)
    return (least <= most.min(axis=1)[:, None]) & (gain >= 0)


def _blocks(flat: Flat, book: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray | None]]:
    """``(block, first, last, shortlist, nearest)``; nearest is None for a shortlist of one."""
    near = shortlists(flat.low, flat.high, book)
    ends = np.append(flat.starts[1:], len(flat.at))
    for b, (i, j) in enumerate(zip(flat.starts, ends)):
        few = np.flatnonzero(near[b])
        if len(few) == 1:
            yield b, i, j, few, None
            continue
        gap = flat.at[i:j, None, :] - book[few][None]
        yield b, i, j, few, few[np.einsum("pes,pes->pe", gap, gap).argmin(axis=1)]


def gather(flat: Flat, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many points each entry is nearest to, and their sums."""
    count = np.zeros(len(book), np.int64)
    total = np.zeros(book.shape, np.int64)
    for b, i, j, few, nearest in _blocks(flat, book):
        if nearest is None:
            count[few[0]] += j - i
            total[few[0]] += flat.total[b]
        else:
            np.add.at(count, nearest, 1)
            np.add.at(total, nearest, flat.at[i:j])
    return count, total


def assign(flat: Flat, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row of the chunk, and its squared distance."""
    index = np.empty(len(flat.at), np.int64)
    for _, i, j, few, nearest in _blocks(flat, book):
        index[i:j] = few[0] if nearest is None else nearest
    gap = flat.at - book[index]
    out = np.empty(len(index), np.int64), np.empty(len(index), np.int64)
    out[0][flat.order], out[1][flat.order] = index, np.einsum("ps,ps->p", gap, gap)
    return out


def usable(vector: Column) -> Column:
    """No null vector and no null, infinite or undefined component in it."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & whole, F.lit(False))


_FIELDS = ("order", "at", "starts", "low", "high", "total")


def _packed(parts: int, size: int, ids: pa.DataType, labels: pa.DataType):
    """Rows to chunks: a part's arrays are one binary value each."""
    names = [f"{f}{m}" for m in range(parts) for f in _FIELDS]
    schema = pa.schema(
        [("ids", pa.list_(ids)), ("labels", pa.list_(labels)), *((n, pa.binary()) for n in names)]
    )

    def chunk(table: pa.Table) -> pa.RecordBatch:
        flat = table["v"].combine_chunks().flatten().to_numpy()
        rows = flat.astype(np.int64).reshape(len(table), parts, size)
        values = []
        for m in range(parts):
            part = flatten(rows[:, m])
            values += [getattr(part, f).astype(np.int64 if f == "total" else np.int32) for f in _FIELDS]
        columns = [pa.array([table[k].to_pylist()], schema.field(k).type) for k in ("ids", "labels")]
        columns += [pa.array([x.tobytes()], pa.binary()) for x in values]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while len(batch):
                took = batch.slice(0, CHUNK - n)
                batch, n = batch.slice(len(took)), n + len(took)
                held.append(took)
                if n == CHUNK:
                    yield chunk(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield chunk(pa.Table.from_batches(held))

    return pack, schema


def _unpacked(row: dict, m: int, size: int) -> Flat:
    kinds = {"total": np.int64}
    got = [np.frombuffer(row[f"{f}{m}"], kinds.get(f, np.int32)).astype(np.int64) for f in _FIELDS]
    return Flat(got[0], got[1].reshape(-1, size), got[2], *(x.reshape(-1, size) for x in got[3:]))


def _sums(books: np.ndarray):
    """Chunks to ``(part, entry, dim, count, total)``, added up within the task."""
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros(books.shape, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                for m in range(parts):
                    c, t = gather(_unpacked(row, m, size), books[m])
                    count[m] += c
                    total[m] += t
        m, e = np.nonzero(count)
        shape = [np.repeat(m, size), np.repeat(e, size), np.tile(np.arange(size), len(m))]
        values = [*shape, np.repeat(count[m, e], size), total[m, e].reshape(-1)]
        names = ["part", "entry", "dim", "n", "total"]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in values], names)

    return run


def _codes(books: np.ndarray, schema: pa.Schema):
    parts, _, size = books.shape
    hexes = np.array([f"{i:02x}" for i in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                error, code = 0, np.full(len(row["ids"]), "", dtype=object)
                for m in range(parts):
                    index, gap = assign(_unpacked(row, m, size), books[m])
                    error, code = error + gap, code + hexes[index].astype(object)
                columns = [row["ids"], row["labels"], list(code), error]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                )

    return run


@dataclass
class Compressed:
    """``rows``: id, label, ``code``, ``error``; ``books``: parts by entries by dimensions."""

    rows: DataFrame
    books: np.ndarray

    def digest(self) -> str:
        """SHA-256 of the codebooks' numbers in order, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.books.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Compressed:
    """Codes of all usable vectors under codebooks learnt from all of them.

    A component x counts as floor(``scale`` * x). The books start as the vectors of the
    ``entries`` (at most 256) smallest ids; in each of ``rounds`` rounds every part goes to
    its nearest entry, the lower of tied ones, and used entries become the floored means.
    ``error`` is the sum of a vector's squared distances to its entries.

    Rows without a usable vector are left out. Repeated rows and ids count as often as
    they occur; of equal ids the smaller vector, component by component, comes first in
    the books; null ids come last. A vector whose length differs from the first one's or
    is no multiple of ``parts``, or with a scaled component of 2^24 or more, takes no part
    and has a null code and error. Fewer vectors than ``entries`` make smaller books; an
    empty table has none. Other columns are ignored.

    Chunks are written below the shared scratch folder and read by every round.
    """
    spark = vectors.sparkSession
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits, so 1 to 256 entries")
    names = {id: "ids", vector: "v", label: "labels"}
    far = F.lit(float(1 << 40))  # beyond LARGEST, and still a 64-bit integer
    rows = vectors.select(*(F.col(f"`{k}`").alias(v) for k, v in names.items()))
    rows = rows.filter(usable(F.col("v"))).withColumn(
        "v", F.transform("v", lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, -far), far)))
    )
    kinds = {f.name: f.dataType for f in rows.schema}
    out = T.StructType([
        T.StructField(id, kinds["ids"]),
        T.StructField(label, kinds["labels"]),
        T.StructField("code", T.StringType()),
        T.StructField("error", T.LongType()),
    ])
    small = F.forall("v", lambda x: F.abs(x) < LARGEST)
    lead = rows.filter(small & (F.size("v") > 0) & (F.size("v") % parts == 0))
    order = [F.asc_nulls_last("ids"), "v"]
    first = [r["v"] for r in lead.orderBy(*order).limit(entries).collect()]
    if not first:
        nothing = rows.select("ids", "labels", F.lit(None).cast("string"), F.lit(None).cast("bigint"))
        return Compressed(nothing.toDF(*out.names), np.zeros((parts, 0, 0), np.int64))
    length = len(first[0])
    size = length // parts
    same = F.coalesce(small & (F.size("v") == length), F.lit(False))
    if any(len(v) != length for v in first):
        first = [r["v"] for r in lead.filter(same).orderBy(*order).limit(entries).collect()]
    books = np.array(first, np.int64).reshape(len(first), parts, size).transpose(1, 0, 2).copy()

    to_arrow = pa.schema([(f.name, _arrow(f.dataType)) for f in out])
    pack, packed = _packed(parts, size, to_arrow.field(id).type, to_arrow.field(label).type)
    stored = T.StructType([
        T.StructField("ids", T.ArrayType(kinds["ids"])),
        T.StructField("labels", T.ArrayType(kinds["labels"])),
        *(T.StructField(n, T.BinaryType()) for n in packed.names[2:]),
    ])
    chunks = written(rows.filter(same).mapInArrow(pack, stored), scratch_dir(spark, "chunks"))
    for _ in range(rounds):
        part = chunks.mapInArrow(_sums(books), "part long, entry long, dim long, n long, total long")
        # Sums over all tasks may pass 64 bits, a mean never does.
        mean = part.groupBy("part", "entry", "dim").agg(
            F.sum(F.col("n").cast("decimal(38,0)")).alias("n"),
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
        )
        for r in mean.collect():
            books[r["part"], r["entry"], r["dim"]] = int(r["total"]) // int(r["n"])
    coded = chunks.mapInArrow(_codes(books, to_arrow), out)
    odd = rows.filter(~same).select(
        F.col("ids").alias(id),
        F.col("labels").alias(label),
        F.lit(None).cast("string").alias("code"),
        F.lit(None).cast("bigint").alias("error"),
    )
    return Compressed(coded.unionByName(odd), books)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def with_label_error(rows: DataFrame, label: str = "label", out: str = "label_error") -> DataFrame:
    """Add the ``error`` summed over all rows with the same label, null labels together."""
    sums = rows.groupBy(F.col(label).alias("_l")).agg(F.sum("error").alias(out))
    # Written, so that Spark knows its size when it chooses how to join.
    sums = written(sums, scratch_dir(rows.sparkSession, "label-errors"))
    return rows.join(sums, rows[label].eqNullSafe(sums["_l"]), "left").drop("_l")
