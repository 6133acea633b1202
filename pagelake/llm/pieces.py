"""SentencePiece encoding and decoding as a max-plus scan.

The given models merge neighbouring symbols in the order of their pieces' scores. A
sequence of pieces is what the merges produce exactly if every two neighbours are:
their joined text, merged by itself, gives these two pieces again. So encoding is a
best path: a piece after a piece weighs 0 if the two stand together, minus infinity
if not, and there is one path of weight 0. Weights of paths add up and alternatives
take the maximum, hence chunks of a text have transfer matrices between the states at
their two borders (the piece that reaches the border, and how far it reaches over),
which would combine associatively. Here the matrices of the chunks are worked out in
parallel, but a document's matrices pass one after the other, in one task, from its
first chunk to its last. With the states at its borders known, each chunk is traced
back by itself.

No piece has a space mark after another sign, and signs without a piece stand alone,
so the path is certain at such places (cuts). Between two cuts, all different words of
a batch go through the path search together, a step for each sign; a chunk needs the
states of its borders only up to the first cut and from the last one on.

Documents longer than ``CHUNK`` characters are split into chunks, so one giant
document is many tasks' work. The results are the library's own ids, but for texts
with the mark U+2581, which is spelled in bytes here so that decoding returns it.

Defined cases: null gives null; an empty text has no pieces and decodes to itself;
repeated documents are encoded each; other columns pass through, and a clash with
``out`` raises ``ValueError``; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pagelake.llm.words import bytes_of, mix, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 1 << 16  # characters of one chunk
WORD = 64  # signs of a word in the batched search; longer ones are searched alone
MARK = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NONE = -1  # no piece: a cut


class Vocabulary:
    """Pieces of a model file, with their scores."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes_at = next(i for i in range(n) if sp.is_byte(i))
        plain = [
            i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))
        ]
        self.id = {sp.id_to_piece(i): i for i in plain}
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        self.score = [sp.get_score(i) for i in range(n)]
        self.longest = max(map(len, self.id))
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece has a space mark inside")
        self.raw = [p.replace(MARK, " ").encode() for p in self.piece]
        for b in range(256):
            self.raw[self.bytes_at + b] = bytes([b])
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_size = np.array([len(r) for r in self.raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.signs = np.zeros(0x110000, bool)
        self.signs[[ord(p) for p in self.id if len(p) == 1]] = True
        self.hashes = np.array([_hash(p) for p in self.id], np.uint64)
        self.table = _Table(19)  # few taken slots: most of what is looked up is no piece
        self.table.add(self.hashes, np.array(list(self.id.values()), np.int64))
        # The last merge that makes each piece, as its two parts.
        self.halves: list[tuple[int, int] | None] = [None] * n
        for i in plain:
            if len(self.piece[i]) > 1:
                self.halves[i] = _halves(self.piece[i], self)


def _hash(piece: str) -> np.uint64:
    h = 0
    for c in piece:
        h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return np.uint64(h)


def merged(text: str, vocabulary: Vocabulary, until: int = 1) -> list[int]:
    """Pieces of a short text by merging, best score first, then leftmost, down to
    ``until`` pieces.
    """
    parts = list(text)
    known, score = vocabulary.id, vocabulary.score
    while len(parts) > until:
        best, at = None, -1
        for i in range(len(parts) - 1):
            p = known.get(parts[i] + parts[i + 1])
            if p is not None and (best is None or score[p] > best):
                best, at = score[p], i
        if at < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [known[p] for p in parts]


def _halves(piece: str, vocabulary: Vocabulary) -> tuple[int, int] | None:
    """The two pieces whose merge makes the piece; None if merges do not make it."""
    if any(c not in vocabulary.id for c in piece):
        return None
    parts = merged(piece, vocabulary, 2)
    return (parts[0], parts[1]) if len(parts) == 2 else None


SLICE = 2 << 20  # bytes of text encoded at once


class _Table:
    """Numbers (0 or more) by 64-bit key, in slots that are probed one after another."""

    def __init__(self, bits: int = 12):
        self._empty(bits)

    def _empty(self, bits: int) -> None:
        self.bits, self.n = bits, 0
        self.key = np.zeros(1 << bits, np.uint64)
        self.value = np.full(1 << bits, -1, np.int32)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _BASE) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where there is none."""
        out = np.full(len(keys), -1, np.int64)
        rows, slot = np.arange(len(keys)), self._home(keys)
        while len(rows):
            value = self.value[slot]
            hit = (self.key[slot] == keys[rows]) & (value >= 0)
            out[rows[hit]] = value[hit]
            on = (value >= 0) & ~hit
            rows, slot = rows[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Keys that are not there, each once."""
        if (self.n + len(keys)) * 2 > len(self.key):  # at most half the slots are taken
            have = self.value >= 0
            old = self.key[have], self.value[have]
            self._empty(int(self.n + len(keys)).bit_length() + 1)
            self.add(*old)
        self.n += len(keys)
        rows, slot = np.arange(len(keys)), self._home(keys)
        while len(rows):
            free = np.flatnonzero(self.value[slot] < 0)
            first = free[np.unique(slot[free], return_index=True)[1]]
            self.key[slot[first]] = keys[rows[first]]
            self.value[slot[first]] = values[rows[first]]
            on = np.ones(len(rows), bool)
            on[first] = False
            rows, slot = rows[on], (slot[on] + 1) & ((1 << self.bits) - 1)


class _Known:
    """Ids of words met before, by hash; forgets all when it has ``most`` words."""

    def __init__(self, most: int = 250_000):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.table = _Table()
        self.where, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, h: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        self.table.add(h, len(self.where) + np.arange(len(h)))
        self.where = np.append(self.where, self.size + np.cumsum(count) - count)
        self.count = np.append(self.count, count)
        self.parts.append(ids)
        self.size += len(ids)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash in ``where`` and ``count``, -1 where it is not known."""
        return self.table.find(h)

    def flat(self) -> np.ndarray:
        if len(self.parts) > 1:
            self.parts = [np.concatenate(self.parts)]
        return self.parts[0] if self.parts else np.zeros(0, np.int32)


class Encoder:
    """Searches paths, and remembers which pieces stand together."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pair: dict[int, bool] = {}
        self.good = _Table()
        self.known = _Known()
        self.power = np.ones(self.v.longest + 1, np.uint64)
        np.multiply.accumulate(
            np.full(self.v.longest, _BASE, np.uint64), out=self.power[1:]
        )

    def together(self, a: int, b: int) -> bool:
        key = a << 32 | b
        out = self.pair.get(key)
        if out is None:
            out = self.pair[key] = self._stands(a, b)
        return out

    def _stands(self, a: int, b: int) -> bool:
        """Whether no merge over the border comes before one that made ``a`` or ``b``.

        The later merge next to the border is undone, time after time; what then meets
        at the border would have been merged instead if that is earlier, or as early
        and further left.
        """
        v = self.v
        both = v.piece[a] + v.piece[b]
        if MARK * 2 in both:  # runs of marks share one score
            return merged(both, v) == [a, b]
        if (len(v.piece[a]) > 1 and not v.halves[a]) or (len(v.piece[b]) > 1 and not v.halves[b]):
            return False
        known, score, halves = v.id, v.score, v.halves
        least, even = float("inf"), False
        while True:
            over = known.get(v.piece[a] + v.piece[b])
            if over is not None and (-score[over] < least or even and -score[over] == least):
                return False
            x, y = halves[a], halves[b]
            if x is None and y is None:
                return True
            if y is None or (x is not None and score[a] < score[b]):
                least, even, a = -score[a], False, x[1]
            else:
                least, even, b = -score[b], True, y[0]

    def _together(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 32 | b).view(np.uint64)
        good = self.good.find(key)
        new = good < 0
        if new.any():
            once, at = np.unique(key[new], return_inverse=True)
            found = np.array([self._stands(k >> 32, k & 0xFFFFFFFF) for k in once.tolist()], np.int64)
            self.good.add(once, found)
            good[new] = found[at]
        return good == 1

    def words(self, signs: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as rows of code points: all ids, and each word's count."""
        n, wide = signs.shape
        v, longest = self.v, self.v.longest
        h = np.zeros((n, wide + 1), np.uint64)
        last = np.full((n, wide + 1), -2, np.int32)  # -2: no path reaches here
        back = np.zeros((n, wide + 1), np.int32)
        last[:, 0] = _NONE
        for e in range(1, wide + 1):
            h[:, e] = h[:, e - 1] * _BASE + signs[:, e - 1] + np.uint64(1)
            todo = np.flatnonzero(size >= e)
            for k in range(min(longest, e), 0, -1):
                before = last[todo, e - k]
                ok = before != -2
                rows, before = todo[ok], before[ok]
                if not len(rows):
                    continue
                key = h[rows, e] - h[rows, e - k] * self.power[k]
                piece = v.table.find(key)
                hit = piece >= 0
                rows, before, piece = rows[hit], before[hit], piece[hit]
                fits = before == _NONE
                if not fits.all():
                    fits[~fits] = self._together(before[~fits], piece[~fits])
                rows = rows[fits]
                last[rows, e], back[rows, e] = piece[fits], k
                todo = todo[last[todo, e] == -2]
        count = np.zeros(n, np.int64)
        at, rows = size.copy(), np.arange(n)
        columns = []
        while len(rows):
            columns.append((rows, last[rows, at[rows]]))
            count[rows] += 1
            at[rows] -= back[rows, at[rows]]
            rows = rows[at[rows] > 0]
        end = np.cumsum(count)
        ids = np.zeros(int(end[-1]) if n else 0, np.int32)
        for step, (rows, piece) in enumerate(columns):
            ids[end[rows] - 1 - step] = piece
        return ids, count

    def walk(self, text: str, start: int, stop: int, limit: int, first: int = _NONE):
        """Paths on from ``start``, where piece ``first`` has ended: for each place up
        to ``stop`` the piece that ends there and its length. Pieces start before
        ``limit``.
        """
        last: dict[int, tuple[int, int]] = {start: (first, 0)}
        known, longest = self.v.id, self.v.longest
        for e in range(start + 1, stop + 1):
            for s in range(max(start, e - longest), min(e, limit)):
                if s in last:
                    piece = known.get(text[s:e])
                    if piece is not None:
                        before = last[s][0]
                        if before == _NONE or self.together(before, piece):
                            last[e] = piece, e - s
                            break
        return last

    def path(self, last, start: int, end: int) -> list[int]:
        out = []
        while end > start:
            piece, size = last[end]
            out.append(piece)
            end -= size
        return out[::-1]

    def long_word(self, text: str, step: int = 256) -> list[int]:
        """A word without cuts, by the scan over chunks of ``step`` signs."""
        borders = [*range(0, len(text), step), len(text)]
        parts = [Part(self, text, a, b, [], b == len(text)) for a, b in zip(borders, borders[1:])]
        states = chosen([p.transfer(a == 0) for p, a in zip(parts, borders)])
        out: list[int] = []
        for p, (i, j) in zip(parts, states):
            out += p.trace(i, j)
        return out


State = tuple[int, int]  # how far the piece reaches over the border, and the piece


def chosen(matrices: list[dict[State, set[State]]]) -> list[tuple[State, State]]:
    """Border states of every chunk on the path of weight 0.

    ``matrices[k][i]`` holds the ``j`` with weight 0, all others being minus infinity.
    Products run forward from the text's start; the way back picks the states.
    """
    reach: list[dict[State, State]] = []
    now = {(0, _NONE)}
    for m in matrices:
        step = {j: i for i in sorted(now) if i in m for j in m[i]}
        reach.append(step)
        now = set(step)
    if len(now) != 1:
        raise ValueError("no single path")
    j, out = next(iter(now)), []
    for step in reversed(reach):
        i = step[j]
        out.append((i, j))
        j = i
    return out[::-1]


class Part:
    """The chunk ``text[a:b]``, with what stands around it, and its cuts."""

    def __init__(self, encoder: Encoder, text: str, a: int, b: int, cuts: list[int], ends: bool):
        self.e, self.text, self.a, self.b, self.ends = encoder, text, a, b, ends
        self.cuts = [c for c in cuts if a <= c <= b]
        if ends and (not self.cuts or self.cuts[-1] != b):
            self.cuts.append(b)

    def _exits(self, start: int, first: int) -> dict[State, dict]:
        stop = min(len(self.text), self.b + self.e.v.longest - 1)
        last = self.e.walk(self.text, start, stop, self.b, first)
        out = {}
        for end, (piece, size) in last.items():
            if end >= self.b > end - size and end > start or end == start == self.b:
                out[end - self.b, piece] = last
        return out

    def entries(self, at_start: bool) -> list[State]:
        if at_start or (self.cuts and self.cuts[0] == self.a):
            return [(0, _NONE)]
        longest, out = self.e.v.longest, []
        for s in range(max(0, self.a - longest + 1), self.a):
            for e in range(self.a, min(len(self.text), s + longest) + 1):
                piece = self.e.v.id.get(self.text[s:e])
                if piece is not None:
                    out.append((e - self.a, piece))
        return out

    def transfer(self, at_start: bool = False) -> dict[State, set[State]]:
        ends_on_cut = bool(self.cuts) and self.cuts[-1] == self.b
        out: dict[State, set[State]] = {}
        tail: set[State] | None = None
        if ends_on_cut:
            tail = {(0, _NONE)}
        elif self.cuts:
            tail = set(self._exits(self.cuts[-1], _NONE))
        for over, piece in self.entries(at_start):
            start = self.a + over
            if tail is None:
                out[over, piece] = set(self._exits(start, piece))
                continue
            head = next((c for c in self.cuts if c >= start), None)
            if head is not None and head in self.e.walk(self.text, start, head, head, piece):
                out[over, piece] = tail
        return out

    def trace(self, i: State, j: State, body=None) -> list[int]:
        """The ids of the pieces that start in the chunk. ``body`` encodes the text
        between the first and the last cut.
        """
        start = self.a + i[0]
        if not self.cuts:
            return self.e.path(self._exits(start, i[1])[j], start, self.b + j[0])
        head = next(c for c in self.cuts if c >= start)
        out = self.e.path(self.e.walk(self.text, start, head, head, i[1]), start, head)
        if self.cuts[-1] > head:
            out += body(self.text[head : self.cuts[-1]])
        if self.cuts[-1] < self.b:
            last = self._exits(self.cuts[-1], _NONE)[j]
            out += self.e.path(last, self.cuts[-1], self.b + j[0])
        return out


def marked(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, space for the mark and 0xFFFFFF for the mark itself,
    and each text's bounds.
    """
    data, bounds = bytes_of(texts)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).copy()
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points[points == ord(MARK)] = 0xFFFFFF
    points[points == 32] = ord(MARK)
    return points, np.searchsorted(lead, bounds)


def cut_flags(points: np.ndarray, bounds: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Places before which the path is certain."""
    known = v.signs[np.minimum(points, 0x10FFFF)] & (points < 0x110000)
    cut = ~known
    cut[1:] |= ~known[:-1]
    is_mark = points == ord(MARK)
    cut[1:] |= is_mark[1:] & ~is_mark[:-1]
    cut[bounds[:-1][bounds[:-1] < len(points)]] = True
    return cut


def _spelled(point: int, v: Vocabulary) -> list[int]:
    char = MARK if point == 0xFFFFFF else chr(point)
    return [v.bytes_at + b for b in char.encode()]


def encode_points(points: np.ndarray, bounds: np.ndarray, encoder: Encoder):
    """Ids of all texts behind one another, and each text's number of ids."""
    v = encoder.v
    if not len(points):
        return np.zeros(0, np.int32), np.zeros(len(bounds) - 1, np.int64)
    start = np.flatnonzero(cut_flags(points, bounds, v))
    size = np.diff(np.append(start, len(points)))
    # A hash for each word, to search different words once.
    h = np.zeros(len(start), np.uint64)
    spread = mix(points.astype(np.uint64) + np.uint64(1))
    on = np.arange(len(start))
    for k in range(min(WORD, int(size.max()))):
        on = on[size[on] > k]
        h[on] = h[on] * _BASE + spread[start[on] + k]
    h = mix(h + size.astype(np.uint64))
    long = size > WORD
    h[long] = np.arange(int(long.sum())).astype(np.uint64)
    _, first, inverse = np.unique(h + long * _BASE, return_index=True, return_inverse=True)
    ids: list[np.ndarray] = []
    count = np.zeros(len(first), np.int64)
    where = np.zeros(len(first), np.int64)
    total = 0
    own = size[first]
    single = ~(v.signs[np.minimum(points[start[first]], 0x10FFFF)] & (points[start[first]] < 0x110000))
    for i in np.flatnonzero(single | (own > WORD)):
        a = start[first[i]]
        if single[i]:
            found = _spelled(int(points[a]), v)
        else:
            found = encoder.long_word("".join(map(chr, points[a : a + own[i]].tolist())))
        ids.append(np.array(found, np.int32))
        count[i], where[i], total = len(found), total, total + len(found)
    known = encoder.known
    if len(known.where) > known.most:
        known.clear()
    name = h[first]
    plain = ~single & (own <= WORD)
    new = plain & (known.find(name) < 0)
    low = 0
    for high in (3, 5, 7, 9, 11, 14, 20, 32, WORD):
        pick = np.flatnonzero(new & (own > low) & (own <= high))
        low = high
        for part in np.array_split(pick, max(1, len(pick) // 20_000)):
            if len(part):
                at = start[first[part]][:, None] + np.arange(high)
                signs = points[np.minimum(at, len(points) - 1)].astype(np.uint64)
                known.add(name[part], *encoder.words(signs, own[part]))
    at = known.find(name[plain])
    count[plain], where[plain] = known.count[at], total + known.where[at]
    ids.append(known.flat())
    flat = np.concatenate(ids)
    each = count[inverse]
    to = np.cumsum(each)
    pick = np.repeat(where[inverse] - to + each, each) + np.arange(to[-1])
    text = np.searchsorted(bounds, start, "right") - 1
    return flat[pick], np.bincount(text, each, len(bounds) - 1).astype(np.int64)


_encoders: dict[tuple, Encoder] = {}


def _encoder(v: Vocabulary) -> Encoder:
    """One for each worker process and vocabulary, so that what it learns stays."""
    key = len(v.piece), v.hashes[:64].tobytes()
    if key not in _encoders:
        _encoders[key] = Encoder(v)
    return _encoders[key]


def encode(texts: pa.Array, encoder: Encoder) -> pa.Array:
    """Ids of each text, as one whole."""
    parts = []
    for i, j in slices(texts, SLICE):
        own = [None if t is None else " " + t if t else "" for t in texts[i:j].to_pylist()]
        ids, count = encode_points(*marked(pa.array(own, pa.string())), encoder)
        to = np.zeros(len(count) + 1, np.int32)
        np.cumsum(count, out=to[1:])
        nulls = pa.array([t is None for t in own])
        parts.append(
            pa.ListArray.from_arrays(pa.array(to), pa.array(ids), mask=nulls)
            if nulls.true_count
            else pa.ListArray.from_arrays(pa.array(to), pa.array(ids))
        )
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def decode(ids: pa.Array, v: Vocabulary) -> pa.Array:
    """Texts of the ids; the space that encoding puts in front is taken off."""
    parts = [_decoded(ids[i : i + 200], v) for i in range(0, len(ids), 200)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def _decoded(ids: pa.Array, v: Vocabulary) -> pa.Array:
    """Bytes of all pieces gathered at once; rows that are no UTF-8 one by one."""
    flat = ids.flatten().to_numpy().astype(np.int64)
    count = np.diff(ids.offsets.to_numpy())
    if ids.null_count:
        count = np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, count)
    size = v.raw_size[flat]
    at = np.concatenate([[0], np.cumsum(size)])
    pick = np.repeat(v.raw_start[flat] - at[:-1], size) + np.arange(at[-1])
    data = v.raw_bytes[pick]
    ends = at[np.cumsum(count)]
    # Each row loses its first byte, the space that was put in front.
    first = np.concatenate([[0], ends[:-1]])
    lead = first[ends > first]
    keep = np.ones(len(data), bool)
    keep[lead] = False
    gone = np.concatenate([[0], np.cumsum(ends > first)])
    bounds = np.concatenate([[0], ends]) - gone
    whole = data[keep].tobytes()
    valid = None
    if ids.null_count:
        valid = pa.py_buffer(np.packbits(~ids.is_null().to_numpy(zero_copy_only=False), bitorder="little"))
    out = pa.Array.from_buffers(
        pa.large_string(), len(ids), [valid, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(whole)]
    )
    try:
        out.validate(full=True)
    except pa.ArrowInvalid:
        rows = zip(bounds[:-1], bounds[1:], ids.is_valid().to_pylist())
        out = pa.array([whole[a:b].decode("utf-8", "replace") if ok else None for a, b, ok in rows])
    return out.cast(pa.string())


def _part(encoder: Encoder, row: dict) -> tuple[Part, bool]:
    """A chunk of a document, from the text around it."""
    text = "".join(
        MARK if c == " " else "\x00" if c == MARK else c for c in row["around"]
    )
    points = np.array([ord(c) for c in text], np.uint32)
    flags = cut_flags(points, np.array([0, len(points)]), encoder.v)
    if not row["starts"]:
        flags[0] = False  # only an edge of what is seen
    a = row["before"]
    cuts = np.flatnonzero(flags).tolist()
    return Part(encoder, text, a, a + row["size"], cuts, row["ends"]), row["starts"]


def _transfers(shared):
    def run(batches):
        encoder = _encoder(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                part, first = _part(encoder, row)
                pairs = [(*i, *j) for i, js in part.transfer(first).items() for j in sorted(js)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["key"]] * len(pairs), pa.int64()),
                        pa.array([row["k"]] * len(pairs), pa.int32()),
                        *(pa.array([p[c] for p in pairs], pa.int32()) for c in range(4)),
                    ],
                    ["key", "k", "i0", "i1", "j0", "j1"],
                )

    return run


def _scan(_key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The products of a document's matrices, and the states at each chunk's borders."""
    rows = sorted(zip(*(table[c].to_pylist() for c in ("k", "i0", "i1", "j0", "j1"))))
    n = rows[-1][0] + 1
    matrices: list[dict[State, set[State]]] = [{} for _ in range(n)]
    for k, i0, i1, j0, j1 in rows:
        matrices[k].setdefault((i0, i1), set()).add((j0, j1))
    states = chosen(matrices)
    return pa.table({
        "key": pa.array([table["key"][0].as_py()] * n, pa.int64()),
        "k": pa.array(range(n), pa.int32()),
        **{
            name: pa.array([s[a][b] for s in states], pa.int32())
            for name, a, b in (("i0", 0, 0), ("i1", 0, 1), ("j0", 1, 0), ("j1", 1, 1))
        },
    })


def _traces(shared):
    def run(batches):
        encoder = _encoder(shared.value)

        def body(text: str) -> list[int]:
            points = np.array([0xFFFFFF if c == "\x00" else ord(c) for c in text], np.uint32)
            return encode_points(points, np.array([0, len(points)]), encoder)[0].tolist()

        for batch in batches:
            for row in batch.to_pylist():
                part, _ = _part(encoder, row)
                ids = part.trace((row["i0"], row["i1"]), (row["j0"], row["j1"]), body)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["key"]], pa.int64()),
                        pa.array([row["k"]], pa.int32()),
                        pa.array([ids], pa.list_(pa.int32())),
                    ],
                    ["key", "k", "ids"],
                )

    return run


def encode_giants(
    texts: DataFrame, shared, chunk: int = CHUNK, look: int = 64
) -> DataFrame:
    """``(key, ids)`` of ``(key, text)``, each text dealt out in chunks.

    ``look`` characters on either side of a chunk are seen with it: twice a piece's
    length at least.
    """
    full = F.concat(F.lit(" "), F.col("text"))
    n = F.char_length(full)
    each = texts.select(
        "key",
        full.alias("full"),
        n.alias("n"),
        F.posexplode(F.sequence(F.lit(0), F.ceil(n / chunk).cast("int") - 1)).alias("k", "_"),
    )
    at = F.col("k") * chunk
    before = F.least(at, F.lit(look))
    chunks = each.select(
        "key",
        "k",
        F.substring(F.col("full"), at - before + 1, before + chunk + look).alias("around"),
        before.alias("before"),
        F.least(F.lit(chunk), F.col("n") - at).alias("size"),
        (at == 0).alias("starts"),
        (at + chunk >= F.col("n")).alias("ends"),
    ).repartition("key", "k")
    states = (
        chunks.mapInArrow(
            _transfers(shared), "key bigint, k int, i0 int, i1 int, j0 int, j1 int"
        )
        .groupBy("key")
        .applyInArrow(_scan, "key bigint, k int, i0 int, i1 int, j0 int, j1 int")
    )
    traced = chunks.join(states, ["key", "k"]).mapInArrow(
        _traces(shared), "key bigint, k int, ids array<int>"
    )
    # A document's own chunks, as many as it is long.
    return traced.groupBy("key").agg(
        F.flatten(
            F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])
        ).alias("ids")
    )


def with_ids(
    docs: DataFrame,
    out: str = "ids",
    text: str = "text",
    model: str = MODEL,
    chunk: int = CHUNK,
) -> DataFrame:
    """``docs`` with the array of piece ids of each text."""
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model))  # a model file

    def whole(texts: pa.Array) -> pa.Array:
        return encode(texts, _encoder(shared.value))

    ids = arrow_udf(whole, T.ArrayType(T.IntegerType()))
    giant = F.char_length(F.coalesce(F.col(text), F.lit(""))) >= chunk
    short = docs.filter(~giant).withColumn(out, ids(F.col(text)))
    hard = docs.filter(giant).select(
        F.struct(*docs.columns).alias("row"), F.xxhash64(text).alias("key")
    )
    each = hard.groupBy("key").agg(F.first(f"row.{text}").alias("text"))
    found = encode_giants(each, shared, chunk)
    long = hard.join(found, "key").select("row.*", F.col("ids").alias(out))
    return short.unionByName(long)


def with_text(
    docs: DataFrame, out: str, ids: str = "ids", model: str = MODEL
) -> DataFrame:
    """``docs`` with the text that the ids spell."""
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model))

    def spell(rows: pa.Array) -> pa.Array:
        return decode(rows, shared.value)

    return docs.withColumn(out, arrow_udf(spell, T.StringType())(docs[ids]))
