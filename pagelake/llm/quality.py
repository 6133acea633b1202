"""Quality of a text by a byte-level convolutional network in numpy.

Bytes are embedded, filters run over overlapping chunks that cover the whole text
to its last byte, each filter keeps its largest answer, and a logistic layer makes
one probability of them. Training follows the chunks that gave the largest answers
only, so a step costs little more than reading the text.

Defined cases: a null or empty text is one chunk of padding and gets that chunk's
score; repeated documents get equal scores; other columns pass through, and a clash
with ``out`` raises ``ValueError``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pagelake.llm.labels import labelled_sample
from pagelake.llm.words import bytes_of, slices

PER_CLASS = 1200  # rows of each label that the network is fitted on, at most
WIDTH, STRIDE, DIM, FILTERS = 16, 8, 8, 24
EPOCHS, BATCH, RATE, DECAY, SEED = 12, 32, 0.01, 1e-4, 7
_SLICE = 1 << 18
_PAD = 256


def _chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each chunk's bytes, and the first chunk of each text."""
    data, bounds = bytes_of(texts)
    size = np.diff(bounds)
    count = np.maximum(1, -(-(size - WIDTH) // STRIDE) + 1)
    first = np.zeros(len(size) + 1, np.int64)
    np.cumsum(count, out=first[1:])
    row = np.repeat(np.arange(len(size)), count)
    start = bounds[row] + (np.arange(first[-1]) - first[row]) * STRIDE
    at = start[:, None] + np.arange(WIDTH)
    padded = np.append(data.astype(np.int16), np.int16(_PAD))
    return padded[np.where(at < bounds[row + 1][:, None], at, len(data))], first[:-1]


class ByteNetwork:
    """Weights ``embed``, ``conv``, ``shift``, ``out`` and ``bias``."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.p = {
            "embed": rng.normal(0, 0.3, (257, DIM)),
            "conv": rng.normal(0, (WIDTH * DIM) ** -0.5, (WIDTH * DIM, FILTERS)),
            "shift": np.zeros(FILTERS),
            "out": rng.normal(0, 0.1, FILTERS),
            "bias": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _pooled(self, chunks: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.p
        x = p["embed"][chunks].reshape(len(chunks), -1)
        answers = x @ p["conv"] + p["shift"]
        return answers, np.maximum.reduceat(answers, first, axis=0)

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = []
        for i, j in slices(texts, _SLICE):
            top = self._long(texts[i:j]) if j == i + 1 else self._pooled(*_chunks(texts[i:j]))[1]
            z = np.maximum(top, 0) @ self.p["out"] + self.p["bias"]
            out.append(1 / (1 + np.exp(-z.astype(np.float64))))
        return np.concatenate(out) if out else np.zeros(0)

    def _long(self, text: pa.Array) -> np.ndarray:
        """The filters' largest answers over one text, a part at a time."""
        chunks, _ = _chunks(text)
        step = _SLICE // STRIDE
        parts = [
            self._pooled(chunks[k : k + step], np.zeros(1, np.int64))[1]
            for k in range(0, len(chunks), step)
        ]
        return np.max(parts, axis=0)

    def _gradient(self, texts: pa.Array, label: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        chunks, first = _chunks(texts)
        answers, top = self._pooled(chunks, first)
        n = len(first)
        ends = np.append(first[1:], len(chunks))
        best = np.array([answers[a:b].argmax(0) + a for a, b in zip(first, ends)])
        hidden = np.maximum(top, 0)
        d = (1 / (1 + np.exp(-(hidden @ p["out"] + p["bias"]))) - label) / n
        d_top = d[:, None] * p["out"] * (top > 0)
        at = chunks[best]  # text, filter, byte
        x = p["embed"][at].reshape(n, FILTERS, -1)
        d_x = np.einsum("nf,kf->nfk", d_top, p["conv"]).reshape(n, FILTERS, WIDTH, DIM)
        d_embed = np.zeros_like(p["embed"])
        np.add.at(d_embed, at, d_x)
        return {
            "embed": d_embed,
            "conv": np.einsum("nf,nfk->kf", d_top, x),
            "shift": d_top.sum(0),
            "out": hidden.T @ d,
            "bias": d.sum(keepdims=True),
        }

    def fit(self, texts: pa.Array, label: np.ndarray, epochs: int = EPOCHS) -> None:
        """Adam over shuffled batches, each label weighing the same in the end by
        the shift of the bias to the labels' share.
        """
        rng = np.random.default_rng(SEED)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(label))
            rate = RATE * (1 - epoch / epochs)
            for i in range(0, len(order), BATCH):
                pick, step = order[i : i + BATCH], step + 1
                g = self._gradient(texts.take(pa.array(pick)), label[pick])
                for k, v in self.p.items():
                    own = g[k] + DECAY * v
                    m[k] = 0.9 * m[k] + 0.1 * own
                    s[k] = 0.99 * s[k] + 0.01 * own * own
                    up, root = m[k] / (1 - 0.9**step), np.sqrt(s[k] / (1 - 0.99**step))
                    v -= (rate * up / (root + 1e-6)).astype(np.float32)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_class: int = PER_CLASS,
    id: str = "doc_id",
    text: str = "text",
) -> ByteNetwork:
    """A network fitted on at most ``2 * per_class`` rows outside the held-out fold."""
    rows = labelled_sample(docs, labels, label, per_class, id, text)
    table = rows.orderBy("label", "text").toArrow()
    net = ByteNetwork()
    y = table["label"].to_numpy().astype(np.float32)
    if len(y):
        net.fit(table["text"].combine_chunks(), y)
    return net


def with_score(
    docs: DataFrame, net: ByteNetwork, out: str = "score", text: str = "text"
) -> DataFrame:
    """``docs`` with the probability of label 1."""
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    shared = docs.sparkSession.sparkContext.broadcast(net)  # fixed size: the weights

    def score(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts))

    return docs.withColumn(out, arrow_udf(score, T.DoubleType())(docs[text]))
