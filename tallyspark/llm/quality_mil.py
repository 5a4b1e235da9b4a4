"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes (the whole text, the last one
shorter).  Each passage is encoded (character classes, word lengths, repeated and
distinct words, word endings), passed through a learned layer, and weighted by
gated attention ``w . (tanh(V h) * sigmoid(U h))``; the weighted mean is scored.
Labels belong to documents only.  Training takes at most ``most_labelled``
labelled documents (smallest id hash); their passage vectors, a few numbers
each, reach the driver.

Defined cases: a null or empty text is one empty passage and is scored as such;
every row is scored, other columns stay with ``score_column``; null labels and
null ids are not training rows; without two classes every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts

PASSAGE = 512
MOST_LABELLED = 20_000
#: Passages of a labelled document that training sees: all up to this many, evenly spread beyond (scoring reads all).
MOST_TRAINED = 64
HIDDEN, GATE, EPOCHS, RATE, SEED = 16, 8, 60, 0.01, 7
GOOD_AT = 0.7

_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_CLASS = np.full(256, 8, "u1")  # other
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                             b" \t\x0b\x0c\r", b"\n", b".,;:!?", b"#*$%&|<>")):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 7
_CLASSES = 9
_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.random.default_rng(11).integers(1, 2 ** 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WIDTH = _CLASSES + 9


def encode_passages(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors of the texts, and how many passages each text has."""
    raws = [t.encode("utf-8", "replace") or b" " for t in batch]
    sizes = np.array([len(r) for r in raws])
    counts = -(-sizes // PASSAGE)
    b = np.frombuffer(b"".join(raws), "u1")
    doc_at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    within = np.arange(counts.sum()) - np.repeat(first, counts)
    start = np.repeat(doc_at, counts) + within * PASSAGE
    length = np.minimum(PASSAGE, np.repeat(doc_at + sizes, counts) - start)
    n = len(start)
    owner = np.repeat(np.arange(n), length)
    share = np.bincount(owner * _CLASSES + _CLASS[b], minlength=n * _CLASSES).reshape(n, _CLASSES) / length[:, None]

    ink = ~_WHITE[b]
    edge = np.ones(len(b), bool)
    edge[1:] = ~ink[:-1]
    edge[start] = True  # a passage boundary cuts a word
    begin = np.flatnonzero(ink & edge)
    out = np.zeros((n, WIDTH), "f4")
    out[:, :_CLASSES] = share
    if len(begin):
        word_of = np.cumsum(ink & edge) - 1
        inked = np.flatnonzero(ink)
        place = (inked - begin[word_of[inked]]) & 63
        size = np.bincount(word_of[inked], minlength=len(begin))
        value = (b[inked].astype("u8") + np.uint64(1)) * _POWERS[place]
        at = np.concatenate(([0], np.cumsum(size)[:-1]))
        hashed = np.add.reduceat(value, at) * _MIX
        passage = owner[begin]
        words = np.bincount(passage, minlength=n)
        some = np.maximum(words, 1)
        same = np.concatenate(([False], (hashed[1:] == hashed[:-1]) & (passage[1:] == passage[:-1])))
        order = np.lexsort((hashed, passage))
        new = np.concatenate(([True], (np.diff(passage[order]) != 0) | (hashed[order][1:] != hashed[order][:-1])))
        last = _CLASS[b[begin + size - 1]]
        per = lambda x: np.bincount(passage, weights=x, minlength=n) / some
        out[:, _CLASSES] = np.log1p(words)
        out[:, _CLASSES + 1] = per(size) / 8
        out[:, _CLASSES + 2] = per(same)
        out[:, _CLASSES + 3] = np.bincount(passage[order], weights=new, minlength=n) / some
        out[:, _CLASSES + 4] = per(last == 6)
        out[:, _CLASSES + 5] = per(last == 5)
        out[:, _CLASSES + 6] = per(size == 1)
        out[:, _CLASSES + 7] = per(_CLASS[b[begin]] == 1)
    out[:, _CLASSES + 8] = np.log(np.repeat(sizes, counts))
    return out, counts


def _segments(counts):
    return np.concatenate(([0], np.cumsum(counts)[:-1]))


@dataclass
class QualityModel:
    """Weights of the net; ``mean`` and ``scale`` standardise the passage vectors."""

    mean: np.ndarray
    scale: np.ndarray
    net: list[np.ndarray] | None  # A, a (layer), V, U (gates), w (attention), c (score weights and constant)

    def forward(self, x: np.ndarray, counts: np.ndarray):
        layer, bias, v, u, w, c = self.net
        at = _segments(counts)
        h = np.tanh(x @ layer + bias)
        t, s = np.tanh(h @ v), 1 / (1 + np.exp(-(h @ u)))
        e = (t * s) @ w
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), counts))
        a = e / np.repeat(np.add.reduceat(e, at), counts)
        z = np.add.reduceat(a[:, None] * h, at)
        p = 1 / (1 + np.exp(-np.clip(z @ c[:-1] + c[-1], -30, 30)))
        return p, (at, h, t, s, a, z)

    def scores(self, batch: list[str]) -> np.ndarray:
        if self.net is None:
            return np.full(len(batch), 0.5)
        x, counts = encode_passages(batch)
        return self.forward((x - self.mean) / self.scale, counts)[0]


def train(bags: list[np.ndarray], y: np.ndarray) -> QualityModel:
    """The net by Adam over mini-batches of bags (back-propagation written out)."""
    rows = np.concatenate(bags)
    model = QualityModel(rows.mean(0), rows.std(0) + 1e-3, None)
    if len(set(y.tolist())) < 2:
        return model
    rng = np.random.default_rng(SEED)
    d = rows.shape[1]
    g = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    model.net = [g(d, HIDDEN), np.zeros(HIDDEN), g(HIDDEN, GATE), g(HIDDEN, GATE), g(GATE), np.zeros(HIDDEN + 1)]
    moment, square, step = [0.0] * 6, [0.0] * 6, 0
    bags = [(b - model.mean) / model.scale for b in bags]
    weight = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean()) ** 0.5
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(len(bags)), max(1, len(bags) // 256)):
            x, counts = np.concatenate([bags[i] for i in part]), np.array([len(bags[i]) for i in part])
            layer, bias, v, u, w, c = model.net
            p, (at, h, t, s, a, z) = model.forward(x, counts)
            dp = (p - y[part]) * weight[part] / len(part)
            dc = np.concatenate((z.T @ dp, [dp.sum()]))
            dz = np.repeat(np.outer(dp, c[:-1]), counts, axis=0)
            da = (dz * h).sum(1)
            de = a * (da - np.repeat(np.add.reduceat(a * da, at), counts))
            dw, dg = (t * s).T @ de, np.outer(de, w)
            dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
            dh = a[:, None] * dz + dt @ v.T + ds @ u.T
            dx = dh * (1 - h * h)
            step += 1
            for k, grad in enumerate((x.T @ dx, dx.sum(0), h.T @ dt, h.T @ ds, dw, dc)):
                grad = grad + 1e-4 * model.net[k]
                moment[k] = 0.9 * moment[k] + 0.1 * grad
                square[k] = 0.999 * square[k] + 0.001 * grad * grad
                model.net[k] = model.net[k] - RATE * (moment[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_labelled: int = MOST_LABELLED,
        id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    ids = (labels.select(labels[id_col].cast("long").alias("l_id"), labels[label].cast("int").alias("y"))
           .where("l_id is not null and y in (0, 1)").groupBy("l_id").agg(F.max("y").alias("y"))
           .orderBy(F.xxhash64("l_id"), "l_id").limit(most_labelled))
    t = texts(docs, id_col, text_col)

    def encode(frames):
        for frame in frames:
            x, counts = encode_passages(frame["text"].tolist())
            for at, n, doc, y in zip(_segments(counts), counts, frame["doc_id"], frame["y"]):
                own = x[at:at + n]
                if n > MOST_TRAINED:
                    own = own[np.linspace(0, n - 1, MOST_TRAINED).astype(int)]
                yield pd.DataFrame({"doc_id": [doc], "y": [y], "x": [np.ascontiguousarray(own).tobytes()]})

    rows = (t.join(F.broadcast(ids), t["doc_id"] == ids["l_id"])  # bounded by most_labelled
            .select("doc_id", "text", "y").mapInPandas(encode, "doc_id long, y int, x binary").collect())
    if not rows:
        return QualityModel(np.zeros(WIDTH), np.ones(WIDTH), None)
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
    return train([np.frombuffer(r["x"], "f4").reshape(-1, WIDTH).astype("f8") for r in rows],
                 np.array([r["y"] for r in rows], "f8"))


def score_column(spark, model: QualityModel, text: Column) -> Column:
    """The quality score (0 to 1) of a text column."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def quality(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            parts = [held.value.scores(batch.iloc[a:a + 500].tolist()) for a in range(0, len(batch), 500)]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="f8")

    return quality(F.coalesce(text.cast("string"), F.lit("")))
