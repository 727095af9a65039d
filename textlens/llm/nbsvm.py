"""Quality classifier: naive Bayes support vectors (operator 8).

Indicators of word n-grams and of word-shape n-grams are scaled by the log
ratio of their counts in the two classes (counted over every labelled
training row), then a linear hinge-loss model is fitted by dual coordinate
descent on a bounded sample of those rows, and a logistic curve turns margins
into scores between 0 and 1 on a second bounded sample.

Only the text is looked at.  Features are hashed into ``DIM`` slots, so the
model has a fixed size (a few hundred KB) and may be sent to every task.

Defined results: a null or empty text has no features and scores what the
bias gives; labels other than 0 and 1, null ids and ids with both labels teach
nothing; without training rows of both classes every score is the share of
label 1 (0.5 without rows); an empty table gives an empty result; rows that
repeat are scored each; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from textlens.llm import tokens as T
from textlens.llm.common import cut_lineage

DIM = 1 << 16
#: Bounds of the two samples of labelled rows (the only sampling; counts use all rows).
FIT_ROWS, CALIBRATE_ROWS = 5_000, 2_500

# Byte classes of a word's shape: letters, capitals and digits are merged, other signs stand for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = ord("a"), ord("A"), ord("0"), ord("a")


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every indicator that is set, each once, in order of documents."""
    w = T.split(data, at)
    if not w.n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc, word = w.doc(), w.hashes()
    cls = _SHAPE[data]
    # a run of one class within a word counts once
    keep = w.inside.copy()
    keep[1:] &= w.starts_mask[1:] | (cls[1:] != cls[:-1])
    pos = np.concatenate([[0], np.cumsum(keep)])
    shape = T.span_hash(cls[keep].astype(np.uint64) + np.uint64(1), pos[w.first], pos[w.last])
    again = np.zeros(w.n, bool)
    again[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    shape[again] = np.uint64(7)
    c = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
    two, three = doc[1:] == doc[:-1], doc[2:] == doc[:-2]
    out = [(doc, T.mix(word ^ c[0])), (doc, T.mix(shape ^ c[1])),
           (doc[1:][two], T.mix(shape[1:] * c[0] + shape[:-1] * c[2])[two]),
           (doc[2:][three], T.mix(shape[2:] * c[0] + shape[1:-1] * c[2] + shape[:-2] * c[1])[three])]
    kind = np.int32 if len(at) <= 1 << 15 else np.int64
    both = np.unique(np.concatenate([d.astype(kind) * kind(DIM) + (f >> np.uint64(48)).astype(kind) for d, f in out]))
    return both // DIM, both % DIM


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, at in T.chunks(batch):
            d, f = features(data, at)
            f, cut = f.astype(np.uint16), np.searchsorted(d, np.arange(len(at)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([f[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                ["doc_id", "features"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, rows = np.zeros((2, DIM + 1), np.int64), 0
    for batch in batches:
        y = T.longs(batch, "y")
        for label, f in zip(y, batch.column(1)):
            n[label, np.frombuffer(f.as_py(), np.uint16)] += 1
            n[label, DIM] += 1
            rows += 1
    if rows:
        y, f = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(f), pa.array(n[y, f])], ["y", "feature", "n"])


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        d, f = features(data, at)
        return np.bincount(d, self.weights[f], len(at) - 1) + self.bias

    def scores(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def dual_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: float = 1.0,
                 epochs: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """Hinge loss with L2 penalty, by coordinate descent on the dual; y is -1 or 1.

    Each row is brought to unit length; a constant 1 stands for the bias.
    """
    w, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    size = np.array([float(np.sqrt(scale[f] @ scale[f])) or 1.0 for f in rows])
    # a row's squared length: 1 for the indicators (0 without any) and 1 for the constant
    q = 1.0 + np.array([float(scale[f].any()) for f in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            f = rows[i]
            x = scale[f] / size[i]
            g = y[i] * (w[f] @ x + bias) - 1
            new = min(max(alpha[i] - g / q[i], 0.0), cost)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[f] += step * x
                bias += step
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    return w, bias


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton's method, with smoothed targets."""
    pos = y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (len(y) - pos + 2))
    x, b = np.stack([m, np.ones_like(m)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - t))
        b -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", fit_rows: int = FIT_ROWS, calibrate_rows: int = CALIBRATE_ROWS,
        smoothing: float = 1.0) -> Model:
    """Fit on the labelled rows of ``docs``; the caller leaves out what must not teach."""
    taught = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("y"))
              .filter("doc_id is not null and y in (0, 1)").groupBy("doc_id")
              .agg(F.min("y").cast("long").alias("y"), F.max("y").alias("z")).filter("y = z").drop("z"))
    packed = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
              .filter("doc_id is not null").mapInArrow(_packed, "doc_id long, features binary"))
    rows = cut_lineage(packed.join(taught, "doc_id"), "nbsvm")
    counts = (rows.select("y", "features").mapInArrow(_counted, "y long, feature long, n long")
              .groupBy("y", "feature").agg(F.sum("n").alias("n")).toArrow())
    n = np.zeros((2, DIM + 1))
    n[counts["y"].to_numpy(), counts["feature"].to_numpy()] = counts["n"].to_numpy()
    total = n[:, DIM]
    if not total.all():
        share = 0.5 if not total.any() else float(total[1] / total.sum())
        logit = float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1)))
        return Model(np.zeros(DIM), 0.0, 0.0, logit)
    p, q = n[1, :DIM] + smoothing, n[0, :DIM] + smoothing
    scale = np.log((p / p.sum()) / (q / q.sum()))
    # a hash of the id picks the sample; tasks send little more than the bound, however many there are
    bound, parts = fit_rows + calibrate_rows, 1 << 30
    h = F.xxhash64("doc_id")
    some = (rows.filter(F.pmod(h, F.lit(parts)) <= int(min(1.0, 1.2 * bound / total.sum() + 1e-6) * parts))
            .orderBy(h, "doc_id", "features").limit(bound).select("features", "y").toArrow())
    sets = [np.frombuffer(f.as_buffer(), np.uint16) for f in some["features"]]
    y = np.where(some["y"].to_numpy() > 0, 1.0, -1.0)
    k = min(fit_rows, max(1, len(sets) * 2 // 3))
    w, bias = dual_descent(sets[:k], y[:k], scale)

    def unit(f: np.ndarray) -> float:
        return float(np.sqrt(scale[f] @ scale[f])) or 1.0

    rest = slice(k, None) if len(sets) - k >= 20 and len(set(y[k:])) == 2 else slice(0, None)
    m = np.array([(w[f] @ scale[f]) / unit(f) + bias for f in sets[rest]])
    slope, shift = _logistic(m, (y[rest] > 0).astype(float))
    return _Scaled(w, bias, slope, shift, scale)


@dataclass
class _Scaled(Model):
    """Margins over unit-length rows of scaled indicators."""

    scale: np.ndarray

    def margins(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        d, f = features(data, at)
        n = len(at) - 1
        size = np.sqrt(np.bincount(d, self.scale[f] ** 2, n))
        return np.bincount(d, self.weights[f] * self.scale[f], n) / np.where(size > 0, size, 1) + self.bias


def score(docs: DataFrame, model: Model, *, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score (a column of that name is replaced)."""
    docs = docs.drop(out_col)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in T.chunks(batch, text_col):
                s = model.scores(model.margins(data, at))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s)], [*part.schema.names, out_col])

    return docs.mapInArrow(scored, StructType([*docs.schema.fields, StructField(out_col, DoubleType())]))
