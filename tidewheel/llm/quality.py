"""Quality classifier: naive Bayes support vectors.

A document's features are indicators of the hashed character n-grams (orders 1 to 4, case kept) that occur in it,
and of how many of its word pairs repeat one word: reserved buckets for a share of at least 1, 1/2, 1/4 and so on.
Each indicator is scaled by its class log-count ratio; a linear hinge-loss model on these is fitted by dual
coordinate descent, and its margin is turned into a probability by a two-parameter sigmoid. The fit uses at most
``most_docs`` labelled documents of each class.

Rows: one for each input row. A null text counts as empty; an empty text has the bias' score. Documents whose
labels are null or contradict each other are not learned from. Without rows of both classes the score is the
known class' share, or 0.5. Other columns are ignored. Long texts are read whole, in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded_ids, codes, kept_columns

BUCKETS = 1 << 16
#: The reserved buckets' number.
SHARES = 10
PIECE = 1 << 20


def indicators(text: str, seen: np.ndarray) -> np.ndarray:
    """The sorted buckets of the n-grams that occur. ``seen``: a cleared table of BUCKETS bools; it is cleared again."""
    for k in range(0, max(1, len(text)), PIECE):
        x = codes(f" {text[k : k + PIECE + 3]} ") * np.uint32(0x9E3779B1)
        h = x
        seen[h >> np.uint32(16)] = True
        for order, mult in ((1, 0x85EBCA77), (2, 0xC2B2AE3D), (3, 0x27D4EB2F)):
            if len(x) <= order:
                break
            nxt = x[order:]
            h = ((h[:-1] ^ (h[:-1] >> np.uint32(15))) + nxt) * np.uint32(mult)
            seen[h >> np.uint32(16)] = True
    words = text.split()
    again = sum(map(eq, words, words[1:]))
    seen[-SHARES:] = again > 0 and (again << np.arange(SHARES)) >= len(words) - 1
    out = np.flatnonzero(seen)
    seen[out] = False
    return out


def descend(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights times ``values``, and bias, of the L2-regularised hinge loss over rows of indicators scaled by ``values``: dual coordinate descent in shuffled order."""
    square = values * values
    scaled, bias = np.zeros(len(values)), 0.0
    norm = np.array([square[r].sum() + 1.0 for r in rows])
    dual = np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            r = rows[i]
            slope = y[i] * (scaled[r].sum() + bias) - 1.0
            new = min(max(dual[i] - slope / norm[i], 0.0), cost)
            step = (new - dual[i]) * y[i]
            if step:
                scaled[r] += step * square[r]
                bias += step
                moved = max(moved, abs(step))
                dual[i] = new
        if moved < 1e-4 * cost:
            break
    return scaled, bias


def sigmoid_fit(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of P(1 | margin), by Newton steps on smoothed targets."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    theta = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones_like(margin)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (t - p))
        theta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    intercept: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        seen = np.zeros(BUCKETS, bool)
        margin = np.array([self.weights[indicators(t or "", seen)].sum() + self.bias for t in texts], float)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.intercept, -30, 30)))


def train(rows: list[np.ndarray], y: np.ndarray, cost: float = 0.01, epochs: int = 20, alpha: float = 1.0, seed: int = 0) -> Model:
    """Fits a model to indicator rows and labels 0/1. The sigmoid is fitted to margins of models that have not seen the row (two folds)."""
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Model(np.zeros(BUCKETS), 0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))

    def one(idx: np.ndarray) -> tuple[np.ndarray, float]:
        own, sign = [rows[i] for i in idx], np.where(y[idx] > 0, 1.0, -1.0)
        held = np.full((2, BUCKETS), alpha)
        for r, s in zip(own, sign, strict=True):
            held[int(s > 0), r] += 1
        n0, n1 = held
        return descend(own, np.log(n1 / n1.sum()) - np.log(n0 / n0.sum()), sign, cost, epochs, seed)

    fold = np.random.default_rng(seed).permutation(len(y)) % 2
    margin, held = np.zeros(len(y)), np.zeros(len(y), bool)
    for k in (0, 1):
        if len(set(y[fold == k].tolist())) == 2:
            w, bias = one(np.flatnonzero(fold == k))
            for i in np.flatnonzero(fold != k):
                margin[i], held[i] = w[rows[i]].sum() + bias, True
    w, bias = one(np.arange(len(y)))
    if not held.any():
        margin, held = np.array([w[r].sum() + bias for r in rows]), np.ones(len(y), bool)
    slope, intercept = sigmoid_fit(margin[held], y[held])
    return Model(w, bias, slope, intercept)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most_docs: int) -> DataFrame:
    """(text, y) of at most about ``most_docs`` documents of each class, each labelled without contradiction."""
    clean = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("_y"))
    ids = bounded_ids(clean.where("y = _y").select("doc_id", "y"), "y", most_docs)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "y")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_docs: int = 3000, seed: int = 0) -> Model:
    """Learns from documents (doc_id, text) and labels (doc_id, ``label``). The driver gets ``most_docs`` rows of bucket numbers for each class."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, bool)
        for batch in batches:
            rows = [indicators(t or "", seen).astype(np.uint16).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1).cast(pa.int32())], names=["f", "y"])

    got = labelled_sample(docs, labels, label, most_docs).mapInArrow(features, "f binary, y int").collect()
    got = sorted((bytes(r["f"]), r["y"]) for r in got)  # whatever order the tasks ended in
    rows = [np.frombuffer(f, np.uint16) for f, _ in got]
    return train(rows, np.array([y for _, y in got], int), seed=seed)


def predict(docs: DataFrame, model: Model, threshold: float = 0.3, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``keep`` columns, score, predicted) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own, names = kept_columns("doc_id", "text", keep, ("score", "predicted"))
    schema = docs.select(*names).schema.add("score", "double").add("predicted", "integer")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            score = m.score(batch.column(1).to_pylist())
            cols = [batch.column(own.index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], names=[*names, "score", "predicted"])

    return docs.select(*own).mapInArrow(apply, schema)
