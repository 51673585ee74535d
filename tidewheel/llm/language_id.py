"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts hashed 1- to 3-grams of lower-cased code points for each language over a bounded sample
(``most_docs`` documents of each language). The log-probability matrix, BUCKETS x languages, goes to the
executors as a broadcast; a batch is scored by gathering the matrix' rows for its n-grams and summing them by
document (a sparse count matrix times the log-probabilities).

Rows: one for each input row, repeated and tied rows included. A null or letterless text gives ``und`` with
score 0; an empty table or one without labelled rows gives ``und`` everywhere. Null languages are not learned
from. Other columns are ignored, so their names can't clash. Long texts are scored whole, in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded_ids, chunks, codes, kept_columns

BUCKETS = 1 << 16
#: N-grams of evidence beyond which a score no longer hardens.
EVIDENCE = 200
PIECE = 1 << 18


def buckets(x: np.ndarray) -> np.ndarray:
    """Buckets of the 1- to 3-grams (rows: order) that begin at each code point but the last two."""
    x = x * np.uint32(0x9E3779B1)
    a, b = x[1:-1] * np.uint32(0x85EBCA77), x[2:] * np.uint32(0xC2B2AE3D)
    one = x[:-2]
    two = (one ^ (a >> np.uint32(7))) * np.uint32(0x27D4EB2F) + a
    three = (two ^ (b >> np.uint32(9))) * np.uint32(0x165667B1) + b
    return np.stack([v >> np.uint32(16) for v in (one, two, three)])


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all 1- to 3-grams (rows: order; columns: place), and where each text starts. Texts are framed by spaces."""
    own = [codes(f" {t.lower()}  ") for t in texts]
    ends = np.cumsum([len(x) for x in own])
    return buckets(np.concatenate(own)), np.concatenate([[0], ends[:-1]])


def lettered(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray  # buckets x languages

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihoods (texts x languages) and the number of n-grams of each text."""
        out, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for i, t in enumerate(texts):
            n[i] = 3 * (len(t) + 1)
        for lo, hi in chunks(texts, PIECE):
            if hi - lo == 1 and len(texts[lo]) > PIECE:  # one long text, framed as a whole: n-grams by where they begin
                x = codes(f" {texts[lo].lower()}  ")
                for k in range(0, len(x) - 2, PIECE):
                    for row in buckets(x[k : k + PIECE + 2]):
                        out[lo] += self.logp[row].sum(0, dtype=float)
            else:
                out[lo:hi] = self._sum(texts[lo:hi])
        return out, n

    def _sum(self, texts: list[str]) -> np.ndarray:
        ids, starts = grams(texts)
        ends = np.concatenate([starts[1:], [ids.shape[1] + 2]]) - 2
        total = self.logp[ids[0]]
        total += self.logp[ids[1]]
        total += self.logp[ids[2]]
        bounds = np.stack([starts, ends], 1).ravel()
        bounds = np.minimum(bounds, len(total) - 1)
        sums = np.add.reduceat(total, bounds, axis=0)[::2].astype(float)
        if ends[-1] >= len(total):  # the last stretch reaches the end
            sums[-1] = total[starts[-1] :].sum(0)
        return sums

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        real = [t or "" for t in texts]
        known = np.array([lettered(t) for t in texts], bool)
        if not self.langs or not real:
            return ["und"] * len(real), np.zeros(len(real))
        sums, n = self.scores(real)
        tempered = sums * np.minimum(1.0, EVIDENCE / np.maximum(n, 1))[:, None]
        p = np.exp(tempered - tempered.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        return [self.langs[b] if k else "und" for b, k in zip(best, known, strict=True)], np.where(known, p.max(1), 0.0)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", most_docs: int = 3000, alpha: float = 0.1) -> Model:
    """Learns from (doc_id, text, lang) rows; ``most_docs`` bounds the documents learned from for each language.

    What reaches the driver is a few partial count tables of BUCKETS x languages; languages are a bounded set (some
    thousands in all the world), and none is left out.
    """
    rows = labelled.select("doc_id", F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null and text is not null")
    sample = bounded_ids(rows, "lang", most_docs).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            by: dict[str, list[str]] = {}
            for t, g in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by.setdefault(g, []).append(t)
            for g, texts in by.items():
                for lo, hi in chunks(texts, PIECE):
                    ids, starts = grams(texts[lo:hi])
                    keep = np.ones(ids.shape[1], bool)
                    keep[(starts[1:] - 1)] = keep[(starts[1:] - 2)] = False
                    own = tables.setdefault(g, np.zeros(BUCKETS, np.int64))
                    for row in ids:
                        own += np.bincount(row[keep], minlength=BUCKETS)
        yield pa.RecordBatch.from_pydict({"lang": list(tables), "counts": [x.tobytes() for x in tables.values()]}, pa.schema([("lang", pa.string()), ("counts", pa.binary())]))

    parts = sample.repartition(8).mapInArrow(count, "lang string, counts binary").collect()
    total: dict[str, np.ndarray] = {}
    for r in parts:
        total[r["lang"]] = total.get(r["lang"], 0) + np.frombuffer(r["counts"], np.int64)
    langs = sorted(total)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32))
    counts = np.stack([total[g] for g in langs], 1) + alpha
    return Model(langs, np.log(counts / counts.sum(0)).astype(np.float32))


def predict(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(``id_col``, ``keep`` columns, lang_pred, score) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own, names = kept_columns(id_col, text, keep, ("lang_pred", "score"))
    schema = docs.select(*names).schema.add("lang_pred", "string").add("score", "double")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            langs, score = m.predict(batch.column(own.index(text)).to_pylist())
            cols = [batch.column(own.index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(langs, pa.string()), pa.array(score, pa.float64())], names=[*names, "lang_pred", "score"])

    return docs.select(*own).mapInArrow(apply, schema)
