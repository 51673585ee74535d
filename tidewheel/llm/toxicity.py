"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, takes compatibility forms and accents off, maps Cyrillic and Greek look-alikes to Latin
letters and, inside words of which a third are letters, digits and signs to the letters they stand for, and joins
words that are spelled letter by letter. The lexicon holds beginnings of ``SHORTEST`` letters or more, and shorter
words whole, with a closing space; their log-odds weights are learned from labelled documents (or given); exception phrases, learned or given, take back the hits inside them. A
document's score is a logistic function of the total weight of its different words and of that weight for its length.

Rows: one for each input row. A null text counts as empty; empty texts have the score of no hit. Null or
contradicting labels are not learned from; without labelled rows of both classes the lexicon is empty and the
score is the known class' share, or 0. Other columns are ignored. Texts are read whole.

Entries match only where a word begins. In scripts that put no spaces between words (Chinese, Japanese, Thai) a
run of letters counts as one word, so a term inside it is neither learned nor found unless the run begins with it.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import kept_columns, stored
from tidewheel.llm.quality import labelled_sample

#: Look-alikes of Latin letters in Cyrillic and Greek.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁһӏьвнкмтαεορυχικντβημ", "aeopcyxijsdhlbbhkmtaeopuxikvtbnm", strict=True))
#: Digits and signs that stand for letters inside words.
LEET = dict(zip("013457@$", "oieastas", strict=True))
_GLYPHS = str.maketrans(HOMOGLYPHS)
_LEET = str.maketrans(LEET)
_MIXED = re.compile(r"[0-9@$]*[^\W\d_][\w@$]*[0-9@$]\w*|[0-9@$]+[^\W\d_][\w@$]*")
_ACCENT = re.compile("[\u0300-\u036f]+")
_GAP = re.compile(r"[\W_]+")
_SPELLED = re.compile(r"(?<= )(?:\w ){3,}\w(?= )")
SHORTEST, LONGEST = 4, 12
#: How far from chance an entry's counts must be (twice the log-likelihood ratio); equal texts count once.
SURPRISE = 20.0
LEAST_WEIGHT = 2.0


def _leet(m: re.Match) -> str:
    w = m.group()
    return w.translate(_LEET) if sum(c.isalpha() for c in w) * 3 >= len(w) else w


def fold(text: str | None) -> str:
    """Words of ``text``, folded, each after one space, and a space at the end."""
    t = (text or "").lower()
    if not t.isascii():
        t = _ACCENT.sub("", unicodedata.normalize("NFKD", t)).translate(_GLYPHS)
    if _MIXED.search(t):
        t = _MIXED.sub(_leet, t)
    return _SPELLED.sub(lambda m: m[0].replace(" ", ""), f" {_GAP.sub(' ', t).strip()} ")


@dataclass
class Model:
    lexicon: dict[str, float]
    exceptions: dict[str, list[str]] = field(default_factory=dict)
    theta: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        """Entries match at a word's beginning, with a closing space the whole word; exception phrases match whole and outweigh what they hold."""
        a = ahocorasick.Automaton()
        for w, weight in self.lexicon.items():
            a.add_word(f" {w}", (len(w) + 1, weight, False))
        for phrases in self.exceptions.values():
            for p in phrases:
                a.add_word(f" {p} ", (len(p) + 2, 0.0, True))
        a.make_automaton()
        return a

    def hits(self, folded: str, a: ahocorasick.Automaton) -> float:
        if not len(a):
            return 0.0
        found = [(end - n + 1, end, weight, free) for end, (n, weight, free) in a.iter(folded)]
        spared = [(s, e) for s, e, _, free in found if free]
        best: dict[str, float] = {}  # each different word's heaviest entry: saying it often adds nothing
        for s, e, weight, free in found:
            if not free and not any(lo <= s and e <= hi for lo, hi in spared):
                word = folded[s + 1 : folded.index(" ", s + 1)]
                best[word] = max(best.get(word, weight), weight)
        return sum(best.values())

    def features(self, texts: list[str | None], a: ahocorasick.Automaton | None = None) -> np.ndarray:
        a = a or self.automaton()
        out = np.zeros((len(texts), 3))
        for i, t in enumerate(texts):
            folded = fold(t)
            h = self.hits(folded, a)
            out[i] = np.log1p(max(h, 0.0)), min(max(h, 0.0) / (1 + folded.count(" ")) ** 0.5, 5.0), 1.0
        return out

    def score(self, texts: list[str | None], a: ahocorasick.Automaton | None = None) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts, a) @ np.array(self.theta), -30, 30)))


def beginnings(folded: str) -> set[str]:
    """Beginnings of the words, and words that are too short for one with a closing space."""
    words = set(folded.split())
    return {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)} | {f"{w} " for w in words if len(w) < SHORTEST}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    theta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(theta))
        step = np.linalg.solve(hess, x.T @ (y - p) - ridge * theta)
        theta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in theta)


def surprise(a: float, b: float, n1: int, n0: int) -> float:
    """Twice the log-likelihood ratio of a of n1 and b of n0 documents against one share for both."""
    e1, e0 = (a + b) * n1 / (n1 + n0), (a + b) * n0 / (n1 + n0)
    return 2 * ((a * np.log(a / e1) if a else 0.0) + (b * np.log(b / e0) if b else 0.0))


def log_odds(a: float, b: float, n1: int, n0: int) -> float:
    return float(np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1)))


def choose(counts: list[tuple[str, int, int]], n1: int, n0: int) -> dict[str, float]:
    """Weights of the beginnings that toxic documents hold far more often; a longer one stays only if it says more than a shorter one.

    counts: (beginning, toxic documents, other documents) that hold it.
    """
    held = {w: (a, b) for w, a, b in counts if a and surprise(a, b, n1, n0) >= SURPRISE and log_odds(a, b, n1, n0) > LEAST_WEIGHT}
    kept: dict[str, float] = {}
    for w in sorted(held, key=lambda w: (len(w), w)):
        weight = log_odds(*held[w], n1, n0)
        above = [kept[w[:n]] for n in range(SHORTEST, len(w)) if w[:n] in kept]
        if not above or weight > max(above) + 1.0:
            kept[w] = weight
    for w in sorted(kept, key=lambda w: (-len(w), w)):  # a beginning that its kept extensions explain says nothing more
        longer = sorted((x for x in kept if len(x) > len(w) and x.startswith(w)), key=len)
        longer = [x for k, x in enumerate(longer) if not any(x.startswith(y) for y in longer[:k])]
        if longer:
            a, b = (max(0, held[w][k] - sum(held[x][k] for x in longer)) for k in (0, 1))
            own = log_odds(a, b, n1, n0)
            if not a or own <= LEAST_WEIGHT or surprise(a, b, n1, n0) < SURPRISE:
                del kept[w]
            else:
                kept[w] = own
    return dict(sorted(kept.items()))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most_docs: int = 4000, least: int = 5, exceptions: list[str] = ()) -> Model:
    """Learns the lexicon, exception phrases and the logistic function from about ``most_docs`` labelled documents of each class, equal texts once.

    Counting runs on the executors. The driver gets the beginnings that at least ``least`` toxic documents of that
    bounded sample hold and that are ``SURPRISE`` from chance, the phrases that at least ``least`` clean ones hold
    around a hit, and two numbers for each document of the sample. Nothing learned is cut to a number of entries.
    ``exceptions``: further phrases that are clean.
    """
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, label, most_docs).repartition(8, F.xxhash64("text"))
    counts = pa.schema([("w", pa.string()), ("a", pa.int64()), ("b", pa.int64())])

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, int]]:
        """Rows of a partition, equal ones once: equal texts share a partition."""
        seen = set()
        for batch in batches:
            for t, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = hashlib.blake2b((t or "").encode("utf-8", "surrogatepass"), digest_size=16, salt=bytes([y == 1])).digest()
                if own not in seen:
                    seen.add(own)
                    yield t, int(y == 1)

    def tables(seen: Counter) -> Iterator[pa.RecordBatch]:
        """(w, toxic, others) of a counter of (w, class)."""
        words = sorted({w for w, _ in seen})
        for lo in range(0, len(words), 50_000):
            w = words[lo : lo + 50_000]
            yield pa.RecordBatch.from_pydict({"w": w, "a": [seen[x, 1] for x in w], "b": [seen[x, 0] for x in w]}, counts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for t, y in different(batches):
            seen.update((w, y) for w in beginnings(fold(t)))
            seen["", y] += 1
        yield from tables(seen)

    def summed(f: Callable) -> DataFrame:
        return sample.mapInArrow(f, "w string, a long, b long").groupBy("w").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))

    counted = stored(summed(count), "beginnings")
    n1, n0 = next((tuple(r) for r in counted.where("w = ''").select("a", "b").collect()), (0, 0))
    if not n1 or not n0:
        share = 1.0 if n1 else 0.0
        return Model({}, {}, (0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3)))))
    a, b, both = F.col("a"), F.col("b"), F.col("a") + F.col("b")
    far = 2 * (a * F.log(a * (n1 + n0) / (both * n1)) + F.when(b > 0, b * F.log(b * (n1 + n0) / (both * n0))).otherwise(0.0))
    sure = counted.where((F.col("w") != "") & (a >= max(1, least)) & (a * n0 > b * n1) & (far >= SURPRISE - 1e-6))
    model = Model(choose(sorted(tuple(r) for r in sure.collect()), n1, n0), {"given": [fold(p).strip() for p in exceptions]})
    shared = spark.sparkContext.broadcast(model)

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Word pairs around hits, by class."""
        found, seen = shared.value.automaton(), Counter()
        for t, y in different(batches):
            folded, pairs = fold(t), set()
            for end, (n, _, free) in found.iter(folded) if len(found) else ():
                if not free:
                    s = end - n + 1
                    stop = folded.index(" ", s + 1)
                    before = folded[folded.rfind(" ", 0, s) + 1 : stop] if s else ""
                    nxt = folded.find(" ", stop + 1)
                    pairs |= {p for p in (before, folded[s + 1 : nxt] if nxt > 0 else "") if " " in p}
            seen.update((p, y) for p in pairs)
        yield from tables(seen)

    model.exceptions["learned"] = sorted(r["w"] for r in summed(phrases).where(f"a = 0 and b >= {least}").collect())
    shared = spark.sparkContext.broadcast(model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, found = shared.value, shared.value.automaton()
        for batch in batches:
            rows = [(t, int(y == 1)) for t, y in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            x = m.features([t for t, _ in rows], found)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array([y for _, y in rows], pa.int32())], names=["h", "d", "y"])

    rows = np.array(sorted(tuple(r) for r in sample.mapInArrow(features, "h double, d double, y int").collect()))
    model.theta = fit_logistic(np.column_stack([rows[:, :2], np.ones(len(rows))]), (rows[:, 2] > 0).astype(float))
    return model


def predict(docs: DataFrame, model: Model, threshold: float = 0.3, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``keep`` columns, score, predicted) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own, names = kept_columns("doc_id", "text", keep, ("score", "predicted"))
    schema = docs.select(*names).schema.add("score", "double").add("predicted", "integer")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, a = shared.value, shared.value.automaton()
        for batch in batches:
            score = m.score(batch.column(1).to_pylist(), a)
            cols = [batch.column(own.index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], names=[*names, "score", "predicted"])

    return docs.select(*own).mapInArrow(apply, schema)
