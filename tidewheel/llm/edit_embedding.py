"""Document fingerprints: randomised edit embedding, bit-sampled banding and verification.

All texts share one random walk rule: at step j over a text, the character c under the cursor is put out and the
cursor moves on if a bit drawn from (c, j) is one. Texts at a small edit distance fall back into step after an
edit, so their outputs are at a small Hamming distance. A fingerprint keeps one hashed bit of the output at every
2^level-th step, the level chosen by the text's length so that about ``BITS`` are kept; a coarser level's steps
are among a finer one's, so any two fingerprints compare. ``likeness`` is 1 less twice the share of differing
bits (not below 0), times the shorter's share of the longer. Walks of a batch advance together, longest first.

``near_classes`` and ``with_classes`` find alike documents: equal fingerprints form classes; bands of bits, sampled
over the whole of the walk, give candidates among the classes' representatives; each candidate is verified by the
likeness of the whole fingerprints, all pairs of a bucket's blocks in one matrix product. Buckets are worked through
in pairs of blocks, and only a forest of links leaves each. Bands grow wider with the logarithm of the number of
fingerprints, and more in number, so buckets stay short.

Rows: one for each input row. A null text counts as empty; its fingerprint has no bits, it is like the empty text
(1) and unlike any other (0). Rows come in ascending doc_id order, nulls first, equal ids in text order; the last
row's next is the first, a single row's next is itself. Other columns are ignored. Texts are walked whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import chunks, codes, in_order, mix64, stored
from tidewheel.llm.linking import UNIT, components, forest, unit_starts, units, whole_units

#: Steps of the walk that a fingerprint keeps, about: between half of it and all.
BITS = 512
#: Characters walked together.
TOGETHER = 1 << 23
_A, _B = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


def level_of(n_chars: int) -> int:
    """Doublings of the stride, for about 2 steps a character."""
    return max(0, int(np.ceil(np.log2(max(1, 2 * n_chars) / BITS))))


def walk(texts: list[np.ndarray], seed: int = 0) -> list[tuple[int, np.ndarray]]:
    """(level, bits) of each text's code points; every seed is a walk rule of its own."""
    out: list[tuple[int, np.ndarray]] = [(0, np.zeros(0, np.uint8))] * len(texts)
    order = sorted((i for i in range(len(texts)) if len(texts[i])), key=lambda i: -len(texts[i]))
    if not order:
        return out
    n = np.array([len(texts[i]) for i in order])
    level = np.array([level_of(k) for k in n])
    flat = np.concatenate([*(texts[i] for i in order), np.zeros(1, np.uint32)])
    texts = []
    flat *= _A
    for lo in range(0, len(flat), 1 << 20):
        flat[lo : lo + (1 << 20)] ^= flat[lo : lo + (1 << 20)] >> np.uint32(15)
    ends = np.cumsum(n)
    at = ends - n
    room = 2 * BITS
    bits, kept = np.zeros((len(order), room), np.uint8), np.zeros(len(order), np.int64)
    # the first text whose level is not above v, for each v
    finest = np.searchsorted(-level, -np.arange(int(level.max()) + 1), side="left")
    rng = np.random.default_rng(20240817 + seed)  # the same walk for every batch
    live, step = len(order), 0
    while live:
        cursor, stop = at[:live], ends[:live]
        for salt in rng.integers(1 << 32, size=128, dtype=np.uint32):
            draw = (flat[cursor] ^ salt) * _B
            v = (step & -step).bit_length() - 1 if step else len(finest) - 1
            lo = int(finest[min(v, len(finest) - 1)])
            if lo < live:
                slot = step >> level[lo:live]
                rows = np.flatnonzero((cursor[lo:] < stop[lo:]) & (slot < room))
                slot = slot[rows]
                rows += lo
                bits[rows, slot] = (draw[rows] >> np.uint32(7)) & np.uint32(1)
                kept[rows] = slot + 1
            cursor += draw >> np.uint32(31)
            np.minimum(cursor, stop, out=cursor)
            step += 1
        while live and at[live - 1] == ends[live - 1]:
            live -= 1
    for row, i in enumerate(order):
        out[i] = (int(level[row]), bits[row, : kept[row]].copy())
    return out


def text_of(level: int, bits: np.ndarray) -> str:
    """A fingerprint as text: level and number of bits, then the bits, in hexadecimal."""
    return f"{level:02x}{len(bits):04x}{np.packbits(bits).tobytes().hex()}"


def bits_in(data: bytes) -> tuple[int, np.ndarray]:
    """Level and bits of a fingerprint's bytes."""
    return data[0], np.unpackbits(np.frombuffer(data, np.uint8, offset=3))[: int.from_bytes(data[1:3], "big")]


def bits_of(text: str) -> tuple[int, np.ndarray]:
    return bits_in(bytes.fromhex(text))


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    (la, x), (lb, y) = a, b
    x, y = x[:: 1 << max(0, lb - la)], y[:: 1 << max(0, la - lb)]
    short, long = sorted((len(x), len(y)))
    if not long:
        return 1.0
    if not short:
        return 0.0
    differ = np.count_nonzero(x[:short] != y[:short]) / short
    return max(0.0, 1.0 - 2.0 * differ) * short / long


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as many characters from the beginning of ``following``."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def fingerprints(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, fingerprint, sha256) of (doc_id, text) rows."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            prints = []
            for lo, hi in chunks(texts, TOGETHER):
                prints += [text_of(*w) for w in walk([codes(t) for t in texts[lo:hi]], seed)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts])], names=["doc_id", "fingerprint", "sha256"])

    return docs.select("doc_id", "text").mapInArrow(apply, docs.select("doc_id").schema.add("fingerprint", "string").add("sha256", "string"))


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each row's text and of its edited text, and their likeness to each other and to the next row's."""
    ordered = in_order(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", "text", echo=True)
    schema = docs.select("doc_id").schema
    for name, kind in (("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double")):
        schema = schema.add(name, kind)

    def rows_of(held: list[tuple], following: str, id_type: pa.DataType) -> pa.RecordBatch:
        texts = [t for _, t in held]
        changed = [edited(t, f) for t, f in zip(texts, [*texts[1:], following], strict=True)]
        walks = walk([codes(t) for t in [*texts, following, *changed]])
        own, new = walks[: len(texts) + 1], walks[len(texts) + 1 :]
        return pa.RecordBatch.from_arrays([
            pa.array([i for i, _ in held], id_type), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]), pa.array([text_of(*w) for w in own[:-1]]), pa.array([text_of(*w) for w in new]),
            pa.array([likeness(a, b) for a, b in zip(own[:-1], new, strict=True)], pa.float64()), pa.array([likeness(a, b) for a, b in zip(own[:-1], own[1:], strict=True)], pa.float64()),
        ], names=[f.name for f in schema])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, part = 0, None
        for batch in batches:
            kind = batch.column(0).type
            for doc_id, text, p, echo in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if echo:
                    if held:
                        yield rows_of(held, text, kind)
                        held, size = [], 0
                    continue
                if p != part and held:
                    raise ValueError(f"part {part} lacks the row after its last")
                part = p
                if held and (size > TOGETHER or len(held) > 16_384):
                    yield rows_of(held, text, kind)
                    held, size = [], 0
                held.append((doc_id, text))
                size += len(text)
        if held:
            raise ValueError(f"part {part} lacks the row after its last")

    return ordered.select("doc_id", "text", "_part", "_echo").mapInArrow(apply, schema)


def near_classes(docs: DataFrame, threshold: float = 0.8, walks: int = 1, recall: float = 0.9, block: int = 512) -> DataFrame:
    """(doc_id, class_id): documents joined by fingerprints with a likeness of ``threshold`` or more, named by their smallest doc_id.

    A walk that an insertion throws out of step comes back after a time without a bound on its mean; with ``walks``
    above 1 so many rules are tried, and a pair is alike if it is under one of them. Equal texts form one class at
    once. A pair whose likeness is just the threshold is found with a chance of about ``recall`` under each rule, a
    closer pair with a higher one (see ``links``). Rows with a null doc_id stay alone, with a null class_id.
    """
    rows = stored(docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256")), "text-digests")
    classes = stored(rows.where("doc_id is not null").groupBy("sha256").agg(F.min("doc_id").cast("long").alias("node")), "text-classes")
    texts = docs.join(classes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    found = None
    for seed in range(walks):
        prints = stored(fingerprints(texts, seed).select(F.col("doc_id").cast("long").alias("node"), F.unhex("fingerprint").alias("print")), "fingerprints")
        own = links(prints, threshold, recall, block)
        found = own if found is None else found.unionByName(own)
    return named(rows, classes, found, "sha256")


def with_classes(rows: DataFrame, threshold: float = 0.8, recall: float = 0.9, block: int = 512) -> DataFrame:
    """Adds ``class_id`` to rows with (doc_id, fingerprint) that lie in files: as ``near_classes``, from the fingerprints alone."""
    classes = rows.where("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").cast("long").alias("node"))
    classes = stored(classes, "fingerprint-classes")
    found = links(classes.select("node", F.unhex("fingerprint").alias("print")), threshold, recall, block)
    return named(rows, classes, found, "fingerprint")


def named(rows: DataFrame, classes: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """``rows`` with the class_id of their ``key``, null where doc_id is null."""
    ids = classes.join(components(found), "node", "left").select(key, F.coalesce("label", "node").alias("class_id"))
    out = rows.join(ids, key, "left").withColumn("class_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")))
    return out.select(*(["doc_id"] if key == "sha256" else rows.columns), "class_id")


def bands_for(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Width and number of bands for n fingerprints.

    The width grows with the logarithm of n, so that texts that are not alike seldom meet in a band however many
    there are; the number is such that a pair at the threshold shares a band with a chance of ``recall``.
    """
    width = max(10, int(np.ceil(np.log2(max(2, n)))) + 2)
    same = ((1 + threshold) / 2) ** width
    return width, max(1, int(np.ceil(np.log(1 - recall) / np.log1p(-same))))


#: Reaches to a doubling of the walk's length.
REACHES = 3


def reaches(level: int, bits: int, threshold: float) -> list[tuple[int, int, int]]:
    """(reach, stride's level, steps) under which a fingerprint is listed.

    A reach is a count of steps, ``REACHES`` to a doubling: the last one within the walk and those down to the last
    within the shortest walk that could be as alike as ``threshold``. Two such walks share a reach that the shorter
    one fills to 2 ** (-1 / REACHES) at least. All walks that share a reach have bits at its stride.
    """
    if not bits:
        return [(0, 0, 0)]
    last, back = int(np.floor(REACHES * np.log2(bits << level))), int(np.ceil(REACHES * np.log2(1 / max(threshold, 1 / BITS))))
    out = []
    for reach in range(max(0, last - back), last + 1):
        steps = int(2 ** (reach / REACHES))
        up = max(0, int(np.floor(np.log2(max(1, steps)))) - 6 - back // REACHES)
        out.append((reach, max(up, level), steps))
    return out


def samples(level: int, bits: np.ndarray, spread: np.ndarray, threshold: float) -> tuple[list[np.ndarray], list[int]]:
    """The sampled bits of every band as an integer, and the reach, for every reach; the places are spread over all of the reach."""
    power = np.uint64(1) << np.arange(spread.shape[1], dtype=np.uint64)
    out, at = [], []
    for reach, up, steps in reaches(level, len(bits), threshold):
        own = bits[:: 1 << (up - level)]
        if len(own):
            places = np.minimum((spread * max(1, steps >> up)).astype(np.int32), len(own) - 1)
            out.append((own[places] * power).sum(1, dtype=np.uint64))
        else:
            out.append(np.zeros(len(spread), np.uint64))
        at.append(reach)
    return out, at


def alike(prints: list[tuple[int, np.ndarray]], left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of ``left`` and ``right`` with a likeness of ``threshold`` or more, by matrix products of signs.

    With a bit as 1 or -1 and nothing beyond a walk's end, the product of two rows is the number of steps that agree
    less those that differ, so the likeness is that product (not below 0) over the longer one's steps.
    """
    level = np.array([p[0] for p in prints])
    a, b = [], []
    for la in np.unique(level[left]):
        for lb in np.unique(level[right]):
            i, j = left[level[left] == la], right[level[right] == lb]
            top = max(la, lb)
            x, y = ([prints[k][1][:: 1 << int(top - own)] for k in rows] for rows, own in ((i, la), (j, lb)))
            size = [np.array([len(v) for v in side]) for side in (x, y)]
            signs = [np.zeros((len(side), max(1, max(size[0].max(), size[1].max()))), np.float32) for side in (x, y)]
            for m, side in zip(signs, (x, y), strict=True):
                for row, v in zip(m, side, strict=True):
                    row[: len(v)] = 2.0 * v - 1.0
            product, longer = signs[0] @ signs[1].T, np.maximum(size[0][:, None], size[1][None, :])
            p, q = np.nonzero(np.where(longer > 0, product >= threshold * longer - 1e-6, True))
            a.append(i[p])
            b.append(j[q])
    return np.concatenate(a), np.concatenate(b)


#: Rows of a unit that is verified together with others.
SHORT = 32


def near_pairs(prints: list[tuple[int, np.ndarray]], short: np.ndarray, unit: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one unit, among the rows marked ``short``, with a likeness of ``threshold`` or more.

    Bits are laid out at their own level in rows of bytes; all pairs of rows d apart are compared at once.
    """
    rows = np.flatnonzero(short)
    level, n = np.array([prints[r][0] for r in rows]), np.array([len(prints[r][1]) for r in rows])
    flat = np.zeros((len(rows), 2 * BITS), np.uint8)
    for k, r in enumerate(rows.tolist()):
        flat[k, : n[k]] = prints[r][1]
    packed, own = np.packbits(flat, axis=1).view(np.uint64), unit[rows]
    mask = np.packbits(np.arange(2 * BITS)[None, :] < np.arange(2 * BITS + 1)[:, None], axis=1).view(np.uint64)  # by length
    a, b = [], []
    for d in range(1, SHORT):
        i = np.flatnonzero(own[d:] == own[:-d]) if len(own) > d else np.zeros(0, int)
        if not len(i):
            break
        j = i + d
        same = level[i] == level[j]
        for x, y in zip(i[~same].tolist(), j[~same].tolist(), strict=True):  # a level apart
            if likeness(prints[rows[x]], prints[rows[y]]) >= threshold - 1e-9:
                a.append([rows[x]])
                b.append([rows[y]])
        i, j = i[same], j[same]
        less, more = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        differ = np.bitwise_count((packed[i] ^ packed[j]) & mask[less]).sum(1, dtype=np.int64)
        near = (less - 2 * differ >= threshold * more - 1e-6) | (more == 0)
        a.append(rows[i[near]])
        b.append(rows[j[near]])
    return tuple(np.concatenate([np.zeros(0, np.int64), *side]).astype(np.int64) for side in (a, b))


def links(prints: DataFrame, threshold: float, recall: float, block: int) -> DataFrame:
    """(a, b): verified links of (node, print) rows, print a fingerprint's bytes. Buckets are worked through in pairs of blocks."""
    width, bands = bands_for(prints.count(), threshold, recall)
    spread = np.random.default_rng(7).random((bands, width))

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band = np.arange(bands, dtype=np.uint64)
        for batch in batches:
            value, reach, node, count = [], [], batch.column(0).to_numpy(), []
            for p in batch.column(1).to_pylist():
                own, at = samples(*bits_in(p), spread, threshold)
                value += own
                reach += at
                count.append(len(at))
            salt = np.array(reach, np.uint64)[:, None] * np.uint64(1 << 20) + band
            mixed = mix64(mix64(np.array(value, np.uint64).reshape(-1, bands)) ^ mix64(salt + np.uint64(1))) >> np.uint64(1)
            yield pa.RecordBatch.from_arrays([pa.array(mixed.ravel().astype(np.int64)), pa.array(np.repeat(np.repeat(node, count), bands))], names=["value", "node"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Short units lie in one batch and are verified together; the last unit of a batch is held back until it is whole."""
        for rows in whole_units(batches):
            node, own = rows.column("node").to_numpy(), rows.column("own").to_numpy()
            prints = [bits_in(p) for p in rows.column("print").to_pylist()]
            begins = unit_starts(rows)
            size = np.diff([*begins, len(node)])
            short = np.repeat((size <= SHORT) & (rows.column("bi").to_numpy() == rows.column("bj").to_numpy())[begins], size)
            pairs = [near_pairs(prints, short, np.repeat(np.arange(len(size)), size), threshold)]
            for lo, n in zip(begins.tolist(), size.tolist(), strict=True):
                if not short[lo] and n > 1:
                    part, bi, bj = own[lo : lo + n], rows.column("bi")[lo].as_py(), rows.column("bj")[lo].as_py()
                    left, right = np.flatnonzero(part == bi), np.flatnonzero(part == bj)
                    if len(left) and len(right):
                        pairs.append(tuple(lo + x for x in alike(prints[lo : lo + n], left, right, threshold)))
            a, b = (node[np.concatenate([p[k] for p in pairs])] for k in (0, 1))
            names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            joined = forest(len(names), at[: len(a)], at[len(a) :])
            if joined:
                x, y = (np.array(c) for c in zip(*joined, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(names[x]), pa.array(names[y])], names=["a", "b"])

    postings = stored(prints.mapInArrow(lists, "value long, node long"), "postings")
    rows = units(postings, block).join(prints, "node").select(*UNIT, "own", "node", "print")
    return rows.repartition(*UNIT).sortWithinPartitions(*UNIT, "node").mapInArrow(verify, "a long, b long")
