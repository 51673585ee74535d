"""MinHash near-dedup by bottom-k sketches from one hash function.

A document's set holds the hashes of its distinct five-word shingles; its sketch is the ``KEPT`` smallest. Equal
sets form classes, and only a class' representative (smallest doc_id) goes on. Inverted lists of retained values
give candidates: a representative's keys are the ``KEYS`` smallest of its retained values that others retain and
that at most ``COMMON`` representatives do. Where more than 3/8 of a sketch are more common values (members of
large groups of copies, boilerplate), its ``COMMON_KEYS`` smallest common values are keys too. Lists are worked
through in blocks (``linking.units``): overlaps of all pairs of sketches by matrix product, the Jaccard
similarity estimated from the union's sketch, and pairs far below the threshold (five standard errors) left out.
Each remaining pair is dealt to the list of its smallest shared key, full sets meet there, and exact Jaccard
confirms. Components of the confirmed links are labelled by their smallest doc_id.

Each block is first compared with itself and with its list's first block, and their links labelled. Of the other
pairs of blocks only those are worked through, sketches and sets alike, whose members do not all share a label yet:
a large group of different copies is joined through the first block, at a cost that is linear in the group.

A pair at the threshold t stays unfound only if none of its keys is shared, with a chance of about (1 - t) to the
power KEYS. No list, bucket or candidate count is capped. A list of n members that are no copies of each other
costs n * n / 2 sketch comparisons in tasks of two blocks; so only the lists of common values, which hold
boilerplate, grow beyond COMMON members.

Rows: one for each input row. A null text counts as empty: no words, set size 0, linked with nothing. With one to
four words the whole sequence is the one shingle. Rows with one doc_id are one node. A null doc_id can't name a
component: such rows come back with component_id null and kept true, and link nothing. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import chunks, mix64, stored
from tidewheel.llm.linking import UNIT, by_unit, common, components, forest, units

WORDS, KEPT, KEYS, COMMON, COMMON_KEYS, BLOCK = 5, 64, 12, 256, 8, 512
PIECE = 1 << 19
_R = 0x9E3779B97F4A7C15 | 1
_STEP = np.array([0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 to the power 64."""
    up = np.full(n, _R, np.uint64)
    down = np.full(n, pow(_R, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct 63-bit shingle hashes of each text."""
    for lo, hi in chunks(texts, PIECE):
        yield from _sets([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts[lo:hi]])


def _sets(raw: list[bytes]) -> Iterator[np.ndarray]:
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    size = 1 << max(18, int(len(buf)).bit_length())
    up, down = _powers(size)
    white = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], white]).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    total = np.concatenate([[np.uint64(0)], np.cumsum((buf + np.uint64(1)) * up[: len(buf)], dtype=np.uint64)])
    word = mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(_R))
    first = np.searchsorted(starts, np.cumsum([0, *(len(r) + 1 for r in raw)]))
    n = max(0, len(word) - WORDS + 1)
    five = np.zeros(n, np.uint64)
    for k in range(WORDS):
        five += word[k : k + n] * _STEP[k]
    five = mix64(five) >> np.uint64(1)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= WORDS:
            yield np.unique(five[a : b - WORDS + 1])
        elif b > a:
            short = (word[a:b] * _STEP[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield mix64(np.array([short])) >> np.uint64(1)
        else:
            yield np.zeros(0, np.uint64)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key, sketch) of (doc_id, text) rows; ``key`` digests the whole set, null for the empty one."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key, kept = [], [], []
            for lo in range(0, batch.num_rows, 256):
                for s in shingle_sets(batch.column(1)[lo : lo + 256].to_pylist()):
                    n.append(len(s))
                    key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    kept.append(s[:KEPT].astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(kept, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "key", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(apply, "doc_id long, n_shingles long, key binary, sketch array<long>")


def keys_of(classes: DataFrame) -> DataFrame:
    """(node, keys) of (node, sketch) rows: the retained values under which each representative is listed."""
    postings = classes.select("node", F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    sizes = postings.groupBy("value").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = postings.join(sizes, "value").groupBy("node").agg(F.first("kept").alias("kept"), F.sort_array(F.collect_list(F.struct("value", "size"))).alias("met"))
    rare = F.transform(F.filter("met", lambda x: x["size"] <= COMMON), lambda x: x["value"])
    often = F.transform(F.filter("met", lambda x: x["size"] > COMMON), lambda x: x["value"])
    met = met.select("node", "kept", rare.alias("rare"), often.alias("often"))
    more = F.when(F.size("often") > F.col("kept") * 3 / 8, F.slice("often", 1, COMMON_KEYS)).otherwise(F.slice("often", 1, 0))
    return met.select("node", F.concat(F.slice("rare", 1, KEYS), more).alias("keys")).where(F.size("keys") > 0)


def estimates(own: np.ndarray, other: np.ndarray, kept: int) -> np.ndarray:
    """Jaccard similarity of the sets behind rows of ``own`` and ``other`` (sorted sketches, padded with the largest value), from the sketch of their union."""
    both = np.sort(np.concatenate([own, other], 1), 1)
    pad = both == np.iinfo(both.dtype).max
    new = np.concatenate([np.ones((len(both), 1), bool), both[:, 1:] != both[:, :-1]], 1) & ~pad
    rank = np.cumsum(new, 1)
    again = ~new & ~pad & (rank <= kept)
    return again.sum(1) / np.maximum(np.minimum(rank[:, -1], kept), 1)


def candidates(listed: DataFrame, threshold: float) -> DataFrame:
    """(value, bi, bj, own, node) that have a partner within their unit: of rows (value, bi, bj, own, node, n, keys, sketch)."""
    margin = 5 * (threshold * (1 - threshold) / KEPT) ** 0.5

    def pairs(unit: tuple, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        value, bi, bj = unit
        own = rows.column("own").to_numpy()
        node, n = rows.column("node").to_numpy(), rows.column("n").to_numpy()
        left, right = np.flatnonzero(own == bi), np.flatnonzero(own == bj)
        if not len(left) or not len(right) or len(node) < 2:
            return
        kept = [np.array(x, np.uint64) for x in rows.column("sketch").to_pylist()]
        size = np.array([len(k) for k in kept])
        met = common(kept, left, right)
        low = np.minimum(n[left][:, None], n[right][None, :]) / np.maximum(n[left][:, None], n[right][None, :])
        full = np.minimum(size[left][:, None], size[right][None, :])
        i, j = np.nonzero((met >= (threshold - margin) * full) & (low >= threshold))
        i, j = left[i], right[j]
        keep = i < j if bi == bj else np.ones(len(i), bool)
        i, j = i[keep], j[keep]
        if not len(i):
            return
        table = np.full((len(kept), KEPT), np.iinfo(np.uint64).max, np.uint64)
        for r, k in enumerate(kept):
            table[r, : len(k)] = k
        keys = rows.column("keys").to_pylist()
        listing = np.full((len(keys), max(map(len, keys))), -1, np.int64)
        for r, k in enumerate(keys):
            listing[r, : len(k)] = k
        marked = np.zeros(len(kept), bool)
        for lo in range(0, len(i), 2048):
            a, b = i[lo : lo + 2048], j[lo : lo + 2048]
            near = (estimates(table[a], table[b], KEPT) >= threshold - margin) & (node[a] != node[b])
            a, b = a[near], b[near]
            same = (listing[a][:, :, None] == listing[b][:, None, :]) & (listing[a] >= 0)[:, :, None]
            least = np.where(same.any(2), listing[a], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
            here = least == value  # each pair belongs to the list of its smallest shared key
            marked[a[here]] = marked[b[here]] = True
        at = np.flatnonzero(marked)
        if len(at):
            k = len(at)
            yield pa.RecordBatch.from_arrays([pa.array([value] * k, pa.int64()), pa.array([bi] * k, pa.int32()), pa.array([bj] * k, pa.int32()), pa.array(own[at], pa.int32()), pa.array(node[at], pa.int64())], names=[*UNIT, "own", "node"])

    return by_unit(listed, pairs, "value long, bi int, bj int, own int, node long")


def confirmed(met: DataFrame, percent: int) -> DataFrame:
    """(a, b) links of rows (value, bi, bj, own, node, full): 100 * intersection >= percent * union of the full sets, as a forest of each unit."""

    def links(unit: tuple, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        own, node = rows.column("own").to_numpy(), rows.column("node").to_numpy()
        full = [np.frombuffer(x, np.uint64) for x in rows.column("full").to_pylist()]
        left, right = np.flatnonzero(own == unit[1]), np.flatnonzero(own == unit[2])
        met = common(full, left, right)
        n = np.array([len(f) for f in full])
        i, j = np.nonzero(100 * met >= percent * (n[left][:, None] + n[right][None, :] - met))
        a, b = left[i], right[j]
        keep = a != b
        pairs = forest(len(node), a[keep], b[keep])
        if pairs:
            x, y = (np.array(p) for p in zip(*pairs, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(node[x]), pa.array(node[y])], names=["a", "b"])

    return by_unit(met, links, "a long, b long")


def full_sets(docs: DataFrame) -> DataFrame:
    """(node, full): the whole shingle set of each (doc_id, text) row."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                sets = [s.tobytes() for s in shingle_sets(batch.column(1)[lo : lo + 256].to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo : lo + 256], pa.array(sets, pa.binary())], names=["node", "full"])

    return docs.select(F.col("doc_id").cast("long").alias("node"), "text").mapInArrow(apply, "node long, full binary")


def near_duplicates(docs: DataFrame, percent: int = 80, few: int = 2_000_000) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text) rows; links have 100 * intersection >= percent * union.

    ``few``: as many representatives with a candidate are sent to the second scan as a broadcast of ids; beyond, it is a shuffle join.
    """
    threshold = percent / 100
    rows = stored(sketches(docs), "sketches")
    real = rows.where("n_shingles > 0 and doc_id is not null")
    classes = stored(real.groupBy("key").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "classes")
    keys = stored(keys_of(classes), "keys")
    listed = stored(units(keys.select("node", F.explode("keys").alias("value")), BLOCK), "listed")
    about = classes.select("node", "n", "sketch").join(keys, "node")
    ids = docs.select("doc_id", "text")

    def linked(part: DataFrame) -> DataFrame:
        """(a, b): verified links of the units of ``part``."""
        near = stored(candidates(part.join(about, "node"), threshold).hint("rebalance"), "candidates")  # few rows: few files
        wanted = near.select(F.col("node").alias("doc_id")).distinct()
        hint = F.broadcast if wanted.count() <= few else (lambda df: df)
        whole = full_sets(ids.join(hint(wanted), "doc_id", "left_semi"))
        return confirmed(near.join(whole, "node"), percent)

    labels = components(linked(listed.where("bi = 0 or bi = bj")))
    rest = listed.where("bi > 0 and bi <> bj")
    if not rest.isEmpty():
        own = rest.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        apart = own.groupBy(*UNIT).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select(*UNIT)
        links = linked(rest.join(apart, UNIT, "left_semi"))
        labels = components(labels.select(F.col("label").alias("a"), F.col("node").alias("b")).unionByName(links))
    named = classes.select("key", "node").join(labels, "node", "left").select("key", F.coalesce("label", "node").alias("component_id"))
    joined = real.select("doc_id", "n_shingles", "key").join(named, "key").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.unionByName(alone).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_duplicates_sql(percent: int = 80) -> str:
    """DuckDB SQL for ``near_duplicates`` over the table documents, by all pairs that share a shingle: for small tables."""
    return f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws from documents),
sh as (
  select distinct doc_id, unnest(case when len(ws) >= {WORDS} then list_transform(range(1, len(ws) - {WORDS - 2}), lambda i: array_to_string(ws[i:i + {WORDS - 1}], ' ')) when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as s from w),
n as (select doc_id, count(*) as n from sh group by 1),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as i from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= {percent} * (x.n + y.n - i)),
edges as (select a, b from links union all select b, a from links),
reach(node, label) as (select doc_id, doc_id from documents union select e.b, r.label from reach r join edges e on e.a = r.node where r.label < e.b),
least as (select node, min(label) as label from reach group by 1)
select doc_id, coalesce(n, 0)::bigint as n_shingles, label as component_id, doc_id = label as kept
from documents left join n using (doc_id) join least on node = doc_id"""
