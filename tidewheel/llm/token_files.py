"""Token-id output: raw id payloads with a minimal perfect hash index from document key to place.

A store is a Parquet table of blocks in ascending key order. Each block holds a raw payload of little-endian
unsigned 32-bit ids and an index of its documents: levels of bit arrays form a minimal perfect hash of the keys
(a key's slot is the rank of the first level's bit that it alone sets), and slot tables hold a 32-bit
fingerprint of the key, the first id's place in the payload and the number of ids. Looking a key up costs a
constant number of probes in its block; the block is found by the blocks' key bounds, which Parquet keeps as
column statistics. Blocks are self-contained, written by Spark's commit protocol, and cut at about ``BLOCK``
ids or one longer document.

Keys: (doc_id, occurrence), the occurrence counting rows with equal ids in text order, so repeated ids keep all
their rows. Null ids come first, with their own mark. A null text is an empty document: only the end id. An
empty table gives an empty store. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import in_order, mix64, scratch_path
from tidewheel.llm.word_tokens import encoder

BLOCK = 1 << 18
#: Bits for each key in a level, and levels before the rest is listed.
SPACE, LEVELS = 2.0, 32
SCHEMA = "part int, block int, key_lo long, key_hi long, docs long, ids long, base long, keys binary, levels binary, slots binary, payload binary"
_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("key_lo", pa.int64()), ("key_hi", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64()), ("base", pa.int64()), ("keys", pa.binary()), ("levels", pa.binary()), ("slots", pa.binary()), ("payload", pa.binary())])
KEY = np.dtype([("id", "<i8"), ("turn", "<u4"), ("null", "u1")])
SLOT = np.dtype([("print", "<u4"), ("at", "<u8"), ("n", "<u8")])


def key_hash(keys: np.ndarray) -> np.ndarray:
    return mix64(mix64(keys["id"].astype("<i8").view("<u8") + np.uint64(0x9E3779B97F4A7C15)) ^ mix64(keys["turn"].astype(np.uint64) * np.uint64(2) + keys["null"] + np.uint64(77)))


def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix64(h + np.uint64((level + 1) * 0xD1342543DE82EF95 % (1 << 64))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit hashes: bit arrays by level, then a sorted list of what is left."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray) -> None:
        self.levels, self.rest = levels, rest
        self.ranks, n = [], 0
        for bits in levels:
            self.ranks.append(n + np.concatenate([[0], np.cumsum(bits)[:-1]]))
            n += int(bits.sum())
        self.ranked = n

    @classmethod
    def build(cls, h: np.ndarray) -> PerfectHash:
        levels, left = [], h
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(8, -(-int(len(left) * SPACE) // 8) * 8)
            at = _place(left, level, size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels, np.sort(left))

    def slots(self, h: np.ndarray) -> np.ndarray:
        """The slot of each hash; of a hash that was never put in, any slot or -1."""
        out, todo = np.full(len(h), -1, np.int64), np.arange(len(h))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = _place(h[todo], level, len(bits))
            hit = bits[at]
            out[todo[hit]] = rank[at[hit]]
            todo = todo[~hit]
        if len(todo) and len(self.rest):
            i = np.minimum(np.searchsorted(self.rest, h[todo]), len(self.rest) - 1)
            out[todo] = np.where(self.rest[i] == h[todo], self.ranked + i, -1)
        return out

    def dump(self) -> bytes:
        head = np.array([len(self.levels), len(self.rest), *map(len, self.levels)], "<u4").tobytes()
        return head + b"".join(np.packbits(b, bitorder="little").tobytes() for b in self.levels) + self.rest.astype("<u8").tobytes()

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        n, rest = np.frombuffer(data, "<u4", 2)
        sizes, at, levels = np.frombuffer(data, "<u4", int(n), 8), 8 + 4 * int(n), []
        for size in map(int, sizes):
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, size // 8, at), bitorder="little").astype(bool))
            at += size // 8
        return cls(levels, np.frombuffer(data, "<u8", int(rest), at))


def _print(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(17)).astype("<u4")


def pack(keys: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """The levels and slot tables of a block."""
    h = key_hash(keys)
    index = PerfectHash.build(h)
    slots = np.zeros(len(keys), SLOT)
    at = index.slots(h)
    slots["print"][at], slots["n"][at] = _print(h), lengths
    slots["at"][at] = np.cumsum(lengths) - lengths
    return index.dump(), slots.tobytes()


def find(levels: bytes, slots: bytes, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each key: whether its fingerprint is stored, its first id's place, its number of ids."""
    table, h = np.frombuffer(slots, SLOT), key_hash(keys)
    at = PerfectHash.load(levels).slots(h)
    own = table[np.maximum(at, 0)] if len(table) else np.zeros(len(h), SLOT)
    found = (at >= 0) & (own["print"] == _print(h)) if len(table) else np.zeros(len(h), bool)
    return found, own["at"].astype(np.int64), own["n"].astype(np.int64)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Encodes (doc_id, text) rows, appends ``end_id`` to each and writes the store at ``path``."""
    ordered = in_order(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        part, block, base = None, 0, 0
        keys: list[tuple] = []
        parts: list[bytes] = []
        size, last, turn = 0, None, 0

        def close() -> pa.RecordBatch:
            nonlocal block, base, size
            k = np.array(keys, KEY)
            n = np.array([len(p) // 4 for p in parts], np.int64)
            levels, slots = pack(k, n)
            real = k["id"][k["null"] == 0]
            row = {"part": part, "block": block, "key_lo": int(real[0]) if len(real) else None, "key_hi": int(real[-1]) if len(real) else None, "docs": len(k), "ids": int(n.sum()), "base": base, "keys": k.tobytes(), "levels": levels, "slots": slots, "payload": b"".join(parts)}
            block, base, size = block + 1, base + int(n.sum()), 0
            keys.clear()
            parts.clear()
            return pa.RecordBatch.from_pylist([row], _ARROW)

        def rows() -> Iterator[tuple[int | None, bytes, int]]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 256):
                    names, texts, places = (c[lo : lo + 256].to_pylist() for c in batch.columns)
                    yield from zip(names, enc.encode(texts), places, strict=True)

        for doc_id, ids, p in rows():
            if p != part:  # a task may hold several parts
                if keys:
                    yield close()
                part, block, base, last, turn = p, 0, 0, None, 0
            ids += end
            if keys and size + len(ids) // 4 > BLOCK:
                yield close()
            turn = turn + 1 if last == (doc_id,) else 0
            last = (doc_id,)
            keys.append((0 if doc_id is None else doc_id, turn, doc_id is None))
            parts.append(ids)
            size += len(ids) // 4
        if keys:
            yield close()

    ordered.select("doc_id", "text", "_part").mapInArrow(blocks, SCHEMA).write.option("compression", "zstd").parquet(path)


def part_bases(store: DataFrame) -> dict[int, int]:
    """Ids before each part; one row for each part reaches the driver."""
    out, n = {}, 0
    for r in store.groupBy("part").agg(F.sum("ids").alias("n")).orderBy("part").collect():
        out[r["part"]], n = n, n + r["n"]
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, each looked up through its block's index."""
    store = spark.read.schema(SCHEMA).parquet(path)
    bases = part_bases(store)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, payload = np.frombuffer(row["keys"], KEY), memoryview(row["payload"])
                found, at, n = find(row["levels"], row["slots"], keys)
                if not found.all():
                    raise ValueError(f"part {row['part']}, block {row['block']}: the index lacks a key")
                crc = [zlib.crc32(payload[4 * a : 4 * (a + m)]) for a, m in zip(at.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(keys["id"], pa.int64(), mask=keys["null"] > 0), pa.array(bases[row["part"]] + row["base"] + at), pa.array(n), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return store.select("part", "block", "base", "keys", "levels", "slots", "payload").mapInArrow(scan, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, path: str, wanted: list[int]) -> DataFrame:
    """(doc_id, turn, ids) of the asked documents that the store holds. Only blocks whose key bounds hold an asked id are read; for a few keys."""
    asked = np.array(sorted(set(wanted)), np.int64)
    store = spark.read.schema(SCHEMA).parquet(path)
    if not len(asked):
        return spark.createDataFrame([], "doc_id long, turn int, ids array<long>")
    some = F.lit(False)
    for lo, hi in ((g[0], g[-1]) for g in np.array_split(asked, min(len(asked), 64))):
        some = some | ((F.col("key_hi") >= int(lo)) & (F.col("key_lo") <= int(hi)))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = asked[(asked >= row["key_lo"]) & (asked <= row["key_hi"])]
                first = np.frombuffer(row["keys"], KEY, 1)[0]  # the block may begin amid an id's turns
                turns = np.where((ids == first["id"]) & (first["null"] == 0), first["turn"], 0)
                while len(ids):
                    keys = np.zeros(len(ids), KEY)
                    keys["id"], keys["turn"] = ids, turns
                    found, at, n = find(row["levels"], row["slots"], keys)
                    for i, t, a, m in zip(ids[found].tolist(), turns[found].tolist(), at[found].tolist(), n[found].tolist(), strict=True):
                        yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t], pa.int32()), pa.array([np.frombuffer(row["payload"], "<u4", m, 4 * a).astype(np.int64)])], names=["doc_id", "turn", "ids"])
                    ids, turns = ids[found], turns[found] + 1

    return store.where(some).select("key_lo", "key_hi", "keys", "levels", "slots", "payload").mapInArrow(probe, "doc_id long, turn int, ids array<long>")


def roundtrip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Writes a store in the shared folder and reads it back."""
    path = scratch_path(docs.sparkSession, "token-store")
    write(docs, path, tokenizer, end_id)
    return read(docs.sparkSession, path)
