"""SentencePiece encoding and decoding in batched numpy.

Texts are cut before each run of spaces, where no piece spans (checked when a model is loaded). Words of equal
length advance together: rolling hashes give every substring's key, sorted piece keys are probed for all words at
once, and vectorised maxima store each prefix's best score and a backpointer, the length of its last piece. The
ids are those of the pieces with the largest total score; of equal scores the longest last piece wins. For unigram
models this is the library's rule. For BPE models the library merges pairs instead, which gives other ids:
``rule="merges"`` joins in each word the adjacent pair whose piece scores best, leftmost first, until none is left.
Characters without a piece become byte pieces, or the unknown piece where the model has none.

Rows: one for each input row. A null text counts as empty: no pieces. Repeated rows stay; other columns are
ignored. Texts are encoded whole; a word longer than ``LONG`` characters is merged by a heap. Decoding inverts
encoding up to the model's own normal form, in which U+2581 is a space, under either rule.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewheel.llm.common import codes, light

SPACE = "▁"
LONG, TOGETHER, MOST_WORDS = 200, 4096, 100_000
_GONE = np.iinfo(np.int64).min
_BASE, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")
#: Kinds of pieces in the file format.
UNKNOWN, CONTROL, BYTE = 2, 3, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            c = data[at]
            at += 1
            value |= (c & 127) << shift
            shift += 7
            if c < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at : at + n]
            at += n


class Model:
    """Pieces of a model file, their sorted keys, and the words encoded so far."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            data = f.read()
        pieces, normal = [], {}
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                pieces.append((own[1].decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, 1)))
            elif number == 3:
                normal = dict(_fields(value))
        if normal.get(2) or normal.get(4, 1):
            raise ValueError("only models with the identity normal form and all their spaces are supported")
        self.prefix = bool(normal.get(3, 1))
        self.pieces = [p for p, _, _ in pieces]
        plain = [(p, s, i) for i, (p, s, k) in enumerate(pieces) if k not in (UNKNOWN, CONTROL, BYTE)]
        if any(SPACE in p.lstrip(SPACE) for p, _, _ in plain):
            raise ValueError("a piece spans a space")
        self.longest = max(len(p) for p, _, _ in plain)
        keys = np.array([self.key(p) for p, _, _ in plain], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a key")
        # where the sorted keys with each beginning of 20 bits start; most beginnings have none
        self.first = np.searchsorted(self.keys, np.arange((1 << 20) + 1, dtype=np.uint64) << np.uint64(44)).astype(np.int32)
        self.first[-1] = len(self.keys)
        self.fill = int(np.diff(self.first).max())
        self.maybe = np.diff(self.first) > 0
        self.scores = np.array([s for _, s, _ in plain], float)[order]
        self.ids = np.array([i for _, _, i in plain], np.int64)[order]
        self.unknown = next((i for i, (_, _, k) in enumerate(pieces) if k == UNKNOWN), 0)
        self.bytes_at = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.raw = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.replace(SPACE, " ").encode() for p, _, k in pieces]
        self.penalty = float(self.scores[self.scores > -1e8].min()) - 10.0
        self.by_text = {p: (s, i) for p, s, i in plain}
        self.power = np.cumprod(np.full(max(LONG, self.longest) + 2, _BASE, np.uint64), dtype=np.uint64)
        self.power = np.concatenate([[np.uint64(1)], self.power])
        self.known: dict[str, dict[str, bytes]] = {"viterbi": {}, "merges": {}}

    @staticmethod
    def key(piece: str) -> np.uint64:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) % (1 << 64)
        return np.uint64((h ^ len(piece) << 56) * int(_SPREAD) % (1 << 64))

    def hits(self, hashes: np.ndarray, lengths: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """The flat places of the substrings that are pieces, and their rows of the sorted keys."""
        k = hashes ^ (np.asarray(lengths, np.uint64) << np.uint64(56))
        k *= _SPREAD
        k = k.reshape(-1)
        head = (k >> np.uint64(44)).astype(np.int32)
        some = np.flatnonzero(self.maybe[head])
        left, at = k[some], self.first[head[some]]
        row = np.full(len(some), -1, np.int64)
        for step in range(self.fill):
            hit = self.keys[np.minimum(at + step, len(self.keys) - 1)] == left
            row[hit] = at[hit] + step
        found = row >= 0
        return some[found], row[found]

    def probe(self, hashes: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        """Rows of the sorted keys at which substrings stand, or -1."""
        out = np.full(hashes.shape, -1, np.int64)
        place, row = self.hits(hashes, lengths)
        out.reshape(-1)[place] = row
        return out

    # words: equal length, as code points
    def viterbi(self, words: np.ndarray) -> list[bytes]:
        """The ids of each word's best pieces."""
        w, n = words.shape
        text = np.ascontiguousarray(words.T)  # a row for each place: all that a step reads lies together
        prefix = np.zeros((n + 1, w), np.uint64)
        for j in range(n):
            prefix[j + 1] = prefix[j] * _BASE + text[j] + np.uint64(1)
        best, back = np.full((n + 1, w), -np.inf), np.zeros((n + 1, w), np.int64)
        piece = np.full((n + 1, w), -1, np.int64)
        best[0] = 0
        rows = np.arange(w)
        for j in range(1, n + 1):
            most = min(self.longest, j)
            lengths = np.arange(most, 0, -1)  # the longest first: it wins ties
            hashes = prefix[j] - prefix[j - most : j] * self.power[lengths][:, None]
            place, at = self.hits(hashes, lengths[:, None])
            total = np.full(most * w, -np.inf)
            total[place] = best[j - most : j].reshape(-1)[place] + self.scores[at]
            which = np.full(most * w, -1, np.int32)
            which[place] = at
            strange = which[-w:] < 0
            total[-w:][strange] = best[j - 1][strange] + self.penalty
            pick = total.reshape(most, w).argmax(0)
            best[j], back[j], piece[j] = total[pick * w + rows], lengths[pick], which[pick * w + rows]
        symbols, count, at = np.zeros((w, n), np.int64), np.zeros(w, np.int64), np.full(w, n)
        live = rows
        while len(live):
            here = at[live]
            p = piece[here, live]
            symbols[live, n - 1 - count[live]] = np.where(p >= 0, p, -1 - text[here - 1, live].astype(np.int64))
            count[live] += 1
            at[live] = here - back[here, live]
            live = live[at[live] > 0]
        strange = (symbols < 0).any(1).tolist()
        return [self._ids(symbols[k, n - c :]) if strange[k] else ids[4 * (n - c) :] for k, (c, ids) in enumerate(zip(count.tolist(), self._rows(symbols), strict=True))]

    def merges(self, words: np.ndarray) -> list[bytes]:
        """As ``viterbi``, by the BPE rule."""
        w, n = words.shape
        if n > LONG:
            return [self._ids(self._heap("".join(map(chr, row.tolist())))) for row in words]
        # flat tables of w rows and n + 1 places; the last place of a row stands for no symbol
        m = n + 1
        h, size = np.zeros((w, m), np.uint64), np.zeros((w, m), np.int64)
        h[:, :n], size[:, :n] = words + np.uint64(1), 1
        sym = np.full((w, m), _GONE)
        sym[:, :n] = self.probe(h[:, :n], 1)
        first = sym[:, :n]
        first[first < 0] = -1 - words[first < 0].astype(np.int64)
        score = np.full((w, m), -np.inf, np.float32)
        base = np.arange(w) * m
        nxt, prv = np.tile(np.arange(1, m + 1), (w, 1)) + base[:, None], np.tile(np.arange(-1, n), (w, 1)) + base[:, None]
        into = np.full(w * m, -1, np.int64)
        rows, (h, size, sym, nxt, prv, flat) = score, (x.reshape(-1) for x in (h, size, sym, nxt, prv, score))

        def pairs(c: np.ndarray) -> None:
            """Scores the symbols at the places ``c`` with what follows them."""
            d = nxt[c]
            nb = size[d]
            both = size[c] + nb
            at = self.probe(h[c] * self.power[np.minimum(nb, self.longest)] + h[d], both)
            at[(nb == 0) | (both > self.longest)] = -1
            into[c] = at
            flat[c] = np.where(at >= 0, self.scores[at], -np.inf)

        if n > 1:
            pairs((base[:, None] + np.arange(n - 1)).ravel())
        live = np.arange(w)
        while len(live):
            c = base[live] + (rows[live] if len(live) < w else rows).argmax(1)
            going = flat[c] > -np.inf
            live, c = live[going], c[going]
            d = nxt[c]
            sym[c] = into[c]
            h[c] = h[c] * self.power[size[d]] + h[d]
            size[c] += size[d]
            sym[d], flat[d] = _GONE, -np.inf
            after = nxt[d]
            nxt[c] = after
            prv[after] = c
            pairs(c)
            before = prv[c]
            pairs(before[before >= base[live]])
        rows = sym.reshape(w, m)[:, :n]
        alive = rows != _GONE
        strange = ((rows < 0) & alive).any(1)
        data = self.ids[np.maximum(rows[alive], 0)].astype("<u4").tobytes()
        ends = 4 * np.cumsum(alive.sum(1))
        return [self._ids(rows[k][alive[k]]) if odd else data[lo:hi] for k, (odd, lo, hi) in enumerate(zip(strange.tolist(), [0, *ends.tolist()], ends.tolist(), strict=False))]

    def _heap(self, word: str) -> list[int]:
        text = list(word)
        nxt, prv = [*range(1, len(text)), -1], [*range(-1, len(text) - 1)]
        heap: list[tuple[float, int, int, int]] = []

        def push(a: int) -> None:
            b = nxt[a]
            if b >= 0 and len(text[a]) + len(text[b]) <= self.longest and (got := self.by_text.get(text[a] + text[b])):
                heapq.heappush(heap, (-got[0], a, len(text[a]), len(text[b])))

        for a in range(len(text)):
            push(a)
        while heap:
            _, a, na, nb = heapq.heappop(heap)
            b = nxt[a]
            if b < 0 or len(text[a]) != na or len(text[b]) != nb:
                continue
            text[a], text[b] = text[a] + text[b], ""
            nxt[a] = nxt[b]
            if nxt[b] >= 0:
                prv[nxt[b]] = a
            push(a)
            if prv[a] >= 0:
                push(prv[a])
        place = {int(i): r for r, i in enumerate(self.ids)}
        return [place[self.by_text[t][1]] if t in self.by_text else -1 - ord(t) for t in text if t]

    def _rows(self, symbols: np.ndarray) -> list[bytes]:
        """The ids of each row of symbols; meaningless for those that are no pieces."""
        data, n = self.ids[np.maximum(symbols, 0)].astype("<u4").tobytes(), 4 * symbols.shape[1]
        return [data[k : k + n] for k in range(0, len(data), n)]

    def _ids(self, symbols: np.ndarray | list[int]) -> bytes:
        """Ids of symbols: rows of the sorted keys, or minus the code point less 1."""
        out: list[int] = []
        for s in map(int, symbols):
            if s >= 0:
                out.append(int(self.ids[s]))
            elif self.bytes_at:
                out += [self.bytes_at[b] for b in chr(-1 - s).encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return np.array(out, "<u4").tobytes()

    def words(self, text: str) -> list[str]:
        """The units of a text, each without its first space mark."""
        if not text:
            return []
        if SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        marked = (" " + text if self.prefix else text).replace(" ", SPACE)
        return [u[1:] for u in _UNIT.findall(marked)]

    def encode_all(self, texts: list[str | None], rule: str = "viterbi") -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        known = self.known[rule]
        cut = [self.words(t or "") for t in texts]
        used: set[str] = set().union(*cut)
        own = dict(zip(used, map(known.get, used), strict=True))  # small, so the texts' lookups stay in the CPU's caches
        new = [u for u, ids in own.items() if ids is None]
        if new:
            found = self.learn(new, rule)
            own.update(found)
            if len(known) + len(new) > MOST_WORDS:
                known.clear()
            known.update(found)
        get = own.__getitem__
        return [b"".join(map(get, units)) for units in cut]

    def encode(self, text: str | None, rule: str = "viterbi") -> bytes:
        return self.encode_all([text], rule)[0]

    def learn(self, words: list[str], rule: str) -> dict[str, bytes]:
        """The ids of words, those of one length together."""
        found, by = {}, {}
        for u in words:
            by.setdefault(len(u), []).append(u)
        f = self.viterbi if rule == "viterbi" else self.merges
        for n, same in sorted(by.items()):
            step = max(1, min(TOGETHER, 1_000_000 // (n + 1)))
            for lo in range(0, len(same), step):
                part = same[lo : lo + step]
                flat = codes(SPACE + SPACE.join(part)).astype(np.uint64).reshape(len(part), n + 1)
                found.update(zip(part, f(flat), strict=True))
        return found

    def decode(self, ids: bytes) -> str:
        out = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
        return out[1:] if self.prefix and out.startswith(" ") else out


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """One model for each worker process."""
    return Model(path)


def encode(docs: DataFrame, path: str, rule: str = "viterbi", column: str = "ids") -> DataFrame:
    """(doc_id, n_tokens, ids) of (doc_id, text) rows; ids as an array of integers."""

    light(docs.sparkSession)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo in range(0, len(texts), 256):
                part = texts[lo : lo + 256]
                ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in m.encode_all(part, rule)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo : lo + 256], pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "n_tokens", column])

    schema = ", ".join([f"doc_id {docs.schema['doc_id'].dataType.simpleString()}", "n_tokens long", f"{column} array<int>"])
    return docs.select("doc_id", "text").mapInArrow(apply, schema)


def decode(tokens: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """(doc_id, text) of (doc_id, ids) rows; null ids give null."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            texts = [None if ids is None else m.decode(np.array(ids, "<u4").tobytes()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", column).mapInArrow(apply, f"doc_id {tokens.schema['doc_id'].dataType.simpleString()}, text string")


def digests(docs: DataFrame, path: str, rule: str = "viterbi") -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, decoded_chars, decoded_sha256, round_trip): of the ids, and of the text decoded from them."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part, rows = batch.column(1)[lo : lo + 256].to_pylist(), []
                for t, ids in zip(part, m.encode_all(part, rule), strict=True):
                    back = m.decode(ids)
                    rows.append((len(ids) // 4, zlib.crc32(ids), len(back), hashlib.sha256(back.encode()).hexdigest(), back == (t or "").replace(SPACE, " ")))
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo : lo + 256], *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["doc_id", "n_pieces", "ids_crc32", "decoded_chars", "decoded_sha256", "round_trip"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_pieces long, ids_crc32 long, decoded_chars long, decoded_sha256 string, round_trip boolean"
    return docs.select("doc_id", "text").mapInArrow(apply, schema)
