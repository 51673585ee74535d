"""Media columns: GIF decoding and lossless storage of bytes as GIF frames.

``decode`` reads a GIF's LZW code streams (any minimum code size, deferred clears, interlacing), applies global and
local palettes, transparency and the four disposal methods, and gives timed frames: delay, place, the composed
canvas. ``frame_table`` turns a column of GIFs into one row for each frame with colour-histogram columns. ``store``
writes bytes as grey samples, 64 to a row and ``ROWS`` rows to a frame, each frame with its delay, and ``restore``
gets them back through ``decode``.

Decoding a run of codes: after a clear, entry 258 + e is the e-th code's string and the next code's first byte,
and these lie next to each other in the output, so each code copies a stretch of the output.

Rows: one for each input row. A null text counts as empty; its payload is 64 zero bytes. Repeated rows stay; equal
texts give equal values. Other columns are ignored. A media value that is null or no GIF gives no frames. A damaged
GIF (cut off, codes before their entries, too few samples) gives the frames before the damage and one row with the
message in ``error``. A missing trailer is no damage.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

WIDTH, ROWS = 64, 4096
#: Hundredths of a second for which a stored frame shows.
DELAY = 4
#: Pixels of the largest canvas or frame that is decoded (a larger one counts as damage): a bound on memory.
MOST_PIXELS = 1 << 27
_GREY = bytes(v for g in range(256) for v in (g, g, g))


def lzw_encode(data: bytes) -> bytes:
    """The LZW code stream of 8-bit samples, with a clear whenever the table is full."""
    codes, table, free = [256], {}, 258
    get, emit = table.get, codes.append
    cur = -1
    for b in data:
        if cur < 0:
            cur = b
            continue
        key = cur << 8 | b
        code = get(key)
        if code is not None:
            cur = code
        else:
            emit(cur)
            if free < 4096:
                table[key] = free
                free += 1
            else:
                emit(256)
                table.clear()
                free = 258
            cur = b
    if cur >= 0:
        emit(cur)
    emit(257)
    return _packed(np.array(codes, np.int64))


def _widths(nth: np.ndarray, least: int) -> np.ndarray:
    """Bits of the n-th code after a clear, for codes that start at ``least`` bits."""
    free = (1 << (least - 1)) + 2 + np.maximum(nth - 1, 0)
    return np.clip(np.floor(np.log2(free)).astype(np.int64) + 1, least, 12)


def _packed(codes: np.ndarray) -> bytes:
    clear = np.flatnonzero(codes == 256)
    i = np.arange(len(codes))
    since = i - clear[np.searchsorted(clear, i - 1, side="right") - 1] - 1  # the last clear before each code
    since[0] = 0
    width = _widths(since, 9)
    at = np.cumsum(width) - width
    value, byte = codes << (at & 7), at >> 3
    n = int(byte[-1]) + 4
    out = sum(np.bincount(byte + k, (value >> (8 * k)) & 255, n) for k in range(3)).astype(np.uint8)
    return out[: (int(at[-1] + width[-1]) + 7) // 8].tobytes()


def lzw_decode(stream: bytes, least: int, most: int) -> bytes:
    """Samples of a code stream whose codes start at ``least`` + 1 bits; at most ``most`` samples, as images have."""
    clear, bits = 1 << least, 8 * len(stream)
    raw = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.int64)
    out, at, window = bytearray(), 0, 4096
    width = _widths(np.arange(window), least + 1)
    while at < bits and len(out) < most:
        offset = at + np.cumsum(width) - width
        fit = int(np.searchsorted(offset + width, bits, side="right"))
        byte = offset[:fit] >> 3
        word = raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16
        codes = (word >> (offset[:fit] & 7)) & ((1 << width[:fit]) - 1)
        stop = np.flatnonzero((codes == clear) | (codes == clear + 1))
        if not len(stop) and fit == len(width):  # no clear in sight: look further
            width = _widths(np.arange(2 * len(width)), least + 1)
            continue
        n = int(stop[0]) if len(stop) else fit
        begins: list[int] = []
        add = begins.append
        for i, c in enumerate(codes[:n].tolist()):
            here = len(out)
            add(here)
            if c < clear:
                out.append(c)
            else:
                e = c - clear - 2
                if e >= i or e < 0:
                    raise ValueError("a code before its entry")
                out += out[begins[e] : begins[e + 1] + 1]
                if e + 1 == i:
                    out.append(out[begins[e]])
        if not len(stop) or codes[n] == clear + 1:
            break
        at = int(offset[n] + width[n])
        width = width[:window]
    return bytes(out[:most])


def _blocks(data: bytes) -> bytes:
    """Data in sub-blocks of at most 255 bytes."""
    full = b"".join(b"\xff" + data[k : k + 255] for k in range(0, len(data) - len(data) % 255, 255))
    rest = data[len(data) - len(data) % 255 :]
    return full + (bytes([len(rest)]) + rest if rest else b"") + b"\0"


def _unblocked(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while n := data[at]:
        parts.append(data[at + 1 : at + 1 + n])
        at += n + 1
    return b"".join(parts), at + 1


def store(payload: bytes) -> bytes:
    """A GIF whose frames hold ``payload`` (a multiple of 64 bytes) as grey samples."""
    rows = len(payload) // WIDTH
    out = [b"GIF89a", struct.pack("<HHBBB", WIDTH, min(rows, ROWS), 0xF7, 0, 0), _GREY]
    for top in range(0, rows, ROWS):
        part = payload[WIDTH * top : WIDTH * (top + ROWS)]
        out += [b"\x21\xf9\x04", struct.pack("<BHB", 2 << 2, DELAY, 0), b"\0", b"\x2c", struct.pack("<HHHHB", 0, 0, WIDTH, len(part) // WIDTH, 0), b"\x08", _blocks(lzw_encode(part))]
    return b"".join([*out, b"\x3b"])


@dataclass
class Frame:
    delay: int
    left: int
    top: int
    width: int
    height: int
    canvas: np.ndarray  # rows x columns x RGB as shown
    shown: np.ndarray  # rows x columns, false where nothing has been drawn

    def histogram(self, bits: int = 2) -> np.ndarray:
        """Counts of the frame's own area by colour, ``bits`` to a channel."""
        own = self.canvas[self.top : self.top + self.height, self.left : self.left + self.width].astype(np.int64) >> (8 - bits)
        return np.bincount((own[..., 0] << 2 * bits | own[..., 1] << bits | own[..., 2]).ravel(), minlength=1 << 3 * bits)


def decode(data: bytes) -> Iterator[Frame]:
    """The timed frames of a GIF, each as shown; where it is damaged, a ValueError after the frames before that place."""
    try:
        yield from _frames(data)
    except (IndexError, OverflowError, struct.error, ValueError) as e:
        raise ValueError(f"damaged GIF: {e}") from e


def _frames(data: bytes) -> Iterator[Frame]:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("no GIF")
    w, h, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    at, common = 13, None
    if flags & 0x80:
        n = 3 << ((flags & 7) + 1)
        common, at = np.frombuffer(data, np.uint8, n, at).reshape(-1, 3), at + n
    if w * h > MOST_PIXELS:
        raise ValueError(f"a canvas of {w} x {h}")
    canvas, shown = np.zeros((h, w, 3), np.uint8), np.zeros((h, w), bool)
    delay, disposal, clear_index, awaited = 0, 0, None, False
    while at < len(data):
        kind, at = data[at], at + 1
        if kind == 0x3B:
            return
        if kind == 0x21:
            label, at = data[at], at + 1
            body, at = _unblocked(data, at)
            if label == 0xF9 and len(body) >= 4:
                packed, delay, index = struct.unpack_from("<BHB", body)
                disposal, clear_index, awaited = packed >> 2 & 7, index if packed & 1 else None, True
            continue
        if kind != 0x2C:
            raise ValueError(f"block {kind:#x}")
        left, top, fw, fh, flags = struct.unpack_from("<HHHHB", data, at)
        at, palette = at + 9, common
        if flags & 0x80:
            n = 3 << ((flags & 7) + 1)
            palette, at = np.frombuffer(data, np.uint8, n, at).reshape(-1, 3), at + n
        least = data[at]
        if not 1 <= least <= 8:
            raise ValueError(f"codes of {least} bits")
        if fw * fh > MOST_PIXELS:
            raise ValueError(f"a frame of {fw} x {fh}")
        stream, at = _unblocked(data, at + 1)
        samples = np.frombuffer(lzw_decode(stream, least, fw * fh), np.uint8)
        if len(samples) < fw * fh:
            raise ValueError(f"{len(samples)} of {fw * fh} samples")
        samples = samples.reshape(fh, fw)
        if flags & 0x40:
            order = np.concatenate([np.arange(0, fh, 8), np.arange(4, fh, 8), np.arange(2, fh, 4), np.arange(1, fh, 2)])
            samples = samples[np.argsort(order)]
        if palette is None:
            palette = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 3, 1)
        if len(palette) < 256:
            palette = np.concatenate([palette, np.zeros((256 - len(palette), 3), np.uint8)])
        before = (canvas.copy(), shown.copy()) if disposal == 3 else None
        samples = samples[: max(0, h - top), : max(0, w - left)]
        area = (slice(top, top + samples.shape[0]), slice(left, left + samples.shape[1]))
        if clear_index is None:
            canvas[area], shown[area] = palette[samples], True
        else:
            drawn = samples != clear_index
            canvas[area][drawn], shown[area] = palette[samples][drawn], shown[area] | drawn
        yield Frame(delay, left, top, samples.shape[1], samples.shape[0], canvas.copy(), shown.copy())
        if disposal == 2:
            canvas[area], shown[area] = 0, False
        elif before:
            canvas, shown = before
        delay, disposal, clear_index, awaited = 0, 0, None, False
    if awaited:
        raise ValueError("no image after its control block")


def restore(media: bytes) -> tuple[bytes, np.ndarray]:
    """The payload that ``store`` put in, and the frames' summed colour histogram."""
    parts, total = [], 0
    for f in decode(media):
        parts.append(f.canvas[f.top : f.top + f.height, f.left : f.left + f.width, 0].tobytes())
        total = total + f.histogram(4)
    return b"".join(parts), total


def frame_table(media: DataFrame, id_col: str, gif_col: str) -> DataFrame:
    """One row for each frame of each GIF: its time, place and histogram; ``bins`` has 64 colours, two bits to a channel.

    A damaged GIF has one more row, with nulls and the damage in ``error``, which is null elsewhere.
    """
    names = ["frame", "starts_cs", "delay_cs", "width", "height", "bins", "error"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.string()]
    schema = media.select(F.col(id_col).alias("id")).schema
    for name, kind in zip(names, ["integer", "long", "integer", "integer", "integer", ArrayType(LongType()), "string"], strict=True):
        schema = schema.add(name, kind)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, gif in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                if gif is None or gif[:6] not in (b"GIF87a", b"GIF89a"):
                    continue
                rows, clock = [], 0
                try:
                    for n, f in enumerate(decode(gif)):
                        rows.append((n, clock, f.delay, f.width, f.height, f.histogram().tolist(), None))
                        clock += f.delay
                except ValueError as e:
                    rows.append((*[None] * 6, str(e)))
                if rows:
                    cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array([k.as_py()] * len(rows), batch.column(0).type), *cols], names=["id", *names])

    return media.select(F.col(id_col).alias("id"), F.col(gif_col).alias("gif")).mapInArrow(frames, schema)


def payload_of(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.ljust(max(1, -(-len(raw) // WIDTH)) * WIDTH, b"\0"), len(raw)


def store_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): the texts of (doc_id, text) rows as GIFs."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo in range(0, len(texts), 256):
                got = [payload_of(t) for t in texts[lo : lo + 256]]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo : lo + 256], pa.array([n for _, n in got], pa.int64()), pa.array([store(p) for p, _ in got], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(apply, docs.select("doc_id").schema.add("n_bytes", "long").add("media", "binary"))


def features(media: DataFrame) -> DataFrame:
    """Reads stored GIFs of (doc_id, n_bytes, media) back: digests of the payload and of the media, and the histogram as bin:count."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for gif in batch.column(2).to_pylist():
                payload, bins = restore(gif)
                filled = np.flatnonzero(bins)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(gif), hashlib.sha256(gif).hexdigest(), " ".join(f"{b}:{bins[b]}" for b in filled)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    schema = media.select("doc_id", "n_bytes").schema
    for name, kind in (("payload_bytes", "long"), ("payload_sha256", "string"), ("tail_crc32", "long"), ("media_bytes", "long"), ("media_sha256", "string"), ("feature", "string")):
        schema = schema.add(name, kind)
    return media.select("doc_id", "n_bytes", "media").mapInArrow(apply, schema)
