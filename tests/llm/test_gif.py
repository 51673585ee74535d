import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewheel.llm import gif_media as G


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000))
def test_lzw_round_trip(data):
    assert G.lzw_decode(G.lzw_encode(data), 8, len(data)) == data


@pytest.mark.parametrize("data", [b"", b"\0" * 64 * 9000, b"ab" * 40_000, bytes(range(256)) * 300, np.random.default_rng(0).bytes(64 * 5000)])
def test_store_round_trip(data):
    payload, _ = G.payload_of(data.decode("latin-1"))
    assert G.restore(G.store(payload))[0] == payload


def plain_lzw(stream, least):
    """A decoder with a table of strings, bit by bit."""
    bits = [b >> k & 1 for b in stream for k in range(8)]
    clear, out, at, width, table, old = 1 << least, b"", 0, least + 1, {}, None
    while at + width <= len(bits):
        code = sum(bits[at + k] << k for k in range(width))
        at += width
        if code == clear:
            table, width, old = {k: bytes([k]) for k in range(clear)} | {clear: None, clear + 1: None}, least + 1, None
            continue
        if code == clear + 1:
            break
        if old is None:
            s = table[code]
        else:
            s = table.get(code) or old + old[:1]
            if len(table) < 4096:
                table[len(table)] = old + s[:1]
                if len(table) == 1 << width and width < 12:
                    width += 1
        out += s
        old = s
    return out


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 5), st.integers(1, 6000))
def test_decoder_agrees_with_a_plain_one(seed, n):
    data = np.random.default_rng(seed).integers(0, 1 + 3 * seed, n).astype(np.uint8).tobytes()
    stream = G.lzw_encode(data)
    assert plain_lzw(stream, 8) == data == G.lzw_decode(stream, 8, n)


def frame(pixels, w, h, left=0, top=0, palette=None, disposal=0, clear=None, delay=5, interlace=False):
    """A frame with 2-bit samples and a clear before every code, so that no table is needed."""
    bits = []
    for p in pixels:
        bits += [f"{4:03b}"[::-1], f"{p:03b}"[::-1]]
    bits.append(f"{5:03b}"[::-1])
    text = "".join(bits)
    text += "0" * (-len(text) % 8)
    data = bytes(int(text[k : k + 8][::-1], 2) for k in range(0, len(text), 8))
    gce = b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (clear is not None), delay, clear or 0) + b"\0"
    flags = (0x81 if palette else 0) | (0x40 if interlace else 0)
    return gce + b"\x2c" + struct.pack("<HHHHB", left, top, w, h, flags) + (bytes(v for c in palette for v in c) if palette else b"") + b"\x02" + bytes([len(data)]) + data + b"\0"


RED, GREEN, BLUE, WHITE = (255, 0, 0), (0, 255, 0), (0, 0, 255), (255, 255, 255)
HEAD = b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0x81, 0, 0) + bytes(v for c in (RED, GREEN, BLUE, WHITE) for v in c)


def shown(gif):
    return [(f.delay, [tuple(map(int, p)) for p in f.canvas.reshape(-1, 3)]) for f in G.decode(gif)]


def test_palettes_transparency_and_disposal():
    black = (0, 0, 0)
    gif = HEAD + frame([0, 1, 2, 3], 2, 2) + frame([3, 0], 2, 1, top=1, clear=0, disposal=2, delay=7) + frame([1], 1, 1, palette=[BLUE, WHITE, RED, GREEN], disposal=3) + frame([0], 1, 1, left=1) + b"\x3b"
    assert shown(gif) == [
        (5, [RED, GREEN, BLUE, WHITE]),
        (7, [RED, GREEN, WHITE, WHITE]),  # sample 0 is clear
        (5, [WHITE, GREEN, black, black]),  # the second frame's area is cleared, a local palette draws
        (5, [RED, RED, black, black]),  # the third is taken back
    ]


def test_interlace():
    gif = b"GIF89a" + struct.pack("<HHBBB", 1, 8, 0x81, 0, 0) + HEAD[13:] + frame([0, 1, 2, 2, 3, 3, 3, 3], 1, 8, interlace=True) + b"\x3b"
    rows = [p for p in shown(gif)[0][1]]
    assert rows == [RED, WHITE, BLUE, WHITE, GREEN, WHITE, BLUE, WHITE]


def test_no_gif_raises():
    with pytest.raises(ValueError):
        list(G.decode(b"PNG..."))


def test_frame_table(spark):
    gif = HEAD + frame([0, 1, 2, 3], 2, 2) + frame([0], 1, 1, delay=9) + b"\x3b"
    rows = G.frame_table(spark.createDataFrame([(1, bytearray(gif)), (2, None), (3, bytearray(b"junk"))], "id long, gif binary"), "id", "gif").orderBy("frame").collect()
    assert [(r["id"], r["frame"], r["starts_cs"], r["delay_cs"], r["width"], sum(r["bins"])) for r in rows] == [(1, 0, 0, 5, 2, 4), (1, 1, 5, 9, 1, 1)]


def test_features_of_texts(spark):
    rows = [(1, "short"), (2, None), (3, ""), (4, "short"), (None, "ü" * 700_000), (5, "x" * 64)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as media", "2 as n_bytes")
    got = {(r["doc_id"], r["n_bytes"]): r for r in G.features(G.store_texts(df)).collect()}
    assert len(got) == 6
    for i, t in rows:
        raw = (t or "").encode()
        full = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        r = got[i, len(raw)]
        assert (r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]))
        assert sum(int(x.split(":")[1]) for x in r["feature"].split()) == len(full)
    assert got[1, 5][2:] == got[4, 5][2:]
    assert G.features(G.store_texts(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_damaged_gifs_give_their_frames_and_an_error(spark):
    """Cut at every byte, a GIF gives the whole frames before the cut, and a row with the damage unless only the trailer is lost."""
    gif = HEAD + frame([0, 1, 2, 3], 2, 2) + frame([0], 1, 1, delay=9) + b"\x3b"
    first = len(HEAD) + len(frame([0, 1, 2, 3], 2, 2))
    cuts = [(k, bytearray(gif[:k])) for k in range(len(gif) + 1)]
    strange = [(1000, bytearray(gif.replace(b"\x02", b"\x0c"))), (1001, bytearray(G.store(bytes(6400))[:-40])), (1002, bytearray(b"GIF89a" + struct.pack("<HHBBB", 65535, 65535, 0, 0, 0)))]
    got = {}
    for r in G.frame_table(spark.createDataFrame(cuts + strange, "id long, gif binary"), "id", "gif").collect():
        got.setdefault(r["id"], []).append((r["frame"], r["error"] is not None))
    for k, _ in cuts:
        frames = (k >= first) + (k >= len(gif) - 1)
        whole = k in (len(HEAD), first, len(gif) - 1, len(gif))
        assert got.get(k, []) == [(n, False) for n in range(frames)] + ([] if whole or k < 6 else [(None, True)])
    assert all(got[k][-1] == (None, True) for k, _ in strange)
