import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewheel.llm import separator_scan as S
from tidewheel.llm import token_files as T
from tidewheel.llm.common import scratch_path
from tidewheel.llm.word_tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
ROWS = [(5, "Hello wörld"), (3, None), (3, "twice"), (3, "twice"), (None, "no id"), (8, ""), (1, "a " * 3000), (9, "tail\x01x \x01 <|endoftext|> don't")]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_pieces_give_the_whole_texts_ids(text):
    t = Tokenizer.from_file(PATH) if not hasattr(test_pieces_give_the_whole_texts_ids, "t") else test_pieces_give_the_whole_texts_ids.t
    test_pieces_give_the_whole_texts_ids.t = t
    e = getattr(test_pieces_give_the_whole_texts_ids, "e", None) or Encoder(PATH)
    test_pieces_give_the_whole_texts_ids.e = e
    assert np.frombuffer(e.encode([text])[0], "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = np.zeros(5000, T.KEY)
    keys["id"] = np.arange(5000) * 7919
    levels, slots = T.pack(keys, np.ones(5000, np.int64))
    index = T.PerfectHash.load(levels)
    assert sorted(index.slots(T.key_hash(keys)).tolist()) == list(range(5000))
    found, at, n = T.find(levels, slots, keys)
    assert found.all() and at.tolist() == list(range(5000)) and (n == 1).all()
    other = keys.copy()
    other["id"] += 1
    assert T.find(levels, slots, other)[0].mean() < 0.001
    assert not T.find(*T.pack(keys[:0], np.zeros(0, np.int64)), keys[:3])[0].any()


def expected(tokenizer, end):
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out, start = [], 0
    for i, t in order:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_store_round_trip(spark, tokenizer, monkeypatch):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 as _part", "'x' as keys").repartition(3)
    got = [tuple(r) for r in T.roundtrip(df, PATH).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(tokenizer, 1)


def test_lookup_by_key(spark, tokenizer):
    path = scratch_path(spark, "test-store")
    T.write(spark.createDataFrame(ROWS, "doc_id long, text string"), path, PATH)
    got = sorted((r["doc_id"], r["turn"], list(r["ids"])) for r in T.lookup(spark, path, [3, 5, 777]).collect())
    ids = lambda t: [*tokenizer.encode(t, add_special_tokens=False).ids, 1]
    assert got == [(3, 0, [1]), (3, 1, ids("twice")), (3, 2, ids("twice")), (5, 0, ids("Hello wörld"))]
    assert T.lookup(spark, path, []).count() == 0


def test_lookup_of_an_id_across_blocks(spark, tokenizer):
    """An id whose rows span three blocks, and its neighbours, come back whole."""
    long = "a " * (T.BLOCK // 5)
    rows = [(None, "x"), (6, "first"), *((7, f"{long}{k}") for k in range(10)), (8, "last"), (8, "last one")]
    path = scratch_path(spark, "test-hot-store")
    T.write(spark.createDataFrame(rows, "doc_id long, text string"), path, PATH)
    assert spark.read.schema(T.SCHEMA).parquet(path).where("key_lo <= 7 and key_hi >= 7").count() >= 3
    got = sorted((r["doc_id"], r["turn"], list(r["ids"])) for r in T.lookup(spark, path, [6, 7, 8, 9]).collect())
    texts, want = sorted((i, t) for i, t in rows if i), []
    for k, (i, t) in enumerate(texts):
        want.append((i, sum(j == i for j, _ in texts[:k]), [*tokenizer.encode(t, add_special_tokens=False).ids, 1]))
    assert got == want


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert T.roundtrip(none, PATH).count() == 0
    assert S.counts(none, PATH, 49407).count() == 0


def test_separator_scan_stitches_blocks(spark, tokenizer, monkeypatch):
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    df = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "0 as part", "0 as k").coalesce(2)
    path = scratch_path(spark, "test-flat")
    S.write(df, path, PATH, 49407)
    rows = spark.read.schema(S.SCHEMA).parquet(path).where("block >= 0").collect()
    # the same stream, cut into tiny blocks
    cut = [(r["part"], k // 14, bytes(r["data"][k : k + 14]), None) for r in rows for k in range(0, len(r["data"]), 14)]
    small = scratch_path(spark, "test-flat-cut")
    spark.createDataFrame(cut, S.SCHEMA).write.parquet(small)
    for p in (path, small):
        got = S.scan(spark, p, 49407).join(S.names(spark, path), ["part", "k"]).collect()
        want = sorted(((i is not None, i or 0, t or ""), len(own.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in ROWS)
        assert sorted(r["n_tokens"] for r in got) == sorted(n for _, n in want)
        assert sorted((r["start"] for r in got)) == [sum(r2["n_tokens"] for r2 in got if r2["start"] < r["start"]) for r in sorted(got, key=lambda r: r["start"])]
        single = {r["doc_id"]: r["n_tokens"] for r in got if r["doc_id"] not in (None, 3)}
        assert single == {i: len(own.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in ROWS if i not in (None, 3)}


@pytest.mark.parametrize("dealt", [1, 4])
def test_counts_do_not_depend_on_files(spark, tokenizer, dealt, monkeypatch):
    """Counts and starts against the library's, in ascending doc_id order, however the rows are dealt out."""
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    rows = ROWS + [(100 + k * 7 % 50, f"text {k} " * (k % 9)) for k in range(50)]
    monkeypatch.setattr(S, "BLOCK", 64)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as start", "'x' as part").repartition(dealt, "text")
    path = scratch_path(spark, "test-docs")
    df.write.parquet(path)
    want, start = [], 0
    for i, n in sorted(((i, len(own.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        want.append((i, start, n))
        start += n
    got = sorted(map(tuple, S.counts(spark.read.parquet(path), PATH, 49407).collect()), key=lambda r: r[1])
    assert got == want


def test_registered_counts(spark, sf_dir):
    """op6 over all documents against the library."""
    from tidewheel.llm import queries as Q

    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    start, want = 0, []
    for r in sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect(), key=lambda r: r["doc_id"]):
        n = len(own.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        want.append((r["doc_id"], start, n))
        start += n
    assert sorted(map(tuple, Q.op6_token_counts(spark, sf_dir).collect())) == want


def test_parts_keep_order(spark):
    from tidewheel.llm import common as C

    df = spark.createDataFrame([(None if k % 50 == 0 else k * 37 % 1000, k) for k in range(3000)], "doc_id long, n long")
    for n in (1, 2, 9, 64, 1000):
        own = C.Cuts.__new__(C.Cuts)
        own.key, own.kind, own.cuts = "doc_id", "bigint", sorted({1 + 999 * k // n for k in range(1, n)})
        own.step = max(1, int(np.ceil(len(own.cuts) ** 0.5)))
        own.runs = [own.cuts[i : i + own.step] for i in range(0, len(own.cuts), own.step)]
        got = df.withColumn("p", own.part()).collect()
        assert all(r["p"] == (0 if r["doc_id"] is None else sum(c <= r["doc_id"] for c in own.cuts)) for r in got)
