import math
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewheel.llm import sentencepiece_codec as C

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = ["", " ", "a", "  a  b ", "Hello  world\nfoo\tbar  ", "日本語テスト 😀😀 x", "a" * 700, "the" * 300 + " end", "!" * 300, "naïve café – “quote”", "x\u0000y"]


@pytest.fixture(scope="module")
def model():
    return C.Model(PATH)


@pytest.mark.parametrize("text", TEXTS)
def test_merges_give_the_librarys_ids(model, text):
    ids = model.encode(text, "merges")
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text)
    assert model.decode(ids) == text and model.decode(model.encode(text)) == text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_merges_on_any_text(text):
    model = C.model(PATH)
    text = text.replace(C.SPACE, " ")
    ids = model.encode(text, "merges")
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text)
    assert model.decode(ids) == text and model.decode(model.encode(text)) == text


def plain_viterbi(model, word):
    """The best score, by a loop over all substrings."""
    best = [0.0] + [-math.inf] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(max(0, j - model.longest), j):
            got = model.by_text.get(word[i:j])
            score = got[0] if got else model.penalty if j - i == 1 else -math.inf
            best[j] = max(best[j], best[i] + score)
    return best[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcdehinorst▁é", min_size=5, max_size=5), min_size=1, max_size=8))
def test_viterbi_is_the_best_segmentation(words):
    model = C.model(PATH)
    flat = np.array([[ord(c) for c in w] for w in words], np.uint64)
    for w, ids in zip(words, model.viterbi(flat), strict=True):
        pieces = [model.pieces[i] for i in np.frombuffer(ids, "<u4").tolist()]
        score = sum(model.by_text[p][0] for p in pieces if p in model.by_text)
        unknown = sum(c not in model.by_text for c in w)
        assert score + unknown * model.penalty == pytest.approx(plain_viterbi(model, w))


def test_heap_and_batches_agree(model):
    word = "▁" + "abracadabra the quick".replace(" ", "") * 6
    flat = np.array([[ord(c) for c in word]], np.uint64)
    assert model.merges(flat)[0] == model._ids(model._heap(word))


def test_queries_over_nulls_and_repeats(spark):
    rows = [(1, "some text"), (1, "some text"), (None, "x"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as ids", "1 as n_tokens")
    tokens = C.encode(df, PATH, "merges")
    got = sorted(((r["doc_id"] or 0, list(r["ids"])) for r in tokens.collect()))
    assert got == sorted((i or 0, LIBRARY.encode(t or "")) for i, t in rows)
    assert sorted(r["text"] for r in C.decode(tokens, PATH).collect()) == ["", "", "some text", "some text", "x"]
    assert C.digests(df, PATH).where("not round_trip").count() == 0
    assert C.encode(df.where("false"), PATH).count() == 0
    assert C.decode(C.encode(df, PATH), PATH).count() == 5


def plain_ids(model, word):
    """The ids of the best pieces, by a loop over all substrings; of equal scores the longest last piece."""
    best, back = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
    for j in range(1, len(word) + 1):
        for i in range(max(0, j - model.longest), j):
            got = model.by_text.get(word[i:j])
            score = best[i] + (got[0] if got else model.penalty if j - i == 1 else -math.inf)
            if score > best[j]:
                best[j], back[j] = score, i
    out, j = [], len(word)
    while j:
        piece = word[back[j] : j]
        out.append([model.by_text[piece][1]] if piece in model.by_text else [model.bytes_at[b] for b in piece.encode()])
        j = back[j]
    return [i for ids in reversed(out) for i in ids]


def test_whole_documents_against_plain_viterbi(spark, sf_dir):
    """The registered query's ids of every document, by its CRC, against a plain best-path search."""
    from tidewheel.llm import queries as Q

    model, known = C.model(PATH), {}
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        text = (r["text"] or "").replace(" ", C.SPACE)
        units = C._UNIT.findall(C.SPACE + text) if text else []
        for u in units:
            if u not in known:
                known[u] = plain_ids(model, u)
        ids = [i for u in units for i in known[u]]
        want[r["doc_id"]] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True)
    got = {r["doc_id"]: (r["n_pieces"], r["ids_crc32"], r["round_trip"]) for r in Q.op9_sentencepiece(spark, sf_dir).collect()}
    assert got == want
