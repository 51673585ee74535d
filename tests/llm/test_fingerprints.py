import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewheel.llm import edit_embedding as E
from tidewheel.llm.common import codes

SCHEMA = "doc_id long, text string, _part int, fingerprint string"


def plain_walk(text):
    """The walk, one step and one text at a time."""
    level, salts = E.level_of(len(text)), np.random.default_rng(20240817)
    out, at, step = [], 0, 0
    while at < len(text):
        if step % 128 == 0:
            block = salts.integers(1 << 32, size=128, dtype=np.uint32).tolist()
        c = ord(text[at]) * 0x9E3779B1 % (1 << 32)
        c ^= c >> 15
        draw = (c ^ block[step % 128]) * 0x85EBCA77 % (1 << 32)
        if step % (1 << level) == 0 and step >> level < 2 * E.BITS:
            out.append(draw >> 7 & 1)
        at += draw >> 31
        step += 1
    return level, out


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=400), min_size=1, max_size=5))
def test_walk_matches_the_plain_one(texts):
    texts = [*texts, "".join(texts) * 5]
    for (level, bits), t in zip(E.walk([codes(t) for t in texts]), texts, strict=True):
        assert (level, bits.tolist()) == plain_walk(t)


def test_text_form_round_trip():
    level, bits = E.walk([codes("some text with some words " * 30)])[0]
    got = E.bits_of(E.text_of(level, bits))
    assert got[0] == level and got[1].tolist() == bits.tolist()


def test_likeness_follows_edits():
    rng = np.random.default_rng(0)
    base = "".join(rng.choice(list("abcdefgh "), 3000))
    near = base[:1000] + "xyz" + base[1000:2000] + base[2005:]
    other = "".join(rng.choice(list("abcdefgh "), 3000))
    a, b, c, e = (E.walk([codes(t)])[0] for t in (base, near, other, ""))
    assert E.likeness(a, a) == 1 and E.likeness(a, b) > 0.7 and E.likeness(a, c) < 0.3
    assert E.likeness(e, e) == 1 and E.likeness(a, e) == 0
    assert E.likeness(a, b) == E.likeness(b, a)


def test_with_next_nulls_ties_and_clashing_columns(spark):
    rows = [(3, "ghijkl" * 3, 7, "x"), (None, "nullid", 1, "x"), (1, None, 2, "x"), (2, "abcdef" * 4, 3, "x"), (2, "abc", 3, "x"), (9, "", 0, "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(((-1 if r["doc_id"] is None else r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in E.with_next(df).collect()))
    order = [(-1, "nullid"), (1, ""), (2, "abc"), (2, "abcdef" * 4), (3, "ghijkl" * 3), (9, "")]
    want = []
    for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        k = len(t) // 4
        want.append((i, len(t), hashlib.sha256((t[: len(t) - k] + n[:k]).encode()).hexdigest()))
    assert got == sorted(want)


def test_with_next_of_one_row_and_none(spark):
    one = E.with_next(spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert E.with_next(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_equal_texts_have_equal_fingerprints(spark):
    df = spark.createDataFrame([(i, "same text " * (1 + i % 3)) for i in range(30)], "doc_id long, text string").repartition(5)
    by = {}
    for r in E.fingerprints(df).collect():
        by.setdefault(r["sha256"], set()).add(r["fingerprint"])
    assert len(by) == 3 and all(len(v) == 1 for v in by.values())


def test_near_classes(spark):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    base = [" ".join(word() for _ in range(200)) for _ in range(6)]
    rows = [(i, b) for i, b in enumerate(base)] + [(10 + i, b) for i, b in enumerate(base[:3])]
    rows += [(20 + i, b[:700] + "zz" + b[703:]) for i, b in enumerate(base)] + [(30, None), (31, ""), (None, "lost")]
    got = {r["doc_id"]: r["class_id"] for r in E.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), threshold=0.6, walks=3).collect()}
    assert all(got[i] == i for i in range(6)) and all(got[10 + i] == i for i in range(3)) and all(got[20 + i] == i for i in range(6))
    assert got[30] == got[31] == 30 and got[None] is None


def joined_pairs(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return root


def edited_copies(n_texts=90, seed=11):
    """Texts near the upper end of a level, and copies of which a part at the start, middle or end is replaced."""
    rng = np.random.default_rng(seed)
    make = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrst "), n))
    rows = []
    for i in range(n_texts):
        n = (1000, 2000, 240)[i % 3]
        text, k = make(n), n // (4, 8, 12)[i // 9 % 3]
        at = (0, (n - k) // 2, n - k)[i // 3 % 3]
        rows += [(2 * i, text), (2 * i + 1, text[:at] + make(k) + text[at + k :])]
    return rows


def test_signs_give_the_likeness():
    prints = [w for w in E.walk([codes(""), codes("ab"), codes("abc" * 900), codes("")] + [codes(t) for _, t in edited_copies(13)])]
    every = np.arange(len(prints))
    for threshold in (0.3, 0.8):
        a, b = E.alike(prints, every, every, threshold)
        want = {(i, j) for i in every for j in every if E.likeness(prints[i], prints[j]) >= threshold}
        assert set(zip(a.tolist(), b.tolist(), strict=True)) == want
        some, unit = prints[:29], np.arange(29) // 10
        a, b = E.near_pairs(some, unit < 2, unit, threshold)
        assert set(zip(a.tolist(), b.tolist(), strict=True)) == {(i, j) for i, j in want if i < j < 20 and unit[i] == unit[j]}


def test_classes_against_all_pairs(spark):
    """Edits anywhere in a text are found alike often; nothing below the threshold is joined."""
    rows = edited_copies(150)
    prints = dict(zip((i for i, _ in rows), E.walk([codes(t) for _, t in rows]), strict=True))
    pairs = [(a, b) for a in prints for b in prints if a < b and E.likeness(prints[a], prints[b]) >= 0.8]
    got = {r["doc_id"]: r["class_id"] for r in E.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    root = joined_pairs(pairs)
    assert all(root(i) == root(c) for i, c in got.items())  # only verified links
    for third in range(3):
        own = [p for p in pairs if p[0] // 2 // 3 % 3 == third]
        assert len(own) >= 12 and sum(got[a] == got[b] for a, b in own) >= 0.9 * len(own)


def test_several_walks_find_more(spark):
    rows = edited_copies(30, 5)
    one, three = ({r["doc_id"]: r["class_id"] for r in E.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), walks=w).collect()} for w in (1, 3))
    assert all(three[i] == three[c] for i, c in one.items())
    assert E.near_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_recall_of_the_registered_query(spark):
    """class_id of op1 over all documents against the likeness of all pairs of its fingerprints: 0.9 of the pairs or more."""
    from tidewheel.llm import queries as Q

    rows = Q.op1_edit_embedding(spark, "/root/testdata/sf0.01").collect()
    prints = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        prints.setdefault(r["fingerprint"], r["doc_id"])
    ids, bits = list(prints.values()), [E.bits_of(p) for p in prints]
    every = np.arange(len(ids))
    a, b = E.alike(bits, every, every, 0.8)
    pairs = [(ids[x], ids[y]) for x, y in zip(a.tolist(), b.tolist(), strict=True) if x < y]
    got, root = {r["doc_id"]: r["class_id"] for r in rows}, joined_pairs(pairs)
    assert len(pairs) >= 5 and sum(got[x] == got[y] for x, y in pairs) >= 0.9 * len(pairs)
    own = {r["doc_id"]: prints[r["fingerprint"]] for r in rows}
    assert all(root(own[i]) == root(c) for i, c in got.items())
    print("recall", sum(got[x] == got[y] for x, y in pairs) / len(pairs), len(pairs))
