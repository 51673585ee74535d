import random
import re

import numpy as np
import pytest

from tidewheel.llm import linking as L
from tidewheel.llm import near_dedup as N

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain(rows, percent):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(sets_of(t))
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return sorted((i, len(sets_of(t)), root(i) if sets_of(t) else i, (root(i) if sets_of(t) else i) == i) for i, t in rows)


def corpus(seed=0):
    """Copies, chains of ever more edited copies, shared passages and short texts."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(4000)]
    make = lambda n: [r.choice(words) for _ in range(n)]
    passage, out = make(60), []
    for _ in range(25):
        base = make(r.randint(6, 150))
        if r.random() < 0.4:
            base += passage
        out.append(base)
        for _ in range(r.randint(0, 4)):
            base = list(base)
            base[r.randrange(len(base))] = r.choice(words)
            out.append(base)
    out += [make(k) for k in range(6)] + [out[0], out[0], out[3]]
    texts = [" ".join(w) for w in out]
    texts += ["", None, "  \t\n ", "One two THREE", "one two\tthree", texts[5].upper(), texts[5].replace(" ", "\n")]
    ids = list(range(len(texts)))
    r.shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("seed", [0, 1])
def test_matches_all_pairs(spark, seed, percent):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as node", "2 as key").repartition(4)
    got = sorted(tuple(r) for r in N.near_duplicates(df, percent).collect())
    assert got == plain(rows, percent)


def test_common_values_and_blocks(spark, monkeypatch):
    """Lists above the limit of common values, cut into several blocks, lose no link."""
    monkeypatch.setattr(N, "COMMON", 6)
    monkeypatch.setattr(N, "BLOCK", 4)
    r = random.Random(3)
    words = [f"w{k}" for k in range(3000)]
    base, rows = [r.choice(words) for _ in range(90)], []
    for i in range(60):  # a large group of copies, edited more or less
        own = list(base)
        for _ in range(r.choice([1, 1, 2, 3, 5, 9])):
            own[r.randrange(len(own))] = r.choice(words)
        rows.append((i, " ".join(own)))
    for i in range(60, 90):  # different texts with a passage of it
        rows.append((i, " ".join([r.choice(words) for _ in range(80)] + base[:30])))
    got = sorted(tuple(x) for x in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 80).collect())
    assert got == plain(rows, 80)


def test_shuffle_join_gives_the_same(spark):
    rows = corpus(2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in N.near_duplicates(df, 85, few=0).collect()) == plain(rows, 85)


def test_null_ids_repeated_ids_and_empty(spark):
    text = " ".join(f"x{k}" for k in range(40))
    rows = [(1, text), (None, text), (1, text), (2, text), (7, None)]
    got = sorted(((r["doc_id"] or 0), r["component_id"], r["kept"]) for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, None, True), (1, 1, True), (1, 1, True), (2, 1, False), (7, 7, True)]
    assert N.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_text(spark):
    long = " ".join(f"v{k}" for k in range(150_000))
    rows = [(4, long), (2, long + " tail"), (3, "v1 v2 v3 v4 v5")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {4: (149_996, 2), 2: (149_997, 2), 3: (1, 3)}


def test_estimate_of_the_union():
    pad = np.iinfo(np.uint64).max
    a = np.array([[1, 2, 3, pad]], np.uint64)
    b = np.array([[2, 3, 4, 5]], np.uint64)
    assert N.estimates(a, b, 4).tolist() == [0.5]
    assert N.estimates(a, b, 64).tolist() == [0.4]


def test_common_counts():
    sets = [np.array(x, np.uint64) for x in ([1, 5, 9], [5, 9, 11], [2], [])]
    assert L.common(sets, np.arange(4), np.arange(4), columns=1).tolist() == [[2 if {i, j} <= {0, 1} else 0 for j in range(4)] for i in range(4)]


@pytest.mark.parametrize("size", [10**6, 500, 37])
def test_common_counts_in_slices(monkeypatch, size):
    monkeypatch.setattr(L, "SLICE", size)
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 2000, rng.integers(0, 300)).astype(np.uint64) * np.uint64(4611686018427387)) for _ in range(30)]
    got = L.common(sets, np.arange(30), np.arange(30), 7)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(30) for j in range(30) if i != j)


def test_components(spark):
    edges = [(k + 1, k) for k in range(40)] + [(100, 101), (102, 101), (50, 50)] + [(200, k) for k in range(201, 260)]
    got = {r["node"]: r["label"] for r in L.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {101: 100, 102: 100} | {k: 200 for k in range(201, 260)}
    assert L.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sql(spark):
    from tests.oracle import compare, connection
    from tidewheel.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    compare(spark, connection(sf_dir), sf_dir, queries.queries()["op5_minhash_dedup"], queries.oracle_sql()["op5_minhash_dedup"])
