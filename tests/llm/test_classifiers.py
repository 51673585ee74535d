import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewheel.llm import language_id as LI
from tidewheel.llm import quality as Q
from tidewheel.llm import toxicity as T
from tidewheel.llm.common import bounded_ids, documents, remainder

SF = "/root/testdata/sf0.01"


def plain_grams(text):
    x = [ord(c) * 0x9E3779B1 % (1 << 32) for c in f" {text.lower()}  "]
    for a, b, c in zip(x, x[1:], x[2:], strict=False):
        b, c = b * 0x85EBCA77 % (1 << 32), c * 0xC2B2AE3D % (1 << 32)
        two = ((a ^ (b >> 7)) * 0x27D4EB2F + b) % (1 << 32)
        three = ((two ^ (c >> 9)) * 0x165667B1 + c) % (1 << 32)
        yield from (a >> 16, two >> 16, three >> 16)


def test_language_scores_match_plain_sums():
    rng = np.random.default_rng(0)
    m = LI.Model(["a", "b"], rng.normal(size=(LI.BUCKETS, 2)).astype(np.float32))
    texts = ["Hello wörld", "", "x", "日本語 text", "one two three " * 50]
    sums, n = m.scores(texts)
    for t, s, k in zip(texts, sums, n, strict=True):
        ids = list(plain_grams(t))
        assert k == len(ids)
        assert s == pytest.approx(m.logp[ids].astype(float).sum(0), rel=1e-4, abs=1e-3)


def test_long_texts_are_scored_whole(monkeypatch):
    """Every n-gram of a long text counts once, also those across the cuts."""
    m = LI.Model(["a", "b"], np.random.default_rng(0).normal(size=(LI.BUCKETS, 2)).astype(np.float32))
    monkeypatch.setattr(LI, "PIECE", 100)
    for text in ("abc def " * 200, "x" * 101, "é日a" * 333):
        sums, n = m.scores([text, "short"])
        ids = list(plain_grams(text))
        assert n[0] == len(ids) and sums[0] == pytest.approx(m.logp[ids].astype(float).sum(0), rel=1e-4, abs=1e-3)


def test_language_nulls_ties_and_strangers(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("the cat sat on the mat", "en"), ("der hund und die katze", "de"), ("the dog and the cow", "en"), ("die kuh und der hund", "de"), ("no lang", None), (None, "en")] * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as score", "'z' as lang_pred")
    m = LI.fit(df)
    assert m.langs == ["de", "en"]
    asked = spark.createDataFrame([(1, "the cow"), (1, "the cow"), (None, "und der hund"), (3, None), (4, ""), (5, "12 34 !!"), (6, "日本")], "doc_id long, text string")
    got = [(r["doc_id"], r["lang_pred"]) for r in LI.predict(asked, m).collect()]
    assert sorted(got, key=str) == sorted([(1, "en"), (1, "en"), (None, "de"), (3, "und"), (4, "und"), (5, "und"), (6, got[-1][1])], key=str)
    none = LI.fit(df.where("false"))
    assert [tuple(r) for r in LI.predict(asked.where("doc_id = 1").limit(1), none).collect()] == [(1, "und", 0.0)]
    assert LI.predict(asked.where("false"), m).count() == 0


def test_bounded_sample_is_bounded(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "if(id % 10 = 0, 'rare', null) as s")
    got = {r["s"]: r["count"] for r in bounded_ids(df, "s", 300).groupBy("s").count().collect()}
    assert set(got) == {"rare", None} and all(200 < n < 400 for n in got.values())


def held_out(spark, out, table, label, fold):
    truth = spark.read.parquet(f"{SF}/{table}.parquet").select("doc_id", label)
    rows = out.where("held_out").join(truth, "doc_id").where(f"{label} is not null").collect()
    return np.array([[r["predicted"] if "predicted" in r.asDict() else r["lang_pred"], r[label]] for r in rows])


def test_held_out_accuracy(spark):
    from tidewheel.llm import queries

    q = queries.queries()
    for name, label, fold, least in (("op7_toxicity", "toxic", (4, 2), 0.9), ("op8_quality", "quality", (5, 0), 0.9)):
        out = q[name](spark, SF)
        assert out.count() == 1000 and out.where("score < 0 or score > 1 or predicted <> if(score >= 0.3, 1, 0)").count() == 0
        assert out.where(remainder("doc_id", fold[0]) == fold[1]).where("not held_out").count() == 0
        x = held_out(spark, out, "labels", label, fold)
        assert (x[:, 0] == x[:, 1]).mean() > least, name
    out = q["op10_language_id"](spark, SF)
    x = held_out(spark, out, "documents", "lang", (3, 1))
    assert (x[:, 0] == x[:, 1]).mean() > 0.98


def test_quality_descent_matches_the_primal_optimum():
    """The dual's weights satisfy the primal problem at least as well as many perturbed ones."""
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(50, 8, replace=False)) for _ in range(80)]
    y = np.where([10 in r or 20 in r for r in rows], 1.0, -1.0)
    values, cost = rng.normal(size=50), 0.5
    scaled, b = Q.descend(rows, values, y, cost, 500, 0)
    w = scaled / values

    def primal(w, b):
        margin = np.array([w[r] @ values[r] + b for r in rows])
        return 0.5 * (w @ w + b * b) + cost * np.maximum(0, 1 - y * margin).sum()

    best = primal(w, b)
    assert all(primal(w + rng.normal(0, 0.02, 50), b + rng.normal(0, 0.02)) >= best - 1e-3 for _ in range(200))


def test_quality_indicators_and_edges(spark):
    seen = np.zeros(Q.BUCKETS, bool)
    a = Q.indicators("some text!!", seen)
    assert not seen.any() and (np.diff(a) > 0).all()
    assert Q.indicators("", seen).size
    m = Q.fit(spark.createDataFrame([(1, "x")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int"))
    got = Q.predict(spark.createDataFrame([(1, None), (1, None), (None, "x")], "doc_id long, text string"), m).collect()
    assert [r["score"] for r in got] == pytest.approx([0.5] * 3, abs=1e-6)
    one = Q.fit(spark.createDataFrame([(1, "x"), (2, "y")], "doc_id long, text string"), spark.createDataFrame([(1, 1), (2, 1), (2, 0), (None, 0)], "doc_id long, quality int"))
    assert one.score(["x"])[0] > 0.9


def test_folding():
    assert T.fold("Idiót 1d10t ІDІОТ ｉｄｉｏｔ id!ot") == " idiot idiot idiot idiot id ot "
    assert T.fold("you i d i o t, he i.d.i.o.t! a b") == " you idiot he idiotab "
    assert T.fold("year 2024, 10 x") == " year 2024 10 x "
    assert T.fold(None) == "  "


def test_lexicon_matches_plain_search():
    m = T.Model({"idiot": 3.0, "trash": 2.0, "idio": 1.0}, {"given": ["trash can"]})
    a = m.automaton()
    assert m.hits(T.fold("You IDIOT"), a) == 3.0
    assert m.hits(T.fold("the trash can is full"), a) == 0.0
    assert m.hits(T.fold("the trash, idiots! trash can"), a) == 5.0
    assert m.hits(T.fold("unidiotic"), a) == 0.0
    assert m.hits(T.fold("trash trash TRASH idiot"), a) == 5.0
    assert T.Model({}).score(["", "x", None]).tolist() == [0.5] * 3


def test_lexicon_is_learned(spark):
    rng = np.random.default_rng(0)
    vocab = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(200)]
    rows, labels = [], []
    for i in range(400):
        words = rng.choice(vocab, 30).tolist()
        if i % 4 == 0:
            words[3] = rng.choice(["zzurg", "zzurgen", "qqword"])
        elif i % 4 == 1:
            words[3:5] = ["mild", "qqword"]  # clean in this phrase
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    m = T.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "zzur" in m.lexicon
    got = {r["doc_id"]: r["score"] for r in T.predict(spark.createDataFrame([(1, "a ZZURG b"), (2, "clean text"), (3, None), (3, None), (4, "zz0rg zzurgen " * 5)], "doc_id long, text string"), m).collect()}
    assert got[1] > 0.5 > got[2] and got[3] == got[2] and got[4] > 0.5
    empty = T.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert empty.lexicon == {} and T.predict(docs, empty).where("predicted = 1").count() == 0


def test_toxicity_learns_short_words_whole(spark):
    rng = np.random.default_rng(2)
    words = ["river", "house", "to", "is", "green", "of", "walks", "qux", "zo", "stone", "paper"]
    rows = []
    for i in range(400):
        w = list(rng.choice([x for x in words if x not in ("qux", "zo")], 30))
        if i % 2:
            w.insert(int(rng.integers(30)), ("qux", "zo")[i // 2 % 2])
        else:
            w += ["zoology", "quxine"]
        rows.append((i, " ".join(w), i % 2))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    m = T.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert set(m.lexicon) == {"qux ", "zo "}
    asked = ["the river is green qux", "Zo! the river", "quxine zoology of stone", "to is of"]
    got = T.predict(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), m)
    assert {r["doc_id"]: r["predicted"] for r in got.collect()} == {0: 1, 1: 1, 2: 0, 3: 0}


def plain_indicators(text):
    """Buckets of the 1- to 4-grams of code points, and of the shares of repeated words, one at a time."""
    x = [ord(c) * 0x9E3779B1 % (1 << 32) for c in f" {text} "]
    out = set()
    for i in range(len(x)):
        h = x[i]
        out.add(h >> 16)
        for order, mult in ((1, 0x85EBCA77), (2, 0xC2B2AE3D), (3, 0x27D4EB2F)):
            if i + order >= len(x):
                break
            h = ((h ^ (h >> 15)) + x[i + order]) * mult % (1 << 32)
            out.add(h >> 16)
    out = {b for b in out if b < Q.BUCKETS - Q.SHARES}
    words = text.split()
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    out |= {Q.BUCKETS - Q.SHARES + k for k in range(Q.SHARES) if again and again * 2**k >= len(words) - 1}
    return sorted(out)


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=80))
def test_quality_indicators_against_plain(text):
    seen = np.zeros(Q.BUCKETS, bool)
    for t in (text, f"{text} {text} {text}"):
        assert Q.indicators(t, seen).tolist() == plain_indicators(t)


def plain_fold(text):
    """The folding, character by character and word by word."""
    out = []
    for c in unicodedata.normalize("NFKD", text.lower()) if not text.lower().isascii() else text.lower():
        if not (not text.lower().isascii() and 0x300 <= ord(c) <= 0x36F):
            out.append(T.HOMOGLYPHS.get(c, c))
    words, own = [], ""
    for c in [*out, " "]:
        if c.isalnum() or c in "@$":
            own += c
        else:
            words.append(own)
            own = ""
    folded = []
    for w in words:
        letters = sum(c.isalpha() for c in w)
        if letters and any(c in T.LEET for c in w) and letters * 3 >= len(w):
            w = "".join(T.LEET.get(c, c) for c in w)
        folded += "".join(c if c.isalnum() else " " for c in w).split()
    spelled, out = [], []
    for w in [*folded, None]:
        if w is not None and len(w) == 1:
            spelled.append(w)
        else:
            out += ["".join(spelled)] if len(spelled) > 3 else spelled
            spelled = []
            out += [w] if w else []
    return f" {' '.join(out)} " if out else "  "


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abtiо0135 .!-éIХx", min_size=0, max_size=7), max_size=9))
def test_folding_against_plain(words):
    text = " ".join(words)
    assert T.fold(text) == plain_fold(text)


def plain_hits(model, folded):
    phrases = [f" {p} " for ps in model.exceptions.values() for p in ps]
    spared = [(s, s + len(p)) for p in phrases for s in range(len(folded)) if folded.startswith(p, s)]
    best = {}
    for s in range(len(folded)):
        for w, weight in model.lexicon.items():
            if folded.startswith(f" {w}", s) and not any(lo <= s and s + len(w) + 1 <= hi for lo, hi in spared):
                word = folded[s + 1 : folded.index(" ", s + 1)]
                best[word] = max(best.get(word, weight), weight)
    return sum(best.values())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abc", min_size=1, max_size=5), max_size=30), st.integers(0, 1000))
def test_matching_against_plain(words, seed):
    rng = np.random.default_rng(seed)
    make = lambda lo, hi: "".join(rng.choice(list("abc"), rng.integers(lo, hi)))
    lexicon = {make(4, 6): float(rng.integers(1, 9)) for _ in range(4)} | {f"{make(1, 4)} ": float(rng.integers(1, 9)) for _ in range(3)}
    m = T.Model(lexicon, {"given": [f"{make(1, 4)} {make(1, 4)}" for _ in range(3)] + [" ".join(words[:2])] * (len(words) > 1)})
    folded = f" {' '.join(words)} "
    assert m.hits(folded, m.automaton()) == pytest.approx(plain_hits(m, folded))


def test_chosen_entries_meet_their_definition():
    rng = np.random.default_rng(3)
    for _ in range(30):
        words = {"".join(rng.choice(list("ab"), rng.integers(4, 8))) for _ in range(25)}
        counts = [(w, int(rng.integers(0, 60)), int(rng.choice([0, 0, 1, 5, 40]))) for w in sorted(words)]
        held = {w: (a, b) for w, a, b in counts}
        got = T.choose(counts, 100, 400)
        assert got == T.choose(counts[::-1], 100, 400)
        for w, weight in got.items():
            assert held[w][0] and T.surprise(*held[w], 100, 400) >= T.SURPRISE and weight > T.LEAST_WEIGHT
        for w in words - got.keys():  # left out: by chance, or said by a shorter one or by its kept extensions
            a, b = held[w]
            related = any(w.startswith(x) or x.startswith(w) for x in words if x != w)
            assert not a or related or T.surprise(a, b, 100, 400) < T.SURPRISE or T.log_odds(a, b, 100, 400) <= T.LEAST_WEIGHT


def test_nothing_learned_is_cut(spark):
    """Hundreds of entries and strata are all kept."""
    rows = [(i, " ".join(f"bad{chr(97 + i % 20)}{chr(97 + k)}word" for k in range(26)) + f" {i}" if i % 2 else f"clean text of {i}", i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    m = T.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"), least=2)
    assert T.predict(df, m).join(df.select("doc_id", "toxic"), "doc_id").where("predicted <> toxic").count() == 0
    many = spark.range(30_000).selectExpr("id as doc_id", "cast(id % 15000 as string) as s")
    assert bounded_ids(many, "s", 5).count() == 30_000


def test_empty_tables_and_clashing_columns(spark):
    rows = [(i, "good text here" if i % 2 else "b4d t3xt zzz", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, y int").selectExpr("*", "'a' as score", "'b' as predicted", "'c' as lang_pred", "if(y = 1, 'xx', 'yy') as lang")
    labels = df.selectExpr("doc_id", "y as toxic", "y as quality", "1 as score")
    none = df.where("false")
    for model, run in ((T.fit(df, labels), T.predict), (Q.fit(df, labels), Q.predict)):
        assert run(df, model).columns == ["doc_id", "score", "predicted"] and run(df, model).count() == 40
        assert run(none, model).count() == 0
        assert run(df, model, keep=("text", "doc_id")).columns == ["doc_id", "text", "score", "predicted"]
        with pytest.raises(ValueError):
            run(df, model, keep=("score",))
    m = LI.fit(df)
    assert LI.predict(none, m).count() == 0 and LI.predict(df, m).columns == ["doc_id", "lang_pred", "score"]
    with pytest.raises(ValueError):
        LI.predict(df, m, keep=("lang_pred",))


def test_null_ids_are_held_out(spark, tmp_path):
    """A null doc_id has no fold of its own: it is never learned from, and is scored."""
    from tidewheel.llm import queries

    docs = [(i, "the cat sat" if i % 2 else "der hund und", "en" if i % 2 else "de") for i in range(60)] + [(None, "xx yy", "zz")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)] + [(None, 1, 1)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("op7_toxicity", "op8_quality", "op10_language_id"):
        got = {r["doc_id"]: r for r in queries.queries()[name](spark, str(tmp_path)).collect()}
        assert len(got) == 61 and got[None]["held_out"] is True and 0 <= got[None]["score"] <= 1
        assert name != "op10_language_id" or got[None]["lang_pred"] in ("en", "de")
