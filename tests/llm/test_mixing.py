import hashlib
import math
import re

import numpy as np
import pytest

from tests.oracle import compare, connection
from tidewheel.llm import mixing as M
from tidewheel.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def digits(*parts):
    return int(hashlib.md5("|".join(parts).encode()).hexdigest()[:8], 16)


def plain(rows, exponent_of, cover=False, seed=0, block_tokens=20_000):
    """(doc_id, source, tokens, epoch, block, rank) by loops."""
    count = [(i, s, len(WORD.findall(t or ""))) for i, s, t in rows]
    total = {}
    for _, s, n in count:
        total[s] = total.get(s, 0) + n
    total = {s: n for s, n in total.items() if n}
    t = np.array([total[s] for s in sorted(total, key=str)], float)
    w = dict(zip(sorted(total, key=str), np.round(M.weights(t, exponent_of(t)), 9), strict=True)) if total else {}
    whole = max(total[s] / w[s] for s in total) if cover else sum(total.values())
    out = []
    for s in total:
        budget = max(round(w[s] * whole), total[s]) if cover else round(w[s] * whole)
        blocks = min(4096, max(1, -(-total[s] // block_tokens)))
        own = {}
        for i, s2, n in count:
            if s2 == s:
                own.setdefault(digits(f"block{seed}", "null" if i is None else str(i)) % blocks, []).append((i, n))
        name = "null" if s is None else "=" + s
        for e in range(1, math.ceil(budget / total[s]) + 1):
            past = 0
            for rank, b in enumerate(sorted(own, key=lambda b: (digits(f"order{seed}", name, str(e), str(b)), b)), 1):
                size = sum(n for _, n in own[b])
                if 2 * past + size <= 2 * (budget - (e - 1) * total[s]):
                    out += [(i, s, n, e, b, rank) for i, n in own[b]]
                past += size
    return sorted(out, key=str)


ROWS = [(i, ["a", "a", "a", "a", "b", "b", "c"][i % 7], "w " * (i % 13 + 1)) for i in range(400)] + [(None, "b", "x y"), (5, None, "p q r"), (5, None, "p q r"), (6, "c", None), (7, "d", "")]


@pytest.mark.parametrize("cover", [False, True])
def test_matches_plain_loops(spark, cover):
    df = spark.createDataFrame(ROWS, "doc_id long, source string, text string").selectExpr("*", "1 as blocks", "2 as rank").repartition(3)
    args = {"entropy": 0.97, "most_epochs": 3.0, "cover": cover}
    got = sorted(((r["doc_id"], r["source"], r["n_tokens"], r["epoch"], r["block"], r["rank"]) for r in M.mixture(df, block_tokens=40, **args).collect()), key=str)
    assert got == plain(ROWS, lambda t: M.exponent(t, 0.97, 3.0, cover), cover, block_tokens=40)


def test_targets_are_met():
    t = np.array([1000.0, 300.0, 50.0, 10.0])
    a = M.exponent(t, 0.9, 100.0, False)
    w = M.weights(t, a)
    assert -(w * np.log(w)).sum() == pytest.approx(0.9 * np.log(4), abs=1e-9)
    a = M.exponent(t, 1.0, 2.0, False)
    w = M.weights(t, a)
    assert (w * t.sum() / t).max() == pytest.approx(2.0, abs=1e-9)
    assert M.exponent(t, 0.0, 1.0, False) == pytest.approx(1.0)


def test_cover_keeps_every_document(spark):
    docs = spark.createDataFrame([(i, s, t, "en", 3) for i, s, t in ROWS if t], "doc_id long, source string, text string, lang string, n_chars long")
    got = M.realised(docs, cover=True, most_epochs=2.0).groupBy("doc_id", "source", "text", "lang").count().collect()
    assert {(r["doc_id"], r["source"]) for r in got} == {(i, s) for i, s, t in ROWS if t}
    assert max(r["count"] for r in got if r["doc_id"] != 5) <= 2
    assert M.realised(docs, few=0, cover=True, most_epochs=2.0).count() == sum(r["count"] for r in got)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert M.mixture(none).count() == 0 and M.realised(none).count() == 0
    assert M.mixture(spark.createDataFrame([(1, "a", None)], none.schema)).count() == 0


def test_sql(spark):
    compare(spark, connection("/root/testdata/sf0.01"), "/root/testdata/sf0.01", queries.queries()["op4_mixing"], queries.oracle_sql()["op4_mixing"])


@pytest.mark.parametrize("cover", [False, True])
def test_more_sources_than_the_driver_takes(spark, cover):
    """The plan by aggregates equals the driver's, and gives the same mixture."""
    rows = ROWS + [(1000 + k, f"s{k}", "w " * (k % 5 + 1)) for k in range(30)]
    df = M.measured(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    args = {"entropy": 0.95, "most_epochs": 3.0, "cover": cover, "block_tokens": 40}
    one, two = (sorted(map(tuple, M.source_plan(df, few=few, **args).collect())) for few in (100, 2))
    assert [r[:2] + r[4:] for r in one] == [r[:2] + r[4:] for r in two]
    for x, y in zip(one, two, strict=True):
        assert x[2] == pytest.approx(y[2], abs=2e-9) and abs(x[3] - y[3]) <= 1
