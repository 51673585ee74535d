import corpus_pipeline as P
from tests.llm.test_near_dedup import plain

from tidewheel.llm import quality as Q

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_turn(spark):
    """Each stage's decisions, held against plain ones on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(10_001, None, "en", "src1", 0), (10_002, "123 456 ...", None, "src1", 11), (10_003, "", "en", None, 0)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).cache()
    assert [n for n, _ in P.STAGES] == ["language", "quality", "near_dedup", "mixing", "sentencepiece"]

    kept = P.language(spark, docs, SF).cache()
    assert kept.columns == COLUMNS
    gone = {r["doc_id"] for r in docs.join(kept, "doc_id", "left_anti").collect()}
    assert {10_001, 10_002, 10_003} <= gone and len(gone) <= 6

    good = P.good_quality(spark, kept, SF).cache()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r["doc_id"] for r in good.collect()}
    judged = [(i in left, labels[i]) for i in (r["doc_id"] for r in kept.collect()) if labels.get(i) is not None]
    assert good.columns == COLUMNS and sum(k == bool(q) for k, q in judged) > 0.9 * len(judged)
    model = Q.fit(kept, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = kept.collect()
    assert left == {r["doc_id"] for r, s in zip(rows, model.score([r["text"] for r in rows]), strict=True) if s >= 0.3}

    single = P.one_of_each(spark, good, SF).cache()
    want = {i for i, _, _, k in plain([(r["doc_id"], r["text"]) for r in good.collect()], 80) if k}
    assert single.columns == COLUMNS and {r["doc_id"] for r in single.collect()} == want

    mixed = P.mixed(spark, single, SF).cache()
    count = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == COLUMNS and count.keys() == want and max(count.values()) <= 2

    tokens = P.encoded(spark, mixed, SF)
    assert tokens.count() == mixed.count() and tokens.where("n_tokens <> size(ids)").count() == 0


def test_near_dedup_of_repeated_ids(spark):
    """One row of each group stays, whatever ids repeat; no unlike text goes."""
    a, b, c, d = (" ".join(f"{w}{k}" for k in range(60)) for w in "abcd")
    near = a.replace("a59", "other")
    rows = [(1, a), (1, a), (1, a), (2, near), (3, c), (5, c), (5, d), (7, d), (6, d), (8, b), (4, b), (4, b.upper()), (4, a), (None, b), (None, b)]
    df = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = sorted(((r["doc_id"] or 0, r["text"].lower()) for r in P.one_of_each(spark, df, SF).collect()))
    assert got == [(0, b), (0, b), (1, a), (3, c), (4, b), (5, d)]


def test_run(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids"] and out.count() > 100
