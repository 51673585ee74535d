"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

Every stage works on all documents that the one before kept, takes (spark, docs, sf_dir) and returns a DataFrame;
all but the last return the columns of documents. Rows without a decision of their own behave as the operators
say: null texts count as empty and have no language, so they go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import language_id, mixing, near_dedup, quality, sentencepiece_codec
from tidewheel.llm.common import scratch_path, stored
from tidewheel.llm.queries import tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Below this probability a text is in none of the known languages.
LEAST_LANGUAGE = 0.5
#: Below this probability of label 1 a document is of low quality.
LEAST_QUALITY = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents in no learned language go; a null lang takes the prediction."""
    model = language_id.fit(docs.select("doc_id", "text", "lang"))
    rows = language_id.predict(docs, model, keep=tuple(COLUMNS)).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE))
    return rows.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that score below LEAST_QUALITY go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels.select("doc_id", "quality"))
    return quality.predict(docs, model, LEAST_QUALITY, keep=tuple(COLUMNS)).where("predicted = 1").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group of near-duplicates (similarity 0.8 or more), the document with the smallest id stays.

    Where rows repeat a doc_id, each different text of the id is a document of its own: equal texts leave one row, a
    text that is near another document's goes if that one's id is smaller, or the id equal and the text first, and
    unlike texts stay, all with their doc_id. Rows with a null doc_id link nothing and all stay.
    """
    rows = docs.select(*COLUMNS).withColumn("_row", F.col("doc_id").cast("long"))
    repeated = stored(rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    again = not repeated.isEmpty()
    if again:
        top = rows.agg(F.max("_row")).first()[0]
        texts = rows.join(repeated, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("_first"))
        texts = texts.select("doc_id", "text", "_first.*").orderBy("doc_id", "text").withColumn("_row", F.monotonically_increasing_id() + F.lit(top + 1))
        rows = rows.join(repeated, "doc_id", "left_anti").unionByName(stored(texts, "repeated-rows"))
    found = near_dedup.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), percent=80)
    kept = found.where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    if again:  # rows of repeated ids were numbered beyond all ids: the smallest id of each group is another's
        ids = rows.select("_row", F.col("doc_id").alias("_id"))
        least = found.join(ids, found["doc_id"] == ids["_row"]).groupBy("component_id").agg(F.min(F.struct("_id", "_row")).alias("_least"))
        kept = least.select(F.col("_least._row").alias("_kept")).unionByName(kept.where("_kept is null"))
    return rows.join(kept, rows["_row"].eqNullSafe(kept["_kept"]), "left_semi").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Temperature mixing: sources come closer to equal weights; each document stays at least once, and none is repeated more than twice."""
    return mixing.realised(docs.select(*COLUMNS), entropy=0.97, most_epochs=2.0, cover=True)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document."""
    return sentencepiece_codec.encode(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [("language", language), ("quality", good_quality), ("near_dedup", one_of_each), ("mixing", mixed), ("sentencepiece", encoded)]
#: The stages learn models and hash n-grams, which SQL can't express; the tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
