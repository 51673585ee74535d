"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import edit_embedding, gif_media, language_id, mixing, near_dedup, quality, sentencepiece_codec, separator_scan, token_files, toxicity
from tidewheel.llm.common import documents, remainder, stored


def tokenizer(name: str) -> str:
    """A public vocabulary's file; the folder is the setting ``spark.tidewheel.tokenizers``, else the installed one."""
    spark = SparkSession.getActiveSession()
    folder = spark.conf.get("spark.tidewheel.tokenizers", None) if spark else None
    if folder:
        return f"{folder.rstrip('/')}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(edit_embedding.with_next(documents(spark, sf_dir, "doc_id", "text")), "fingerprints")
    return edit_embedding.with_classes(rows)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.roundtrip(documents(spark, sf_dir, "doc_id", "text"), tokenizer("word_bpe_49k.json"))


def op3_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif_media.features(gif_media.store_texts(documents(spark, sf_dir, "doc_id", "text")))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(documents(spark, sf_dir, "doc_id", "source", "text"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir, "doc_id", "text"), percent=85)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return separator_scan.counts(docs, tokenizer("word_bpe_49k.json"), end_id=49407)


def held_out(divisor: int, own: int) -> Column:
    """Whether a document is in the fold that is never learned from; a null doc_id always is."""
    return F.coalesce(remainder("doc_id", divisor) == own, F.lit(True))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = held_out(4, 2)
    model = toxicity.fit(docs, labels.where(~held).select("doc_id", "toxic"))
    out = toxicity.predict(docs, model)
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = held_out(5, 0)
    model = quality.fit(docs, labels.where(~held).select("doc_id", "quality"))
    out = quality.predict(docs, model)
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(documents(spark, sf_dir, "doc_id", "text"), tokenizer("piece_bpe_32k.model"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    held = held_out(3, 1)
    model = language_id.fit(docs.where(~held))
    out = language_id.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_edit_embedding, op2_token_files, op3_gif, op4_mixing, op5_minhash_dedup, op6_token_counts, op7_toxicity, op8_quality, op9_sentencepiece, op10_language_id, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": mixing.mixture_sql(), "op5_minhash_dedup": near_dedup.near_duplicates_sql(85)}
