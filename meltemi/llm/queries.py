"""The queries of this subpackage by name: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meltemi.llm import (
    embeddings, langid, lexical, line_dedup, negatives, packing, pii, quality, sentencepiece_bpe, simhash, suffix_dedup, toxicity, warc,
)
from meltemi.llm.common import doc_fold, table, tokenizer_path


def op1_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, words=4, radius=4).select("doc_id", "fingerprint", "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", F.coalesce(doc_fold(5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(spark, table(spark, sf_dir, "pages"), least=100).filter("gap is null")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_bpe.digest(docs, tokenizer_path("piece_bpe_32k.model"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predicted = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    held = F.coalesce(doc_fold(4) == 2, F.lit(False)).alias("held_out")
    return predicted.select("doc_id", held, "lang_pred", "score", "ambiguous")


def op7_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.93)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), depth=400, passage=51)
    return out.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("changed"), "kept_text",
        "n_passage_bytes", "has_passage")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.drop_common_lines(docs, min_docs=10, min_chars=1, texts=False)
    return out.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokenizer_path(), capacity=2048, end_id=0)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.fit(), texts=False)
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), every=100, positives=5, negatives=5, low=80, high=100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_neardup, op2_toxicity, op3_warc, op4_sentencepiece, op5_quality, op6_language, op7_embedding_neardup,
        op8_suffix_dedup, op9_line_dedup, op10_packing, op11_pii, op12_lexical_search, op13_hard_negatives,
    )
}
