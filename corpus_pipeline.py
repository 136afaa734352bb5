"""A corpus pipeline over documents: five stages, each one operator, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meltemi.llm import line_dedup, packing, simhash, suffix_dedup, toxicity
from meltemi.llm.common import Scratch, table, tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(docs: DataFrame, text: str) -> DataFrame:
    """The columns of documents, with the text taken from another column and n_chars made to fit it."""
    new = docs.withColumns({"text": F.col(text), "n_chars": F.length(text).cast("long")})
    return new.select(*COLUMNS)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity reaches the threshold of their language go; the model learns from labels of sf_dir."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).filter("NOT rejected").select(*COLUMNS)


def common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share are dropped; every document stays, if only with an empty text."""
    return _with_text(line_dedup.drop_common_lines(docs.select(*COLUMNS)), "kept_text")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest doc_id, a null one last.

    Near copies share 0.8 or more of their five-word shingles. Rows are numbered in a written table,
    so that repeated rows and null ids are told apart.
    """
    scratch = Scratch(spark)
    rows = scratch.write(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "numbered")
    groups = simhash.similar_documents(rows, words=5, least=0.8)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    best = rows.select("_row", order.alias("order")).join(groups, "_row").groupBy("root").agg(F.min("order").alias("order"))
    first = best.select(F.col("order._row").alias("_row"))
    scratch.later()
    return rows.join(first, "_row", "left_semi").select(*COLUMNS)


def unique_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy of a passage of over 50 words that stands anywhere else too is removed.

    A document of which nothing but white space is left goes; one that lost nothing stays, if empty.
    """
    cut = suffix_dedup.remove_repeats(docs.select(*COLUMNS), depth=51, unit="words")
    return _with_text(cut.filter((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")), "kept_text")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path(), capacity=2048, end_id=0)


STAGES = [
    ("toxicity", clean_documents), ("line_dedup", common_lines), ("simhash_neardup", near_copies),
    ("suffix_dedup", unique_passages), ("packing", sequences),
]

#: SQL has neither the classifier's weights nor a tokenizer; tests hold run() against the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to documents; the rows of the last one."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for n, (name, stage) in enumerate(STAGES):
        done = scratch.write(stage(spark, docs, sf_dir), name)
        if n:
            scratch.drop(docs)
        docs = done
    scratch.later()
    return docs
