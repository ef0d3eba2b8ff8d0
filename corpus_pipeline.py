"""The corpus pipeline: documents through the operators of ``tagspark.llm``, one stage after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagspark.llm import language_cnn, mixing, pii_crf, sentencepiece_unigram, simhash_covering
from tagspark.session import shared_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that the network knows go."""
    return language_cnn.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash_covering.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in ``text`` gives way to its kind; ``n_chars`` follows the text."""
    redacted = docs.withColumn("text", pii_crf.redact(F.col("text"), pii_crf.train()))
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return redacted


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat_rows(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text beside the columns of the documents."""
    return sentencepiece_unigram.tokenize(docs)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", near_dedup),
    ("PII", redact),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", tokenize),
]

#: The network, the CRF and the tokenizer can't be written in SQL; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = shared_path(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
