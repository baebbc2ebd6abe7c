"""A training-corpus pipeline: language ID, near-dedup, decontamination, redaction of secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the columns of docs, whatever they are, save
the last, which returns (doc_id, n_pieces, ids). A stage works on all that the one before kept:

    language         rows that the model rejects go: null texts, texts without letters, and texts too unlike any language
    near_dedup       one row of each group of near-duplicates stays, that of the smallest id
    decontaminate    rows that hold a benchmark item go
    secrets          spans of secrets become a mark; rows without any are as they were
    sentencepiece    texts become ids
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apportion.llm import decontaminate, langid, pieces, secrets, simhash
from apportion.llm.common import cut, fold, table

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs, langid.fit(docs.where(fold(F.col("doc_id"), 4) != 2)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates are op2's: at most 3 of 64 bits of fingerprints of 3-word shingles differ. Most pairs of texts whose
    five-word Jaccard similarity is between 0.8 and about 0.9 are not linked, so both stay."""
    return simhash.representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs, secrets.scan(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return clean.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, pieces.load(MODEL_FILE)).select("doc_id", F.size("ids").alias("n_pieces"), "ids")


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontaminate", without_benchmark), ("secrets", without_secrets), ("sentencepiece", tokens)]

ORACLE_SQL = None
"""Trained and hashed stages have no SQL; tests hold the stages against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
    return docs
