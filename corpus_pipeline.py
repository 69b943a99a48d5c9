"""A corpus pipeline of five training-data operators: each stage works on all that the one before it kept.

run(spark, sf_dir) applies the stages in order; whoever runs them one by one writes each result as Parquet and reads it
again as the next stage's documents. All stages but the last return the columns of documents, and others that it may have.
Documents are rows told apart by doc_id and text; nulls, blanks, repeats and very long texts are treated as each operator's
module says; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinfold.llm.bpe import encode_decode
from kinfold.llm.decontaminate import keep_clean
from kinfold.llm.line_dedup import drop_repeated_lines
from kinfold.llm.near_dedup import keep_one
from kinfold.llm.quality import keep_good
from kinfold.session import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, and lines that the host's documents share; null text is rejected."""
    ship(spark)
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that later occurrences of repeated windows cover go, and documents that lose all their lines so (exact copies)."""
    ship(spark)
    return drop_repeated_lines(docs, drop_emptied=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest doc_id; a null one comes last."""
    ship(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    ship(spark)
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    import public_tokenizers

    ship(spark)
    return encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", tokens),
]

#: Near-duplicate classes and tokenizer ids cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
