"""Corpus pipeline: documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from scorecraft.llm.common import TEXTS, written
from scorecraft.llm.line_dedup import PASSAGE, dedup_lines
from scorecraft.llm.packing import pack
from scorecraft.llm.pii import mask_pii
from scorecraft.llm.quality import keep_good
from scorecraft.llm.simhash import keep_one_per_group


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counting rules and their language's perplexity band keep."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line passages removed from all but their first document."""
    return dedup_lines(docs, min_words=PASSAGE).select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of connected SimHash fingerprints."""
    return keep_one_per_group(docs, shingle=3, bits=3)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return mask_pii(docs, beyond=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed into sequences of 4096."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("pii", mask_personal_data),
    ("packing", packing),
]

#: The perplexity model and the fingerprints are beyond SQL; tests/llm holds the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}", TEXTS)
    return STAGES[-1][1](spark, docs, sf_dir)
