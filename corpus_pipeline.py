"""From raw documents to packed training sequences, one operator after the other.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from yearring.llm import exact_dedup, packing, pii, quality, simhash
from yearring.llm.parts import written
from yearring.llm.queries import documents, tokenizer


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier rejects."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of equal texts."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return simhash.drop_near_copies(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences."""
    return packing.best_fit_packing(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("pii", without_personal_data),
    ("best_fit_packing", packed),
]

#: SQL can't express the classifier, so there is none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
