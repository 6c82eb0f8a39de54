"""Documents to packed training sequences: quality rules, near duplicates,
secrets, mixing, packing. Each stage reads what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bedhour.llm import mixing, near_duplicates, packing, quality, secrets
from bedhour.llm.common import Stage
from bedhour.llm.queries import tokenizer_definition


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's perplexity band."""
    return quality.keep_good(docs)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8)."""
    return near_duplicates.keep_one(docs, shingle=5, percent=80)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.copies(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 ids."""
    return packing.pack(docs, tokenizer_definition())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicate_removal),
    ("secrets", secret_redaction),
    ("mixing", source_mixing),
    ("packing", sequence_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage's output is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done: Stage | None = None
    for name, stage in STAGES[:-1]:
        written = Stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if done is not None:
            done.drop()
        docs, done = written.df, written
    return STAGES[-1][1](spark, docs, sf_dir)
