"""Documents to training tokens in stages; each stage is written as Parquet and read again.

All stages but the last return the columns of their input; each decides on everything that
the one before it has kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loanloom.llm import bpe, leaks, minhash, pii, quality
from loanloom.session import delete, shared_path, staged_files


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule or leave the perplexity band of their language go."""
    return quality.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return minhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return leaks.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to their kind."""
    return pii.redacted(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, with its ids."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("tokens", tokens),
]

#: SQL can't express the language model or the tokenizer; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    A stage's own files and its input go once its output is written; what the last stage
    reads stays until the caller has used its rows.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, function in STAGES[:-1]:
        path = shared_path(spark, name.replace(" ", "-"))
        with staged_files(spark):
            function(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
