"""One registered query for each operator, over its whole tables, and check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import (
    bpe,
    check_sql,
    collocations,
    leaks,
    lines,
    minhash,
    pii,
    quality,
    shards,
    substring,
    suffixes,
    tokencounts,
    toxicity,
    tries,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op1_circulant_minhash": check_sql.NEAR_DUPLICATES,
    "op2_lempel_ziv_dedup": check_sql.EARLIER_WORDS,
    "op4_positional_decontamination": check_sql.LEAKS,
    "op11_burst_tries": check_sql.PREFIX_TREE,
    "op12_stripes_collocations": check_sql.COLLOCATIONS,
    "op13_line_dedup": check_sql.COMMON_LINES,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_bpe_round_trip(spark, sf_dir):
    return bpe.round_trip(read(spark, sf_dir, "documents"), RANKS)


@query
def op2_lempel_ziv_dedup(spark, sf_dir):
    return substring.kept_words(read(spark, sf_dir, "documents"))


@query
def op7_radix_suffix_dedup(spark, sf_dir):
    return suffixes.kept_bytes(read(spark, sf_dir, "documents"))


@query
def op3_histogram_shards(spark, sf_dir):
    return shards.shard(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op4_positional_decontamination(spark, sf_dir):
    return leaks.leak_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op6_perplexity_rules(spark, sf_dir):
    return quality.judge(read(spark, sf_dir, "documents"), ["doc_id"]).select(
        "carried.doc_id", *quality.COUNTS, "base_failed", "kept", "perplexity")


@query
def op8_toxicity_neighbours(spark, sf_dir):
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted")


@query
def op1_circulant_minhash(spark, sf_dir):
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), size=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


@query
def op9_contextual_pii(spark, sf_dir):
    return pii.report(read(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark, sf_dir):
    # the vocabulary leaves this id free for the end of a document
    return tokencounts.document_counts(read(spark, sf_dir, "documents"), RANKS, separator=50_256)


@query
def op13_line_dedup(spark, sf_dir):
    return lines.line_report(read(spark, sf_dir, "documents"))


@query
def op11_burst_tries(spark, sf_dir):
    return tries.conversation_tree(read(spark, sf_dir, "conversations"))


@query
def op12_stripes_collocations(spark, sf_dir):
    return collocations.collocations(read(spark, sf_dir, "documents"))
