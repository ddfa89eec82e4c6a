"""The registered queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimrisk.llm import (
    bytebpe, decontaminate, exactdedup, maintext, multiindex, neardup, packing, passages,
    prefixcounts, quality, repair, sharding, variants)
from claimrisk.llm.sql import REPAIR_SQL, SHARDING_SQL, VARIANTS_SQL

RANKS, JSON = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
PAD_ID = 50256  # free in the vocabulary
TOKEN_LIMIT = 1024


def documents(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/documents.parquet")


def op1_repeated_passages(spark: SparkSession, root: str) -> DataFrame:
    return passages.repeated_passages(spark, documents(spark, root))


def op2_exact_substrings(spark: SparkSession, root: str) -> DataFrame:
    return exactdedup.digests(spark, documents(spark, root))


def op3_sharding(spark: SparkSession, root: str) -> DataFrame:
    return sharding.assign(spark, documents(spark, root))


def op4_quality(spark: SparkSession, root: str) -> DataFrame:
    return quality.verdicts(spark, documents(spark, root))


def op5_main_text(spark: SparkSession, root: str) -> DataFrame:
    return maintext.main_texts(spark.read.parquet(f"{root}/pages.parquet"))


def op6_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.packed(spark, documents(spark, root), public_tokenizers.path(RANKS),
                          public_tokenizers.PATTERN, PAD_ID)


def op7_byte_bpe(spark: SparkSession, root: str) -> DataFrame:
    return bytebpe.digests(bytebpe.encoded(
        spark, documents(spark, root), public_tokenizers.path(RANKS), public_tokenizers.PATTERN))


def op8_decontamination(spark: SparkSession, root: str) -> DataFrame:
    return decontaminate.contaminated(
        spark, documents(spark, root), spark.read.parquet(f"{root}/benchmark.parquet"))


def op9_near_duplicates(spark: SparkSession, root: str) -> DataFrame:
    return neardup.near_duplicates(spark, documents(spark, root), words=4)


def op10_token_counts(spark: SparkSession, root: str) -> DataFrame:
    return prefixcounts.summary(prefixcounts.prefix_counts(
        spark, documents(spark, root), public_tokenizers.path(JSON), public_tokenizers.PATTERN),
        TOKEN_LIMIT)


def op11_conversation_repair(spark: SparkSession, root: str) -> DataFrame:
    return repair.repair(spark, spark.read.parquet(f"{root}/conversations.parquet"))


def op12_spelling_variants(spark: SparkSession, root: str) -> DataFrame:
    return variants.grouped(spark, documents(spark, root))


def op13_nearest_vectors(spark: SparkSession, root: str) -> DataFrame:
    return multiindex.nearest(spark, spark.read.parquet(f"{root}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (
    op1_repeated_passages, op2_exact_substrings, op3_sharding, op4_quality, op5_main_text,
    op6_packing, op7_byte_bpe, op8_decontamination, op9_near_duplicates, op10_token_counts,
    op11_conversation_repair, op12_spelling_variants, op13_nearest_vectors)}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLE = {"op3_sharding": SHARDING_SQL, "op11_conversation_repair": REPAIR_SQL,
          "op12_spelling_variants": VARIANTS_SQL}


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLE
