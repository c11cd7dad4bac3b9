"""Registered queries of the subpackage: thin calls with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortkit.llm import bpe, decontaminate, embedding_dedup, importance, jaccard_join, language_id, packing, secret_scan, sharding, spelling, suffix_dedup, token_counts, toxicity
from cohortkit.llm.common import read_table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("items")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(read_table(spark, sf_dir, "documents"), shards=8)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(read_table(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=200)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_rows(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), carry=("doc_id",))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(read_table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_sharding, op3_jaccard_join, op4_suffix_dedup, op5_toxicity, op6_embedding_dedup, op7_bpe, op8_language_id, op9_secret_scan, op10_token_counts, op11_importance_resampling, op12_spelling_variants, op13_packing)}
