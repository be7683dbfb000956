"""Each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from public_tokenizers import path

from fundlens.llm import (
    byte_bpe, collocations, language_id, log_bilinear, mixing, multi_index, secret_scan, segment_topk, sharding, shingle_join, spelling,
    token_counts, token_files)
from fundlens.llm.common import fresh_folder, table


def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def byte_bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), path("byte_bpe_multi_50k.tiktoken"))


def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), map_folder=fresh_folder(spark, "shards"))


def exact_top_k_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_topk.top_k(table(spark, sf_dir, "embeddings"))


def language_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def secret_scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def shingle_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.join(table(spark, sf_dir, "documents"))


def log_bilinear_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_bilinear.score(table(spark, sf_dir, "documents"))


def neighbours_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.neighbours(table(spark, sf_dir, "embeddings"))


def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))


def collocations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def spelling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": token_counts_query,
    "op2_mixing": mixing_query,
    "op3_exact_top_k": exact_top_k_query,
    "op4_secret_scan": secret_scan_query,
    "op5_log_bilinear": log_bilinear_query,
    "op6_byte_bpe": byte_bpe_query,
    "op7_sharding": sharding_query,
    "op8_shingle_join": shingle_join_query,
    "op9_language_id": language_id_query,
    "op10_neighbours": neighbours_query,
    "op11_token_files": token_files_query,
    "op12_collocations": collocations_query,
    "op13_spelling": spelling_query,
}
