"""The registered queries of the corpus operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridcube.llm import (
    exact, html_text, language, minhash, mixing, near_vectors, packing, quality, token_counts, token_files, toxicity, turns, whitening)
from gridcube.llm.common import table


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.damaged_and_repaired(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_near_vectors": op1_near_vectors,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_language_id": op4_language_id,
    "op5_toxicity": op5_toxicity,
    "op6_quality": op6_quality,
    "op7_mixing": op7_mixing,
    "op8_html_extraction": op8_html_extraction,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_token_files": op10_token_files,
    "op11_token_counts": op11_token_counts,
    "op12_turn_repair": op12_turn_repair,
    "op13_whitening": op13_whitening,
}

ORACLES = {
    "op1_near_vectors": near_vectors.ORACLE,
    "op3_exact_dedup": exact.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op9_minhash_near_dedup": minhash.ORACLE,
    "op12_turn_repair": turns.ORACLE,
}
