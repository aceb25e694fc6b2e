"""The operators as registered queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sheetwright.llm import (bpe, decontaminate, fingerprints, hard_negatives, language, lines, minhash, mixing, secret_scan, sharding,
                             suffix_dedup, toxicity, whitening)
from sheetwright.llm.common import table


def op1_winnowing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.fingerprinted(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page without the boilerplate lines of its host."""
    return lines.without_boilerplate(table(spark, sf_dir, "pages"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages found in every document, and whether it is contaminated."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.sharded(table(spark, sf_dir, "documents"), shards=8)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op6_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language.predicted(table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated byte strings removed from every document."""
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op9_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), k=5, per_cent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.report(table(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer file."""
    return public_tokenizers.path(name)


def op11_polarised_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding."""
    return whitening.report(table(spark, sf_dir, "embeddings"), components=32)


def op12_bpe_rank_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to."""
    return bpe.report(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive."""
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_winnowing_fingerprints, op2_line_dedup, op3_benchmark_decontamination, op4_stratified_sharding, op5_source_mixing, op6_toxicity_grammar, op7_language_id,
    op8_suffix_array_dedup, op9_minmax_near_dedup, op10_secret_scan, op11_polarised_whitening, op12_bpe_rank_array, op13_hard_negatives)}

ORACLES: dict[str, str] = {
    "op2_line_dedup": lines.SQL, "op3_benchmark_decontamination": decontaminate.SQL, "op9_minmax_near_dedup": minhash.SQL,
    "op13_hard_negatives": hard_negatives.SQL}
