"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (bwt_dedup, decontaminate, hard_negatives, jaccard_join, mixing, nn_descent, pii, prefix_bpe, quality, secrets,
                         toxicity, url_rules, whitening)
from tessera.llm.common import read_table
from tessera.llm.oracles import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read_table(spark, sf_dir, "documents"))


def op2_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read_table(spark, sf_dir, "documents"))


def op3_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_query(spark, sf_dir)


def op4_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate_query(spark, sf_dir)


def op5_url_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.url_query(spark, sf_dir)


def op6_rlbwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.repeats_query(spark, sf_dir)


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_query(read_table(spark, sf_dir, "documents"))


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.embedding_query(spark, sf_dir)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_query(read_table(spark, sf_dir, "documents"))


def op10_toxicity_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_query(spark, sf_dir)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives_query(spark, sf_dir)


def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.encode_query(spark, sf_dir)


def op13_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_query(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_secret_scan, op2_pii_weak_supervision, op3_pu_quality, op4_spaced_seed_decontamination,
    op5_url_association_rules, op6_rlbwt_dedup, op7_ngram_jaccard_join, op8_nn_descent, op9_source_mixing, op10_toxicity_bigru,
    op11_hard_negatives, op12_prefix_bpe, op13_bit_sliced_whitening)}
