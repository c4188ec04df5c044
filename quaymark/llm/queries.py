"""The queries of this subpackage: one ``opN_<name>`` per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, lm, mixing, oracle, pii, secrets, simhash, substring, toxicity, vectors, warc
from .common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicate(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_decontamination, op2_toxicity, op3_warc, op4_substring, op5_pii, op6_lm_scoring, op7_mixing, op8_secrets, op9_simhash,
        op10_embeddings)
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    """The six that SQL can express; the others need XXH64 or a trained model."""
    return dict(oracle.SQL)
