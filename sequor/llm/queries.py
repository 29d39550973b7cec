"""The queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    ann, audit, divergence, jaccard, language, line_dedup, mixing, odd_sketch, packing, repeats, toxicity, vector_codes, warc,
)
from .common import load

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(load(spark, sf_dir, "pages"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(load(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(load(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(load(spark, sf_dir, "documents"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.report(load(spark, sf_dir, "embeddings"))


def op7_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.report(load(spark, sf_dir, "documents"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.report(load(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(load(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(load(spark, sf_dir, "documents"))


def op11_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.report(load(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(load(spark, sf_dir, "embeddings"))


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(load(spark, sf_dir, "documents"))


QUERIES: dict[str, QueryFn] = {
    f.__name__: f for f in (
        op1_toxicity, op2_warc, op3_line_dedup, op4_packing, op5_language, op6_ann, op7_divergence, op8_jaccard, op9_mixing,
        op10_repeats, op11_odd_sketch, op12_vector_codes, op13_audit,
    )
}
ORACLES: dict[str, str] = {
    "op2_warc": warc.SQL, "op3_line_dedup": line_dedup.SQL, "op12_vector_codes": vector_codes.SQL, "op13_audit": audit.SQL,
}
