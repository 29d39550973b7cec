"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

1. toxicity: documents that the subsequence-kernel SVM rejects go (score >= 0.7).
2. line dedup: lines found in five documents or more stay in the largest id only.
3. near duplicates: one document of each group of similar texts stays (five words, 0.8).
4. mixing: sources are drawn to their target weights; a document comes out once per pass.
5. packing: documents are tokenized and packed into sequences of at most 2048 tokens.

All stages but the last return the columns of ``documents``. A stage works on every row its
predecessor kept. Null texts count as empty; a document without words isn't drawn by the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sequor.llm import jaccard, line_dedup, mixing, packing, toxicity
from sequor.llm.common import load, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, toxicity.train(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.report(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifier nor the draws; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
