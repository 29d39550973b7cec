"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: The white space of every word and line rule here: \x20 and \x09 to \x0D.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: the lineage
    is cut, and a lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_array(text: Column) -> Column:
    """The maximal runs of non-white-space of a non-null text, as an array."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def row_key(text: Column) -> Column:
    """Tells rows with the same id apart by their text."""
    return F.xxhash64(text)


def two_hashes(value: Column) -> list[Column]:
    """128 bits of hash as two long columns, from two seeds."""
    return [F.xxhash64(value), F.xxhash64(F.lit(7), value)]


def bounded_sample(rows: DataFrame, id_col: str, most: int) -> DataFrame:
    """At most ``most`` ids, those with the smallest hashes: a fixed, small table (one id column)."""
    ids = rows.select(id_col).dropna().distinct()
    return ids.orderBy(F.xxhash64(id_col, F.lit("sample")), id_col).limit(most)
