"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of every node of ``edges`` (columns a, b).
    Nodes with no edge to another one aren't returned. The number of rounds grows with the
    logarithm of the largest component; only the count and a hash of the edges reach the driver."""
    e = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = stored(e, "edges")
    state = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: what is larger than u moves to the least of u and its neighbours
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # small star: u and what is smaller than u move to the least of them
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        e = stored(small.filter(F.col("u") != F.col("v")).distinct(), "small-star")
        new = _state(e)
        if new == state:
            break
        state = new
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
