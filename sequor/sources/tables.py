"""Readers for the driver's parquet tables and the stand-in raw series.

The reference's raw series (one timestamp index plus seven float features) are
not part of the driver data, so the ``events`` table stands in for them with
simple expressions that Spark and DuckDB evaluate identically:

=============  ==========================================
column          expression on ``events``
=============  ==========================================
symbol          user_id
s_ts            ts
ohlc_close      value (also the label base)
ohlc_pcr        cast(props.k as double) / 100
ohlc_usw        hour(ts)
ohlc_lsw        minute(ts)
bas_rq          event_id % 7
vol_rq          event_id % 11
cmmc_max        length(event_type)
=============  ==========================================

``event_id`` is kept as the tie-break of the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import DEFAULT_FEATURES, SequenceSpec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_series(spark: SparkSession, sf_dir: str, error_value_missing: bool = False, symbol: str = "user_id") -> DataFrame:
    """``events`` projected into the raw-series layout (doubles, not float32), one series per ``symbol`` value.

    ``error_value_missing`` turns the value of 'error' events into NULL, which
    gives real data with gaps for the NULL policies.
    """
    ev = table(spark, sf_dir, "events")
    close = F.col("value")
    if error_value_missing:
        close = F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(close)
    return ev.select(
        F.col(symbol).alias("symbol"),
        F.col("ts").alias("s_ts"),
        F.col("event_id"),
        close.alias("ohlc_close"),
        (F.get_json_object("props", "$.k").cast("double") / F.lit(100.0)).alias("ohlc_pcr"),
        F.hour("ts").cast("double").alias("ohlc_usw"),
        F.minute("ts").cast("double").alias("ohlc_lsw"),
        (F.col("event_id") % 7).cast("double").alias("bas_rq"),
        (F.col("event_id") % 11).cast("double").alias("vol_rq"),
        F.length("event_type").cast("double").alias("cmmc_max"),
    )


def events_spec(past: int = 60, future: int = 3, **kw) -> SequenceSpec:
    """Series = symbol (user_id); order = (s_ts, event_id): no ties."""
    return SequenceSpec(
        series=("symbol",), order=("s_ts", "event_id"), features=DEFAULT_FEATURES,
        label="ohlc_close", past=past, future=future, **kw,
    )


LINEITEM_ORDER = (
    "l_shipdate", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)


def lineitem_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def lineitem_spec(past: int = 60, future: int = 3, **kw) -> SequenceSpec:
    """Series = l_suppkey; ``lineitem`` has no unique key, so every other
    column breaks ties and the order is total."""
    return SequenceSpec(
        series=("l_suppkey",), order=LINEITEM_ORDER,
        features=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
        label="l_extendedprice", past=past, future=future, **kw,
    )


# SQL for the same stand-in series (used by the DuckDB oracles).
EVENTS_SERIES_SQL = """
SELECT user_id AS symbol, ts AS s_ts, event_id,
       value AS ohlc_close,
       CAST(props->>'k' AS DOUBLE) / 100.0 AS ohlc_pcr,
       CAST(hour(ts) AS DOUBLE) AS ohlc_usw,
       CAST(minute(ts) AS DOUBLE) AS ohlc_lsw,
       CAST(event_id % 7 AS DOUBLE) AS bas_rq,
       CAST(event_id % 11 AS DOUBLE) AS vol_rq,
       CAST(length(event_type) AS DOUBLE) AS cmmc_max
FROM events
"""
