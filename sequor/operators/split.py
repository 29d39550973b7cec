"""Chronological train / eval / test split per series.

For a series of ``n`` rows, the last ``floor(n * test% / 100)`` rows are test,
the ``floor(n * val% / 100)`` rows before them are eval and the rest is
train. Integer percent arithmetic avoids float edges (0.2 * 5 is exactly 1).
Windows are built *after* splitting, keyed by (series, channel), so no
window crosses a channel boundary.

Row positions come from the skew-safe numbering plan, so a huge series is
never ranked inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import TrainingParams
from ..plans.numbering import DEFAULT_BUCKET_ROWS, DEFAULT_HOT_ROWS, number_rows


def _pct(fraction: float) -> int:
    pct = round(fraction * 100)
    if abs(pct - fraction * 100) > 1e-9:
        raise ValueError(f"split fractions must be whole percents, got {fraction}")
    return pct


def channel_of(rn: Column, n: Column, test_pct: int, val_pct: int) -> Column:
    n_test = F.floor(n * F.lit(test_pct) / F.lit(100)).cast("long")
    n_val = F.floor(n * F.lit(val_pct) / F.lit(100)).cast("long")
    return (
        F.when(rn > n - n_test, F.lit("test"))
        .when(rn > n - n_test - n_val, F.lit("eval"))
        .otherwise(F.lit("train"))
    )


def split_chronological(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    params: TrainingParams = TrainingParams(),
    channel_col: str = "channel",
    hot_rows: int = DEFAULT_HOT_ROWS,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    keep_positions: bool = False,
) -> DataFrame:
    """Add ``channel`` in {train, eval, test} to every row."""
    numbered = number_rows(df, series, order, hot_rows=hot_rows, bucket_rows=bucket_rows,
                           rn="_sq_rn", n="_sq_cnt")
    ch = channel_of(F.col("_sq_rn"), F.col("_sq_cnt"), _pct(params.test_size), _pct(params.val_size))
    out = numbered.withColumn(channel_col, ch)
    if keep_positions:
        return out.withColumnRenamed("_sq_rn", "split_rn").withColumnRenamed("_sq_cnt", "split_n")
    return out.drop("_sq_rn", "_sq_cnt")
