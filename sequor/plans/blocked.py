"""Sequence windows for series too long for one task (W5), and the plan that picks them out.

:func:`sequence_windows_blocked` takes every series through ranges and blocks of
arrays (:mod:`sequor.plans.ranges`). :func:`sequence_windows_auto` sends only hot
series (``n > hot_rows``) there; the rest take the one-shuffle direct plan. The hot
list has at most ``N / hot_rows`` entries and is broadcast only after a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from ..operators import windows as W
from ..params import SequenceSpec
from . import numbering as NB
from .ranges import range_windows

DEFAULT_BLOCK_ROWS = 2_000


def _needed(df: DataFrame, spec: SequenceSpec) -> DataFrame:
    needed = set(spec.series) | set(spec.order) | set(spec.features) | {spec.label}
    return df.select(*[c for c in df.columns if c in needed])


def sequence_windows_blocked(
    df: DataFrame,
    spec: SequenceSpec,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    bucket_rows: int = NB.DEFAULT_BUCKET_ROWS,
    trim: bool = True,
    metrics: list | None = None,
) -> DataFrame:
    """W5 for every series of ``df``: ranges of at most about ``bucket_rows`` rows,
    one task each, cut into blocks of ``block_rows`` anchors (one array per column)."""
    return range_windows(_needed(df, spec), spec, block_rows, bucket_rows, trim, metrics=metrics)


def sequence_windows_auto(
    df: DataFrame,
    spec: SequenceSpec,
    hot_rows: int = NB.DEFAULT_HOT_ROWS,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    bucket_rows: int = NB.DEFAULT_BUCKET_ROWS,
    max_hot_keys: int = NB.MAX_BROADCAST_HOT,
    trim: bool = True,
    metrics: list | None = None,
) -> DataFrame:
    """Direct plan for ordinary series, blocks of arrays for hot ones.

    A small pre-pass (series keys only, partially aggregated) finds the series
    with more than ``hot_rows`` rows behind an explicit size check
    (:func:`sequor.plans.numbering.find_hot`). With none, the result is the
    plain direct plan. Otherwise the anti join removes hot rows *before* the
    direct plan's exchange, so a hot series is never hashed into one
    partition. ``metrics`` gets what is to be added up to the run metrics.
    """
    observation = None
    if metrics is not None:
        observation = Observation("direct")
        metrics.append(observation)
    base = _needed(df, spec)
    series = list(spec.series)
    hot, small, rows = NB.find_hot(base, series, hot_rows, max_hot_keys)
    if hot is None:
        return W.sequence_windows_direct(base, spec, trim=trim, observation=observation)
    keys = hot.select(*series)
    cold = W.sequence_windows_direct(
        NB.join_on(base, keys, series, "left_anti", broadcast=small), spec, trim=trim, observation=observation)
    hot_base = NB.join_on(base, keys, series, "left_semi", broadcast=small)
    return cold.unionByName(range_windows(hot_base, spec, block_rows, bucket_rows, trim, rows, metrics))
