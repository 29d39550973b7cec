"""Projections and partition predicates.

All of them are single ``select`` / ``filter`` steps: Catalyst merges them into
neighbouring projections and, on partitioned layouts, turns the predicates on
``channel`` / ``data_type`` / ``exchange`` / ``date`` into partition filters.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import MDY_PATTERN, is_valid_mdy, parse_mdy
from ..params import CHANNEL_DIRS, DATE_CENTURY_PREFIX, DEFAULT_DATA_TYPE, DEFAULT_EXCHANGE, SequenceSpec


def drop_keys(df: DataFrame, spec: SequenceSpec) -> DataFrame:
    """Drop series keys, order columns and the row number from records."""
    helpers = set(spec.series) | set(spec.order) | {"rn", "n"}
    return df.drop(*[c for c in df.columns if c in helpers])


def split_features_label(df: DataFrame, spec: SequenceSpec, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys..., features struct, label)`` - the reader-side split."""
    return df.select(
        *keys,
        F.struct(*[F.col(f) for f in spec.features]).alias("features"),
        F.col(spec.label_col).alias("label"),
    )


def channel_dir(channel: Column | str) -> Column:
    """Channel alias train/eval/test -> directory name; other values pass through."""
    c = F.col(channel) if isinstance(channel, str) else channel
    mapping = F.create_map(*[F.lit(x) for kv in CHANNEL_DIRS.items() for x in kv])
    return F.coalesce(mapping[c], c)


def select_source(
    df: DataFrame,
    channel: str | None = "train",
    data_type: str | None = DEFAULT_DATA_TYPE,
    exchange: str | None = DEFAULT_EXCHANGE,
) -> DataFrame:
    """Equality on the layout's partition columns (pruned at the scan).

    ``channel`` may be the alias (train/eval/test) or the directory name.
    """
    cond = F.lit(True)
    if channel is not None:
        cond = cond & (F.col("channel") == F.lit(CHANNEL_DIRS.get(channel, channel)))
    if data_type is not None:
        cond = cond & (F.col("data_type") == F.lit(data_type))
    if exchange is not None:
        cond = cond & (F.col("exchange") == F.lit(exchange))
    return df.filter(cond)


def training_dates(df: DataFrame, how: str = "today", date_col: str = "date",
                   today: _dt.date | None = None) -> DataFrame:
    """``all`` / ``today`` / one ``mm-dd-yy`` date.

    ``date_col`` may be a ``date`` column or the ``mm-dd-yy`` directory text.
    ``today`` overrides the current date (tests). An unknown ``how`` raises.
    The predicate is on a partition column, so it prunes directories.
    """
    if how == "all":
        return df
    col = F.col(date_col)
    is_text = dict(df.dtypes)[date_col] == "string"
    if how == "today":
        target = F.lit(today) if today is not None else F.current_date()
    else:
        if not _is_valid_mdy_py(how):
            raise ValueError(f"unexpected training date: {how!r} (expected all, today or mm-dd-yy)")
        target = parse_mdy(F.lit(how))
    if is_text:
        # Compare as text so the predicate stays a plain partition filter.
        target_text = F.date_format(target, "MM-dd-yy")
        return df.filter(col == target_text)
    return df.filter(col == target)


def _is_valid_mdy_py(text: str) -> bool:
    """Driver-side check of a parameter (not data): same rule as :func:`is_valid_mdy`
    (1-2 digit month and day, 2-digit year in the 2000s, a real calendar date)."""
    m = re.fullmatch(MDY_PATTERN, text)
    if not m:
        return False
    month, day, year = (int(g) for g in m.groups())
    try:
        _dt.date(int(DATE_CENTURY_PREFIX) * 100 + year, month, day)
    except ValueError:
        return False
    return True


__all__ = [
    "drop_keys", "split_features_label", "channel_dir", "select_source", "training_dates",
    "is_valid_mdy",
]
