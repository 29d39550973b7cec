"""Deterministic, skew-safe row numbering inside series.

``row_number()`` over ``partitionBy(series)`` sends a whole series to one task.
When one series holds a large share of all rows that task bounds the run time
(and its memory). :func:`number_rows` counts rows per series first (partial
aggregation over the key columns): a series with more than ``hot_rows`` rows is
*hot*. There can be at most ``N / hot_rows`` of them; :func:`find_hot` collects at
most ``MAX_BROADCAST_HOT + 1`` and broadcasts the list only when it is within that
bound (otherwise a shuffle join). With no hot series the plan is the plain
per-series window. Hot series are numbered by ranges of the full order key, see
:mod:`sequor.plans.ranges`: the order may start with any sortable type.

:func:`number_bucketed` numbers rows whose buckets are given by their own key
(the md5 digits of the epoch shuffle): uniform buckets, their counts as offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = 1_000_000
DEFAULT_BUCKET_ROWS = 1_000_000
MAX_BROADCAST_HOT = 100_000

N_ = "_sq_n"
BUCKET = "_sq_b"
OFFSET = "_sq_off"


def ntz_micros(c: Column) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz``, without any time zone.

    (A cast to ``timestamp`` would go through the session zone, where a DST
    gap can reorder wall-clock times.)
    """
    seconds = F.date_part(F.lit("SECOND"), c)  # decimal(8,6): seconds with micros
    return (
        F.unix_date(c.cast("date")).cast("long") * F.lit(86_400_000_000)
        + F.hour(c).cast("long") * F.lit(3_600_000_000)
        + F.minute(c).cast("long") * F.lit(60_000_000)
        + (seconds * F.lit(1_000_000)).cast("long")
    )


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
            broadcast: bool = False) -> DataFrame:
    """Equi-join on ``keys`` where NULL keys match each other (``<=>``).

    A NULL series key is a series like any other (and a classic source of
    skew), so it must neither be dropped by an inner join nor escape the hot
    path. The right side's key columns are dropped from the result.
    """
    keys = list(keys)
    renamed = right.select(*[F.col(k).alias(f"_sq_r_{k}") for k in keys],
                           *[F.col(c) for c in right.columns if c not in keys])
    if broadcast:
        renamed = F.broadcast(renamed)
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_sq_r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(renamed, cond, how)
    if how in ("left_anti", "left_semi", "anti", "semi", "leftanti", "leftsemi"):
        return out
    return out.drop(*[f"_sq_r_{k}" for k in keys])


def find_hot(df: DataFrame, series: Sequence[str], hot_rows: int,
             max_keys: int = MAX_BROADCAST_HOT) -> tuple[DataFrame | None, bool, int | None]:
    """Hot series ``(series..., _sq_n)`` behind a size check, whether they are few, and their rows in all.

    With more than ``max_keys`` hot series the lazy list is returned for a
    shuffle join instead (AQE splits skewed partitions of that join).
    """
    if hot_rows < 1:
        raise ValueError("hot_rows must be >= 1")
    hot = df.groupBy(*series).agg(F.count(F.lit(1)).alias(N_)).filter(F.col(N_) > F.lit(hot_rows))
    rows = hot.limit(max_keys + 1).collect()
    if not rows:
        return None, True, 0
    if len(rows) > max_keys:
        return hot, False, None
    return df.sparkSession.createDataFrame(rows, hot.schema), True, sum(r[N_] for r in rows)


def bounded_local(df: DataFrame, max_rows: int = MAX_BROADCAST_HOT) -> DataFrame | None:
    """``df`` as a local relation when it has at most ``max_rows`` rows (a
    collect of at most ``max_rows + 1`` rows), else ``None``."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def number_bucketed(
    tagged: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    rn: str = "rn",
    total: str | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Number rows of ``tagged`` that already carry a ``_sq_b`` bucket column.

    With ``counts`` (a small, size-checked local table of per-bucket counts,
    see :func:`refine_buckets`) the offsets are broadcast and joined before the
    one exchange of the numbering window; rows of buckets missing from it are
    whole series (offset 0, size from the window). Without it, offsets come
    from per-(series, bucket) counts computed here, and the null-safe offset join
    and the numbering window shuffle the data again. ``total`` optionally names a
    column receiving the group's row count.
    """
    keys = list(series) + [BUCKET]
    if counts is not None:
        by_series = Window.partitionBy(*series).orderBy(BUCKET)
        cols = [*keys, F.coalesce(F.sum("_sq_c").over(by_series.rowsBetween(Window.unboundedPreceding, -1)),
                                  F.lit(0)).cast("long").alias(OFFSET)]
        if total is not None:
            whole_s = by_series.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            cols.append(F.sum("_sq_c").over(whole_s).cast("long").alias("_sq_tot"))
        joined = join_on(tagged, counts.select(*cols), keys, "left", broadcast=True)
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
        out = joined.withColumn(rn, (F.coalesce(F.col(OFFSET), F.lit(0)) + F.row_number().over(w)).cast("long"))
        if total is not None:
            whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            out = out.withColumn(total, F.coalesce(F.col("_sq_tot"), F.count(F.lit(1)).over(whole)).cast("long"))
            out = out.drop("_sq_tot")
        return out.drop(OFFSET)
    # The bucket counts need no exchange beyond this one; the null-safe join
    # and the window add one each.
    tagged = tagged.repartition(*[F.col(k) for k in keys])
    counts = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_sq_c"))
    by_series = Window.partitionBy(*series).orderBy(BUCKET)
    before = by_series.rowsBetween(Window.unboundedPreceding, -1)
    cols = [*keys, F.coalesce(F.sum("_sq_c").over(before), F.lit(0)).cast("long").alias(OFFSET)]
    if total is not None:
        whole = by_series.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        cols.append(F.sum("_sq_c").over(whole).cast("long").alias(total))
    offsets = counts.select(*cols)
    joined = join_on(tagged, offsets, keys, "inner")
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return joined.withColumn(rn, (F.col(OFFSET) + F.row_number().over(w)).cast("long")).drop(OFFSET)


def number_rows(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    hot_rows: int = DEFAULT_HOT_ROWS,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    rn: str = "rn",
    n: str = "n",
) -> DataFrame:
    """Add 1-based ``rn`` (order inside the series) and the series size ``n``.

    Series of more than ``hot_rows`` rows are numbered in ranges of at most about
    ``bucket_rows`` rows, all others by a window per series."""
    from .ranges import number_ranges

    series, order = list(series), list(order)

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*series).orderBy(*[F.col(c).asc_nulls_first() for c in order])
        return rows.withColumns({
            rn: F.row_number().over(w).cast("long"),
            n: F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        })

    hot, small, rows = find_hot(df, series, hot_rows)
    if hot is None:
        return plain(df)
    keys = hot.select(*series)
    cold = plain(join_on(df, keys, series, "left_anti", broadcast=small))
    numbered = number_ranges(join_on(df, keys, series, "left_semi", broadcast=small), series, order, bucket_rows, rn, n, rows)
    return cold.unionByName(numbered)
