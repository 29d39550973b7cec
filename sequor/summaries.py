"""Scalar summaries of sequence records.

Arrays are compared through scalars (length, first, last, rounded sum) so the
value hashes of two engines agree; the arrays themselves are still built (the
summaries read every element). The sums are taken per Arrow batch of windows, one place of all windows at a
time: a lambda of the JVM evaluates each element apart, which took most of the time of the window queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.arrays import array_first, array_last, array_len, list_sums
from .params import SequenceSpec

DIGITS = 6
MOMENT_DIGITS = 3


def micros(col: str | Column) -> Column:
    """Microseconds since the epoch of a ``timestamp_ntz`` column (DuckDB: epoch_us)."""
    from .plans.numbering import ntz_micros

    c = F.col(col) if isinstance(col, str) else col
    return ntz_micros(c.cast("timestamp_ntz"))


def rounded(c: Column, digits: int = DIGITS) -> Column:
    return F.round(c.cast("double"), digits)


def window_summary(df: DataFrame, spec: SequenceSpec, keys: list[Column] | None = None) -> DataFrame:
    """Keys, rn, label stats, and per feature the rounded window sum.

    Output columns: series keys, ``ts_us``, ``rn``, ``x_len``, ``x_first``,
    ``x_last`` (of the label base's past window), ``y_len``, ``y_first``,
    ``y_last``, ``y_sum`` (label window) and ``sum_<feature>`` for each feature;
    ``pos_y`` and ``pos_<feature>``: sums of i * x_i, which depend on the order.
    """
    base = spec.label
    x = F.col(base)
    y = F.col(spec.label_col)
    cols = keys if keys is not None else [F.col(c) for c in spec.series]
    cols = cols + [micros(spec.time_col).alias("ts_us"), F.col("rn").cast("bigint").alias("rn")]
    cols += [
        array_len(x).alias("x_len"),
        rounded(array_first(x)).alias("x_first"),
        rounded(array_last(x)).alias("x_last"),
        array_len(y).alias("y_len"),
        rounded(array_first(y)).alias("y_first"),
        rounded(array_last(y)).alias("y_last"),
    ]
    arrays = [spec.label_col, *spec.features]
    rows = df.select(*cols, *[F.col(c).cast("array<double>").alias(f"_a{i}") for i, c in enumerate(arrays)])
    plain = [c for c in rows.columns if c not in {f"_a{i}" for i in range(len(arrays))}]
    sums, moments = ([f"_{kind}{i}" for i in range(len(arrays))] for kind in ("s", "m"))
    schema = T.StructType([rows.schema[c] for c in plain] + [T.StructField(c, T.DoubleType()) for c in (*sums, *moments)])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [list_sums(batch.column(f"_a{i}")) for i in range(len(arrays))]
            columns = [batch.column(c) for c in plain] + [s for s, _ in got] + [m for _, m in got]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    names = ["y", *spec.features]
    total = [rounded(F.col(c)).alias("y_sum" if n == "y" and not i else f"sum_{n}") for i, (n, c) in enumerate(zip(names, sums, strict=True))]
    moment = [rounded(F.col(c), MOMENT_DIGITS).alias(f"pos_{n}") for n, c in zip(names, moments, strict=True)]
    return rows.mapInArrow(add_up, schema).select(*plain, *total, *moment)


def window_summary_sql(
    source_sql: str,
    series: list[str],
    order: list[str],
    time_col: str,
    features: list[str],
    label: str,
    past: int,
    future: int,
    shift: int = 1,
    step: int = 1,
    on_null: str = "drop",
    series_out: list[str] | None = None,
) -> str:
    """DuckDB SQL computing :func:`window_summary` from first principles.

    Window aggregates over row frames replace the arrays: ``count`` for the
    length (NULLs skipped like ``collect_list``), ``first_value`` /
    ``last_value ... IGNORE NULLS`` for the ends, ``sum`` for the sum. A value's place in
    its window is its count in the series less the count before the frame.
    """
    part = ", ".join(series)
    ordr = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    wp = f"(wo ROWS BETWEEN {past - 1} PRECEDING AND CURRENT ROW)"
    wf = f"(wo ROWS BETWEEN {shift} FOLLOWING AND {shift + future - 1} FOLLOWING)"
    d = DIGITS
    sel = [*series]
    sel += [
        f"epoch_us({time_col}) AS ts_us",
        "row_number() OVER wo AS rn",
        "count(*) OVER (PARTITION BY " + part + ") AS n",
        f"count({label}) OVER {wp} AS x_len",
        f"round(first_value({label} IGNORE NULLS) OVER {wp}, {d}) AS x_first",
        f"round(last_value({label} IGNORE NULLS) OVER {wp}, {d}) AS x_last",
        f"count({label}) OVER {wf} AS y_len",
        f"round(first_value({label} IGNORE NULLS) OVER {wf}, {d}) AS y_first",
        f"round(last_value({label} IGNORE NULLS) OVER {wf}, {d}) AS y_last",
        f"round(sum({label}) OVER {wf}, {d}) AS y_sum",
    ]
    sel += [f"round(sum({f}) OVER {wp}, {d}) AS sum_{f}" for f in features]
    sel += [f"count({f}) OVER {wp} AS len_{f}" for f in features]
    m = MOMENT_DIGITS
    upto = f"(wo ROWS BETWEEN UNBOUNDED PRECEDING AND {shift - 1} FOLLOWING)"
    sel += [f"round(sum(c_{label} * {label}) OVER {wf} - count({label}) OVER {upto} * sum({label}) OVER {wf}, {m}) AS pos_y"]
    sel += [f"round(sum(c_{f} * {f}) OVER {wp} - (c_{f} - count({f}) OVER {wp}) * sum({f}) OVER {wp}, {m}) AS pos_{f}" for f in features]
    counted = [f"count({c}) OVER (PARTITION BY {part} ORDER BY {ordr} ROWS UNBOUNDED PRECEDING) AS c_{c}" for c in dict.fromkeys([*features, label])]
    keep = [f"rn >= {past}", f"rn <= n - {future + shift - 1}"]
    if step > 1:
        keep.append(f"(rn - {past}) % {step} = 0")
    if on_null == "drop":
        keep.append(f"y_len = {future}")
        keep += [f"len_{f} = {past}" for f in features]
    out_series = series_out if series_out is not None else series
    out = [*out_series, "ts_us", "rn", "x_len", "x_first", "x_last", "y_len", "y_first", "y_last", "y_sum"]
    out += [f"sum_{f}" for f in features] + ["pos_y"] + [f"pos_{f}" for f in features]
    return (
        f"WITH base AS ({source_sql}),\n"
        f"src AS (SELECT *, {', '.join(counted)} FROM base),\n"
        f"win AS (SELECT {', '.join(sel)} FROM src\n"
        f"  WINDOW wo AS (PARTITION BY {part} ORDER BY {ordr}))\n"
        f"SELECT {', '.join(out)} FROM win WHERE {' AND '.join(keep)}"
    )
