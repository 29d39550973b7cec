"""Array helpers: built-in higher-order functions (JVM side, no Python worker), and for wide summaries of many
windows the same sums over whole Arrow columns (:func:`list_sums`)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def wrap_elements(col: Column | str, element_type: T.DataType | None = None) -> Column:
    """``[a, b]`` -> ``[[a], [b]]``: the nested per-step layout of a sequence record.

    ``element_type`` optionally casts each element (e.g. ``FloatType()`` for the
    float32 record layout) inside the same lambda.
    """
    c = F.col(col) if isinstance(col, str) else col
    if element_type is None:
        return F.transform(c, lambda v: F.array(v))
    return F.transform(c, lambda v: F.array(v.cast(element_type)))


def unwrap_elements(col: Column | str) -> Column:
    """``[[a], [b]]`` -> ``[a, b]`` (inverse of :func:`wrap_elements`)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.transform(c, lambda v: F.try_element_at(v, F.lit(1)))


def array_sum(col: Column | str) -> Column:
    """Left-to-right sum of a numeric array as double; NULL for an empty array."""
    c = F.col(col) if isinstance(col, str) else col
    total = F.aggregate(c, F.lit(0.0).cast("double"), lambda acc, v: acc + v.cast("double"))
    return F.when(F.size(c) > 0, total)


def array_first(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.try_element_at(c, F.lit(1))


def array_last(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.try_element_at(c, F.lit(-1))


def array_len(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.size(c).cast("bigint")


def array_moment(c: str | Column) -> Column:
    """Sum of i * x_i over the elements, counted from 1 (NULL if there are none): tells two orders of the same values apart."""
    c = F.col(c) if isinstance(c, str) else c
    start = F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("w"))
    step = lambda acc, x: F.struct((acc["i"] + 1).alias("i"), (acc["w"] + (acc["i"] + 1) * x.cast("double")).alias("w"))
    return F.when(F.size(c) > 0, F.aggregate(c, start, step, lambda acc: acc["w"]))


def list_sums(column: pa.ListArray) -> tuple[pa.Array, pa.Array]:
    """:func:`array_sum` and :func:`array_moment` of a column of lists of doubles, added up in the same order.

    One step per place in the lists, for all rows at once."""
    starts = column.offsets.to_numpy()
    lengths = np.diff(starts)
    values = column.values.to_numpy(zero_copy_only=False)
    none = ~column.is_valid().to_numpy(zero_copy_only=False) | (lengths == 0)
    if column.values.null_count:
        nulls = np.r_[0, np.cumsum(column.values.is_null().to_numpy(zero_copy_only=False))]
        none |= nulls[starts[1:]] > nulls[starts[:-1]]
    n, most = len(lengths), int(lengths.max(initial=0))
    total, moment = np.zeros(n), np.zeros(n)
    with np.errstate(over="ignore", invalid="ignore"):
        if n and (lengths == most).all():
            for j, x in enumerate(np.ascontiguousarray(values[starts[0]:starts[-1]].reshape(n, most).T), 1):
                total += x
                moment += j * x
        else:
            for j in range(most):
                rows = np.flatnonzero(lengths > j)
                x = values[starts[rows] + j]
                total[rows] += x
                moment[rows] += (j + 1) * x
    return pa.array(total, mask=none), pa.array(moment, mask=none)
