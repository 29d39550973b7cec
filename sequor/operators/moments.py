"""Centred, mergeable moments of window values (the sums behind M1 v2).

For the vector z = (all past x features values of an anchor's window, its labels) a
series needs the count, the mean and the co-moments sum((z - mean)(z - mean)').
They merge pairwise and keep their digits whatever the size of the means; sums of
raw products don't.

:func:`row_moments` takes them from the rows of the series, without building windows:
in a run of anchors, sum_a x(a-l) x(a-m)' depends on l and m through the lag m - l but for
the rows at the ends of the run. So only x(a) x(a-m)' is summed over the anchors, for
each lag; each further pair (l+1, m+1) follows from (l, m) by adding the row that enters
and taking off the one that leaves. That is P K^2 products an anchor in place of (P K)^2.
:func:`window_moments` takes them from windows that are there already.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..params import SequenceSpec

Moments = tuple[int, np.ndarray, np.ndarray]
SALTS = 32
#: Bytes of moments that a task holds at once.
MOST_BYTES = 8 << 20
#: Blocks whose columns are Python objects at once.
MOST_BLOCKS = 256


def most_held(spec: SequenceSpec) -> int:
    """Series whose moments a task holds at once."""
    return max(1, MOST_BYTES // (8 * (spec.past * len(spec.features) + spec.future) ** 2))


def merged(a: Moments | None, b: Moments | None) -> Moments | None:
    """The moments of two sets of rows together."""
    if a is None or b is None:
        return b if a is None else a
    n = a[0] + b[0]
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def direct(z: np.ndarray) -> Moments | None:
    """The moments of the rows of z."""
    if not len(z):
        return None
    mean = z.mean(0)
    c = z - mean
    more = c.mean(0)  # what rounding left
    return len(z), mean + more, c.T @ c - len(z) * np.outer(more, more)


def of_run(x: np.ndarray, y: np.ndarray, past: int) -> Moments:
    """The moments of a run of anchors: ``x`` holds ``past - 1`` rows before the first anchor and one row per
    anchor, ``y`` the labels of each. Values come feature by feature, oldest first, then the labels."""
    n, k, f = len(y), x.shape[1], y.shape[1]
    cx, cy = x.mean(0), y.mean(0)
    x, y = x - cx, y - cy
    at = lambda lag: x[past - 1 - lag:past - 1 - lag + n]
    own = at(0)
    g = np.empty((past, past, k, k))
    early = x[past - 2::-1] if past > 1 else x[:0]  # the row before the first anchor, the one before it, ...
    late = x[:past - 2 + n - past + 1:-1][:past - 1] if past > 1 else x[:0]  # the last anchor's row, the one before it, ...
    for d in range(past):
        first = own.T @ at(d)
        steps = past - 1 - d
        enter = early[:steps, :, None] * early[d:d + steps, None, :]
        leave = late[:steps, :, None] * late[d:d + steps, None, :]
        along = first + np.concatenate([np.zeros((1, k, k)), np.cumsum(enter - leave, 0)])
        lags = np.arange(past - d)
        g[lags, lags + d] = along
        g[lags + d, lags] = along.transpose(0, 2, 1)
    v = past * k + f
    out, total = np.empty((v, v)), np.empty(v)
    age = np.arange(past - 1, -1, -1)  # oldest first
    out[:past * k, :past * k] = g[age][:, age].transpose(2, 0, 3, 1).reshape(past * k, past * k)
    cross = np.stack([at(lag).T @ y for lag in age], 1).reshape(past * k, f)
    out[:past * k, past * k:], out[past * k:, :past * k], out[past * k:, past * k:] = cross, cross.T, y.T @ y
    total[:past * k], total[past * k:] = np.stack([at(lag).sum(0) for lag in age], 1).ravel(), y.sum(0)
    mean = total / n
    return n, mean + np.r_[np.repeat(cx, past), cy], out - n * np.outer(mean, mean)


def of_block(x: np.ndarray, label: np.ndarray, anchors: np.ndarray, spec: SequenceSpec) -> dict[int, Moments]:
    """The moments of anchors (places in the rows x, ascending) whose values are all finite: under 0 of those with all
    labels, under h of the others that have label h."""
    past = spec.past
    if not len(anchors):
        return {}
    bad = np.r_[0, np.cumsum(~np.isfinite(x).all(1))]
    anchors = anchors[bad[anchors + 1] - bad[anchors + 1 - past] == 0]
    y = label[anchors[:, None] + spec.shift + np.arange(spec.future)]
    whole = np.isfinite(y).all(1)
    full, y_full = anchors[whole], y[whole]
    windows = lambda a: np.lib.stride_tricks.sliding_window_view(x, past, axis=0)[a - past + 1].reshape(len(a), -1)
    found: Moments | None = None
    cut = np.flatnonzero(np.diff(full) != 1) + 1
    loose = []
    for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(full)], strict=True):
        if hi - lo >= past:
            found = merged(found, of_run(x[full[lo] - past + 1:full[hi - 1] + 1], y_full[lo:hi], past))
        else:
            loose.append(np.arange(lo, hi))
    if loose:
        at = np.concatenate(loose)
        found = merged(found, direct(np.c_[windows(full[at]), y_full[at]]))
    out = {0: found} if found is not None else {}
    for h in range(spec.future):
        some = ~whole & np.isfinite(y[:, h])
        if some.any():
            out[h + 1] = direct(np.c_[windows(anchors[some]), y[some, h]])
    return out


def _schema(series: Sequence[T.StructField]) -> T.StructType:
    return T.StructType([*series, T.StructField("h", T.IntegerType()), T.StructField("n", T.LongType()),
                         T.StructField("mean", T.BinaryType()), T.StructField("m2", T.BinaryType())])


def unpacked(n: int, mean: bytes, m2: bytes) -> Moments:
    """Moments from a row: doubles, little-endian."""
    m = np.frombuffer(mean, "<f8")
    return int(n), m, np.frombuffer(m2, "<f8").reshape(len(m), len(m))


def _batch(held: dict[tuple, Moments], schema: T.StructType, kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array([k[i] for k in held], kind) for i, kind in enumerate(kinds)]
    columns += [pa.array([k[-1] for k in held], pa.int32()), pa.array([m[0] for m in held.values()], pa.int64())]
    columns += [pa.array([m[i].astype("<f8").tobytes() for m in held.values()], pa.binary()) for i in (1, 2)]
    return pa.RecordBatch.from_arrays(columns, names=schema.names)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists as one array of doubles, NULLs as NaN."""
    return column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)


def window_moments(windows: DataFrame, spec: SequenceSpec) -> DataFrame:
    """``series..., h, n, mean, m2`` per task, from windows (see :func:`of_block` for h). A window without all
    its values is left out."""
    k = len(spec.series)
    schema = _schema([windows.schema[c] for c in spec.series])
    size = spec.past * len(spec.features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Moments] = {}
        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [batch.column(i).type for i in range(k)]
            ok = np.ones(batch.num_rows, bool)
            parts = []
            for c in spec.features:
                col = batch.column(c)
                lengths = np.diff(col.offsets.to_numpy()) * col.is_valid().to_numpy(zero_copy_only=False)
                ok &= lengths == spec.past
            rows = np.flatnonzero(ok)
            some = batch.take(pa.array(rows))
            if not len(rows):
                continue
            for c in spec.features:
                parts.append(_matrix(some.column(c)).reshape(len(rows), spec.past))
            x = np.concatenate(parts, 1)
            y = np.full((len(rows), spec.future), np.nan)
            for i, v in enumerate(some.column(spec.label_col).to_pylist()):
                for h, value in enumerate((v or [])[:spec.future]):
                    y[i, h] = np.nan if value is None else value
            fine = np.isfinite(x).all(1)
            keys = list(zip(*(some.column(i).to_pylist() for i in range(k)), strict=True))
            by: dict[tuple, list[int]] = {}
            for i in np.flatnonzero(fine).tolist():
                by.setdefault(keys[i], []).append(i)
            for key, at in by.items():
                whole = np.isfinite(y[at]).all(1)
                own = np.array(at)
                new = {0: direct(np.c_[x[own[whole]], y[own[whole]]])}
                for h in range(spec.future):
                    part = own[~whole & np.isfinite(y[own, h])]
                    new[h + 1] = direct(np.c_[x[part], y[part, h]])
                for h, m in new.items():
                    if m is not None:
                        held[(*key, h)] = merged(held.get((*key, h)), m)
            if len(held) > most_held(spec):
                yield _batch(held, schema, kinds)
                held = {}
        if held:
            yield _batch(held, schema, kinds)

    assert size > 0
    return windows.select(*spec.series, *spec.features, spec.label_col).mapInArrow(run, schema)


def row_moments(df: DataFrame, spec: SequenceSpec, block_rows: int = 4_000, rows_per_range: int = 1_000_000, rows: int | None = None) -> DataFrame:
    """The same from the rows of the series: blocks of their ranges (:mod:`sequor.plans.ranges`), and windows only for the
    few anchors beside the boundary of two ranges. For ``on_null="drop"``."""
    from ..plans import ranges as RA

    if spec.on_null != "drop":
        raise ValueError("moments of rows need on_null='drop'")
    spec = spec.with_(nested=False)
    blocks, keys, cut = RA.located_blocks(df, spec, block_rows, rows_per_range, rows)
    k = len(keys)
    place = {name: f"_v{j}" for j, (_, name) in enumerate(RA.value_columns(spec))}
    schema = _schema([df.schema[c] for c in spec.series])
    ahead = spec.shift + spec.future - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Moments] = {}
        kinds: list[pa.DataType] = []
        for batch in (b.slice(lo, MOST_BLOCKS) for b in batches for lo in range(0, b.num_rows, MOST_BLOCKS)):
            kinds = [batch.column(i).type for i in range(k)]
            own = batch.drop_columns([c for c in batch.schema.names if c.startswith("_v")]).to_pylist()
            for i, b in enumerate(own):
                x = np.stack([_matrix(batch.column(place[f]).slice(i, 1)) for f in spec.features], 1)
                label = _matrix(batch.column(place[spec.label]).slice(i, 1))
                anchors = np.arange(b["_lo"], b["_hi"] + 1, spec.step) + b["before"]
                # drop: no NULL among the labels (NaN is a value, left out per horizon)
                zl = np.array(b["zl"])
                anchors = anchors[zl[anchors + ahead + 1] == zl[anchors + spec.shift]]
                key = tuple(b[c] for c in keys)
                for h, m in of_block(x, label, anchors, spec).items():
                    held[(*key, h)] = merged(held.get((*key, h)), m)
                if len(held) > most_held(spec):
                    yield _batch(held, schema, kinds)
                    held = {}
        if held:
            yield _batch(held, schema, kinds)

    inner = RA.anchor_span(blocks, spec, True)
    inner = inner.select(*keys, "_lo", "_hi", "before", "zl", *sorted({place[c] for c in (*spec.features, spec.label)}, key=lambda c: int(c[2:])))
    out = inner.mapInArrow(run, schema)
    if cut:
        out = out.unionByName(window_moments(RA.border_windows(blocks, spec, keys, True), spec))
    return out


def _adder(keys: list[str], names: list[str]):
    def add(pdf):  # noqa: ANN001
        total: Moments | None = None
        for n, mean, m2 in zip(pdf["n"], pdf["mean"], pdf["m2"], strict=True):
            total = merged(total, unpacked(n, mean, m2))
        out = pdf[keys].iloc[:1].copy()
        out["n"], out["mean"], out["m2"] = total[0], [total[1].tobytes()], [total[2].tobytes()]
        return out[names]

    return add


def fewer_parts(parts: DataFrame, series: Sequence[str], ways: int) -> DataFrame:
    """At most SALTS rows per series and h where tasks may have made more, up to ``ways``: who merges the parts of a
    hot series then gets few of them."""
    if ways <= 2 * SALTS:
        return parts
    keys = [*series, "h"]
    return parts.withColumn("_salt", F.spark_partition_id() % SALTS).groupBy(*keys, "_salt").applyInPandas(_adder(keys, parts.schema.names), parts.schema)


def ridge_coefficients(m: Moments, ridge: float) -> np.ndarray:
    """Intercept and slopes for the last value of z on the others. The penalty is ``ridge`` times
    each value's variance, so scales don't matter; a constant value gets 0."""
    n, mean, m2 = m
    cov = m2 / n
    var = np.diag(cov)[:-1]
    varies = var > (8 * np.finfo(float).eps) ** 2 * (var + mean[:-1] ** 2)
    scale = np.sqrt(np.where(varies, var, 1.0))
    a = (cov[:-1, :-1] / np.outer(scale, scale))[np.ix_(varies, varies)]
    own = np.zeros(len(var))
    own[varies] = np.linalg.solve(a + ridge * np.eye(len(a)), (cov[:-1, -1] / scale)[varies])
    slopes = own / scale
    return np.r_[mean[-1] - slopes @ mean[:-1], slopes]
