"""Per-series forecasters, batch scoring and regression metrics (M1-M4, A5).

The recurrent network of a single-machine trainer is replaced by forecasters
that Spark fits for all series at once:

* persistence (M2): every horizon predicts the anchor's last value;
* linear v1 (M1): per (series, horizon) ``y_h = a + b * last`` with
  ``regr_slope`` / ``regr_intercept`` - algebraic aggregates with map-side
  partial aggregation, so a huge series is combined in many tasks;
* window ridge v2 (M1): per (series, horizon) ridge regression of ``y_h`` on
  all values of the flattened past x features window, from centred moments that
  tasks take by lagged cross products and Spark merges
  (:mod:`sequor.operators.moments`); only small systems per series are solved
  with numpy;
* lagged ridge: the same on the last ``lags`` values of the label base only.

Scoring (M4) joins the model table to the windows on (series, horizon). Spark
chooses the join by size in bytes: of the files of a stored model, or at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import array_last
from ..params import SequenceSpec
from .moments import fewer_parts, merged, ridge_coefficients, row_moments, unpacked, window_moments


def _join_model(rows: DataFrame, model: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of scored rows to the model table on ``keys`` (NULL-safe).

    No job runs while the plan is built. A stored model is broadcast by the size of its files; that of a
    model still to be fitted is known when its stage has run, and AQE then broadcasts
    it or splits the partitions of a hot series."""
    from ..plans.numbering import join_on

    return join_on(rows, model, keys, "left")


def _last(spec: SequenceSpec) -> Column:
    if spec.label not in spec.features:
        raise ValueError("the label base must be one of the features to use its last value")
    return array_last(spec.label)


def horizon_rows(windows: DataFrame, spec: SequenceSpec, keys: Sequence[str] = ()) -> DataFrame:
    """One row per (anchor, horizon): ``keys..., horizon (1-based), y, last``."""
    keep = list(dict.fromkeys([*spec.series, *keys]))
    return windows.select(
        *keep, _last(spec).alias("last"), F.posexplode(spec.label_col).alias("horizon", "y")
    ).withColumn("horizon", (F.col("horizon") + 1).cast("int"))


def predict_persistence(windows: DataFrame, spec: SequenceSpec, keys: Sequence[str] = ()) -> DataFrame:
    """M2: ``pred = last`` for every horizon."""
    return horizon_rows(windows, spec, keys).withColumn("pred", F.col("last"))


def fit_linear(windows: DataFrame, spec: SequenceSpec) -> DataFrame:
    """M1 v1: ``(series..., horizon, slope, intercept, n_obs)``."""
    h = horizon_rows(windows, spec)
    return h.groupBy(*spec.series, "horizon").agg(
        F.regr_slope("y", "last").alias("slope"),
        F.regr_intercept("y", "last").alias("intercept"),
        F.regr_count("y", "last").alias("n_obs"),
    )


def predict_linear(windows: DataFrame, model: DataFrame, spec: SequenceSpec,
                   keys: Sequence[str] = (), extra: Sequence[str] = ()) -> DataFrame:
    """M4: score windows with the per-series linear model.

    Series without a usable model (fewer than two distinct values) fall back
    to persistence, so every horizon row gets a prediction. ``extra``: further
    model columns to keep.
    """
    h = horizon_rows(windows, spec, keys)
    scored = _join_model(h, model.select(*spec.series, "horizon", "slope", "intercept", *extra), [*spec.series, "horizon"])
    pred = F.when(
        F.col("slope").isNotNull() & F.col("intercept").isNotNull(),
        F.col("intercept") + F.col("slope") * F.col("last"),
    ).otherwise(F.col("last"))
    return scored.withColumn("pred", pred).drop("slope", "intercept")


def regression_metrics(preds: DataFrame, group_cols: Sequence[str] = (), rollup: bool = False) -> DataFrame:
    """A5: per group the mean squared error (the head's loss), mean absolute
    error (the configured loss), label mean, prediction mean and count.

    ``rollup=True`` adds the overall row (group columns NULL) in the same
    aggregation instead of a second pass over the predictions.
    """
    err = F.col("y") - F.col("pred")
    aggs = [
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.avg("y").alias("label_mean"),
        F.avg("pred").alias("pred_mean"),
        F.count(F.lit(1)).alias("n"),
    ]
    if group_cols:
        grouped = preds.rollup(*group_cols) if rollup else preds.groupBy(*group_cols)
        return grouped.agg(*aggs)
    return preds.agg(*aggs)


def record_losses(windows: DataFrame, spec: SequenceSpec, keys: Sequence[str]) -> DataFrame:
    """The squared errors of the persistence forecast per record: ``keys..., sse, terms``. Narrow rows to number in batches."""
    errors = F.transform(spec.label_col, lambda y: (y - _last(spec)) * (y - _last(spec)))
    return windows.select(*keys, F.aggregate(errors, F.lit(0.0), lambda acc, e: acc + e).alias("sse"), F.size(spec.label_col).alias("terms"))


def record_batch_losses(records: DataFrame, batch_cols: Sequence[str] = ("epoch", "batch_id")) -> DataFrame:
    """:func:`batch_losses` from the losses of records."""
    per_batch = records.groupBy(*batch_cols).agg((F.sum("sse") / F.sum("terms")).alias("batch_loss"))
    return per_batch.agg(F.avg("batch_loss").alias("loss"), F.count(F.lit(1)).alias("batches"))


def batch_losses(preds_with_batch: DataFrame, batch_cols: Sequence[str] = ("epoch", "batch_id")) -> DataFrame:
    """A5: mean loss per batch (the estimator's ``loss``) and its average."""
    err = F.col("y") - F.col("pred")
    per_batch = preds_with_batch.groupBy(*batch_cols).agg(F.avg(err * err).alias("batch_loss"))
    return per_batch.agg(F.avg("batch_loss").alias("loss"), F.count(F.lit(1)).alias("batches"))


# --- v2: lagged ridge regression ---------------------------------------------


def _lag_features(spec: SequenceSpec, lags: int) -> list[Column]:
    x = F.col(spec.label)
    # last `lags` values of the label base's past window, oldest first
    return [F.try_element_at(x, F.lit(-(lags - i))).cast("double") for i in range(lags)]


def normal_equations(windows: DataFrame, spec: SequenceSpec, lags: int = 4) -> DataFrame:
    """Sufficient statistics ``X'X`` (upper triangle) and ``X'y`` per (series, horizon).

    X = [1, lag_1 .. lag_L]. Every sum is a plain ``sum`` with partial
    aggregation; output has one row per (series, horizon).
    """
    if lags < 1 or lags > spec.past:
        raise ValueError("lags must be in 1..past")
    h = windows.select(
        *spec.series,
        *[c.alias(f"_x{i + 1}") for i, c in enumerate(_lag_features(spec, lags))],
        F.posexplode(spec.label_col).alias("horizon", "y"),
    ).withColumn("horizon", (F.col("horizon") + 1).cast("int"))
    h = h.withColumn("_x0", F.lit(1.0))
    k = lags + 1
    aggs = []
    for i in range(k):
        for j in range(i, k):
            aggs.append(F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"xx_{i}_{j}"))
        aggs.append(F.sum(F.col(f"_x{i}") * F.col("y")).alias(f"xy_{i}"))
    aggs.append(F.count(F.lit(1)).alias("n_obs"))
    return h.groupBy(*spec.series, "horizon").agg(*aggs)


def _solve_batch(pdf: pd.DataFrame, k: int, ridge: float) -> np.ndarray:
    m = len(pdf)
    A = np.zeros((m, k, k))
    b = np.zeros((m, k))
    for i in range(k):
        for j in range(i, k):
            v = pdf[f"xx_{i}_{j}"].to_numpy(dtype=float)
            A[:, i, j] = v
            A[:, j, i] = v
        b[:, i] = pdf[f"xy_{i}"].to_numpy(dtype=float)
    # ridge on the slopes only, scaled by the number of observations
    reg = np.eye(k)
    reg[0, 0] = 0.0
    A = A + ridge * pdf["n_obs"].to_numpy(dtype=float)[:, None, None] * reg[None, :, :]
    coef = np.full((m, k), np.nan)
    ok = np.isfinite(A).all(axis=(1, 2)) & np.isfinite(b).all(axis=1)  # a NaN would stop all series
    ok[ok] = np.linalg.matrix_rank(A[ok]) == k
    if ok.any():
        coef[ok] = np.linalg.solve(A[ok], b[ok][..., None])[..., 0]
    return coef


def fit_lagged_ridge(windows: DataFrame, spec: SequenceSpec, lags: int = 4, ridge: float = 1e-3) -> DataFrame:
    """M1 v2: ``(series..., horizon, coef array<double>, n_obs)``; coef[0] is the intercept."""
    stats = normal_equations(windows, spec, lags)
    k = lags + 1
    series_fields = [f for f in stats.schema.fields if f.name in spec.series]
    out_schema = T.StructType(
        series_fields
        + [
            T.StructField("horizon", T.IntegerType()),
            T.StructField("coef", T.ArrayType(T.DoubleType())),
            T.StructField("n_obs", T.LongType()),
        ]
    )
    keep = [*spec.series, "horizon", "n_obs"]

    def solve(batches):
        for pdf in batches:
            coef = _solve_batch(pdf, k, ridge)
            out = pdf[keep].copy()
            out["coef"] = [None if np.isnan(row).any() else row.tolist() for row in coef]
            yield out[[f.name for f in out_schema.fields]]

    return stats.mapInPandas(solve, out_schema)


def predict_lagged_ridge(windows: DataFrame, model: DataFrame, spec: SequenceSpec, lags: int = 4,
                         keys: Sequence[str] = ()) -> DataFrame:
    """M4 for v2: dot product of the coefficients with ``[1, lags...]`` (JVM side)."""
    keep = list(dict.fromkeys([*spec.series, *keys]))
    lag_cols = _lag_features(spec, lags)
    h = windows.select(
        *keep, _last(spec).alias("last"), F.array(F.lit(1.0), *lag_cols).alias("_xv"),
        F.posexplode(spec.label_col).alias("horizon", "y"),
    ).withColumn("horizon", (F.col("horizon") + 1).cast("int"))
    scored = _join_model(h, model.select(*spec.series, "horizon", "coef"), [*spec.series, "horizon"])
    dot = F.aggregate(
        F.zip_with("_xv", "coef", lambda a, c: a * c), F.lit(0.0), lambda acc, v: acc + v
    )
    pred = F.when(F.col("coef").isNotNull(), dot).otherwise(F.col("last"))
    return scored.withColumn("pred", pred).drop("_xv", "coef")


# --- v2: ridge regression on the whole window ---------------------------------


def _window_values(spec: SequenceSpec) -> Column:
    """All past x features values, feature by feature, oldest first; NULL where
    one of them is missing (NULL, NaN, infinite or a short window)."""
    values = F.concat(*[F.transform(F.col(c), lambda v: v.cast("double")) for c in spec.features])
    bad = F.exists(values, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when((F.size(values) == spec.past * len(spec.features)) & ~bad, values)


def _solved(parts: DataFrame, series: Sequence[str], future: int, ridge: float) -> DataFrame:
    """``series..., horizon, coef, n_obs`` from parts of moments."""
    if ridge <= 0:
        raise ValueError("ridge must be > 0")
    ways = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    whole = fewer_parts(parts, series, ways)
    out_schema = T.StructType([whole.schema[c] for c in series] + [
        T.StructField("horizon", T.IntegerType()),
        T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("n_obs", T.LongType()),
    ])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        held = {}
        for h, n, mean, m2 in zip(pdf["h"], pdf["n"], pdf["mean"], pdf["m2"], strict=True):
            held[h] = merged(held.get(h), unpacked(n, mean, m2))
        rows = []
        for h in range(1, future + 1):
            m = held.get(h)
            if 0 in held:
                n, mean, m2 = held[0]
                own = np.r_[np.arange(len(mean) - future), len(mean) - future + h - 1]
                m = merged((n, mean[own], m2[np.ix_(own, own)]), m)
            if m is not None:
                fine = np.isfinite(m[1]).all() and np.isfinite(m[2]).all()
                rows.append((h, ridge_coefficients(m, ridge).tolist() if fine else None, m[0]))
        out = pd.concat([pdf[list(series)].iloc[:1]] * len(rows), ignore_index=True)
        out["horizon"], out["coef"], out["n_obs"] = ([r[i] for r in rows] for i in range(3))
        return out[out_schema.names]

    return whole.groupBy(*series).applyInPandas(solve, out_schema)


def fit_window_ridge(windows: DataFrame, spec: SequenceSpec, ridge: float = 1e-3) -> DataFrame:
    """M1 v2 on the flattened window: ``(series..., horizon, coef array<double>, n_obs)``;
    coef[0] is the intercept, then P values per feature in the order of ``spec.features``.

    Minimises the mean squared error plus ``ridge`` x the squared slopes of the
    standardised values. An anchor without all its values or without ``y_h`` is left
    out of horizon h. ``coef`` is NULL where the sums overflow."""
    return _solved(window_moments(windows, spec), spec.series, spec.future, ridge)


def fit_window_ridge_rows(df: DataFrame, spec: SequenceSpec, ridge: float = 1e-3, **plan_options) -> DataFrame:
    """:func:`fit_window_ridge` of the windows of ``df``, from its rows: no window is built."""
    return _solved(row_moments(df, spec, **plan_options), spec.series, spec.future, ridge)


def normal_residuals(windows: DataFrame, model: DataFrame, spec: SequenceSpec, ridge: float, lags: int | None = None) -> DataFrame:
    """How far a ridge model is from the normal equations of ``windows``: per (series, horizon) n_obs, y_mean,
    pred_mean and ``gradient``, the largest slope of the objective, relative to the spread of value and label.

    At the optimum both means agree and every slope is 0. ``lags``: the lagged model (its penalty isn't scaled)."""
    values = _window_values(spec) if lags is None else F.array(*_lag_features(spec, lags))
    h = windows.select(*spec.series, values.alias("_x"), F.posexplode(spec.label_col).alias("horizon", "y"))
    h = h.filter("_x is not null").withColumn("horizon", (F.col("horizon") + 1).cast("int"))
    keys = [*spec.series, "horizon"]
    scored = _join_model(h, model.select(*keys, "coef"), keys)
    dot = F.aggregate(F.zip_with("_x", F.slice("coef", 2, F.size("_x")), lambda x, b: x * b), F.get("coef", F.lit(0)), lambda acc, v: acc + v)
    each = scored.withColumn("pred", dot).select(*keys, "y", "pred", (F.col("y") - F.col("pred")).alias("r"), "coef", F.posexplode("_x").alias("j", "x"))
    each = each.withColumn("b", F.get("coef", F.col("j") + 1))
    penalty = F.lit(ridge) * F.avg("b") * (F.var_pop("x") if lags is None else F.lit(1.0))
    scale = F.stddev_pop("x") * F.stddev_pop("y")
    slope = F.when(scale > 0, F.abs(F.covar_pop("x", "r") - penalty) / scale).otherwise(F.lit(0.0))
    per = each.groupBy(*keys, "j").agg(F.count(F.lit(1)).alias("n_obs"), F.avg("y").alias("y_mean"), F.avg("pred").alias("pred_mean"), slope.alias("slope"))
    return per.groupBy(*keys).agg(F.max("n_obs").alias("n_obs"), F.max("y_mean").alias("y_mean"), F.max("pred_mean").alias("pred_mean"),
                                  F.max("slope").alias("gradient"))


def predict_window_ridge(windows: DataFrame, model: DataFrame, spec: SequenceSpec,
                         keys: Sequence[str] = ()) -> DataFrame:
    """M4 for the window model: persistence where it or the window has no values."""
    keep = list(dict.fromkeys([*spec.series, *keys]))
    h = windows.select(
        *keep, _last(spec).alias("last"), F.concat(F.array(F.lit(1.0)), _window_values(spec)).alias("_xv"),
        F.posexplode(spec.label_col).alias("horizon", "y"),
    ).withColumn("horizon", (F.col("horizon") + 1).cast("int"))
    scored = _join_model(h, model.select(*spec.series, "horizon", "coef"), [*spec.series, "horizon"])
    dot = F.aggregate(F.zip_with("_xv", "coef", lambda a, c: a * c), F.lit(0.0), lambda acc, v: acc + v)
    return scored.withColumn("pred", F.coalesce(dot, F.col("last"))).drop("_xv", "coef")
