"""Sequence windows: the data-processing kernel.

Every anchor row of a series gets

* one trailing window per feature: the anchor and the ``past - 1`` rows before
  it (row frames, so time gaps neither break nor shorten a window), and
* one leading label window: ``future`` rows of the label base starting
  ``shift`` rows after the anchor (the anchor itself is excluded).

All window expressions share one partitioning (the series keys) and one
ordering, so Catalyst plans a single ``Exchange hashpartitioning(series)``,
one ``Sort`` and one ``Window`` node for the whole projection. The trims are
filters on the window output and are never pushed below it by hand (that
would shorten frames).

NULL semantics: ``collect_list`` skips NULLs, so a NULL inside a frame gives a
short window. ``on_null="keep"`` keeps such rows (reference behaviour),
``"drop"`` keeps only anchors whose every window is full, ``"fail"`` raises
at run time on the first short window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..params import SequenceSpec

RN = "rn"
N = "n"
SHORT_WINDOW = "sequence window shorter than requested: NULL inside a frame (on_null='fail')"


def order_columns(spec: SequenceSpec) -> list[Column]:
    """Ascending, NULLs first: a NULL time index lands at the series head."""
    return [F.col(c).asc_nulls_first() for c in spec.order]


def series_window(spec: SequenceSpec) -> WindowSpec:
    return Window.partitionBy(*spec.series).orderBy(*order_columns(spec))


def past_frame(spec: SequenceSpec, w: WindowSpec | None = None) -> WindowSpec:
    w = w if w is not None else series_window(spec)
    return w.rowsBetween(-(spec.past - 1), 0)


def future_frame(spec: SequenceSpec, w: WindowSpec | None = None) -> WindowSpec:
    w = w if w is not None else series_window(spec)
    return w.rowsBetween(spec.shift, spec.shift + spec.future - 1)


def whole_frame(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


# --- single building blocks -------------------------------------------------


def all_windows(df: DataFrame, spec: SequenceSpec, plan: str = "auto", **plan_options) -> DataFrame:
    """Every row with its past windows, label window and ``rn`` - no trims.

    Same plans as :func:`sequence_windows` (hot series split into blocks)."""
    return sequence_windows(df, spec, plan=plan, trim=False, **plan_options)


def feature_sequences(df: DataFrame, spec: SequenceSpec, plan: str = "auto", **plan_options) -> DataFrame:
    """Series keys, order columns and each feature's trailing window, every row."""
    out = all_windows(df, spec, plan, **plan_options)
    return out.drop(spec.label_col, RN)


def label_sequence(df: DataFrame, spec: SequenceSpec, plan: str = "auto", **plan_options) -> DataFrame:
    """Series keys, order columns and the leading label window, every row."""
    label_only = spec.with_(features=(spec.label,))
    out = all_windows(df, label_only, plan, **plan_options)
    return out.select(*[c for c in out.columns if c not in (spec.label, RN)])


def row_numbers(df: DataFrame, spec: SequenceSpec, name: str = RN, n_name: str | None = None,
                **numbering_options) -> DataFrame:
    """1-based row number inside each series (skew-safe two-phase numbering;
    the plain per-series window when no series is hot). ``n_name`` also adds
    the series size (A1)."""
    from ..plans.numbering import number_rows

    out = number_rows(df, spec.series, spec.order, rn=name, n=n_name or "_sq_n_tmp", **numbering_options)
    return out if n_name else out.drop("_sq_n_tmp")


def series_count(df: DataFrame, spec: SequenceSpec, name: str = N, **numbering_options) -> DataFrame:
    """A1: whole-series row count on every row (taken before any trim).

    Hot series take their count from the partially aggregated statistics, so
    no series is counted inside one task. (For one row per series use
    ``groupBy(series).count()``.)"""
    return row_numbers(df, spec, name="_sq_rn_tmp", n_name=name, **numbering_options).drop("_sq_rn_tmp")


def tail_keep(spec: SequenceSpec, rn: str = RN, n: str = N) -> Column:
    """P4 predicate: the anchor has ``future`` rows after its label offset."""
    return F.col(rn) <= F.col(n) - F.lit(spec.future + spec.shift - 1)


def head_keep(spec: SequenceSpec, rn: str = RN) -> Column:
    """P5 predicate: the anchor has ``past - 1`` rows before it."""
    return F.col(rn) >= F.lit(spec.past)


def stride_keep(spec: SequenceSpec, rn: str = RN) -> Column:
    """W6 predicate: every ``step``-th anchor counted from the first full one."""
    if spec.step == 1:
        return F.lit(True)
    return ((F.col(rn) - F.lit(spec.past)) % F.lit(spec.step)) == 0


def trim_tail(df: DataFrame, spec: SequenceSpec, rn: str = RN, n: str = N) -> DataFrame:
    return df.filter(tail_keep(spec, rn, n))


def trim_head(df: DataFrame, spec: SequenceSpec, rn: str = RN) -> DataFrame:
    return df.filter(head_keep(spec, rn))


# --- the flagship -----------------------------------------------------------


PAST = "_sq_past"
NULLS = "_sq_nulls"
# From this many features on, one struct list beats one list per feature
# (measured: per-feature lists are ~10 % faster for 2 features, the struct
# list is faster from about 4 on).
STRUCT_MIN_FEATURES = 4


def _use_struct(spec: SequenceSpec) -> bool:
    return len(spec.features) >= STRUCT_MIN_FEATURES


def _elem(spec: SequenceSpec, name: str) -> Column:
    """The value a window collects: the column, or ``[float(x)]`` in nested
    layout (NULL stays NULL so ``collect_list`` still skips it)."""
    c = F.col(name)
    if not spec.nested:
        return c
    return F.when(c.isNotNull(), F.array(c.cast("float")))


def window_expressions(spec: SequenceSpec, w: WindowSpec) -> dict[str, Column]:
    """Label, past windows, rn and n over one shared ordering ``w``.

    A sliding row frame re-aggregates its rows for every anchor. With many
    features the past window is therefore ONE ``collect_list`` of a struct of
    all features (one aggregate instead of one per feature) plus ``_sq_nulls``,
    the number of rows in the frame holding a NULL feature, which is all the
    NULL policy needs; :func:`apply_trims` extracts per-feature arrays after
    trimming. With few features each gets its own ``collect_list``. The label
    is taken from the *input* label column, so it is right even when the label
    base is also a feature.
    """
    exprs = {spec.label_col: F.collect_list(_elem(spec, spec.label)).over(future_frame(spec, w))}
    pw = past_frame(spec, w)
    if _use_struct(spec):
        exprs[PAST] = F.collect_list(F.struct(*[_elem(spec, f).alias(f) for f in spec.features])).over(pw)
        any_null = F.lit(False)
        for f in spec.features:
            any_null = any_null | F.col(f).isNull()
        exprs[NULLS] = F.sum(F.when(any_null, F.lit(1)).otherwise(F.lit(0))).over(pw)
    else:
        for f in spec.features:
            exprs[f] = F.collect_list(_elem(spec, f)).over(pw)
    exprs[RN] = F.row_number().over(w)
    exprs[N] = F.count(F.lit(1)).over(whole_frame(w))
    return exprs


def split_past(spec: SequenceSpec, compact: bool) -> list[Column]:
    """Per feature, its values in the struct past frame.

    ``past.<feature>`` is a native array-of-struct field extraction (codegen,
    no lambda). Where a frame may hold NULLs (``compact=True``), they are
    removed as ``collect_list`` would; anchors whose frames hold no NULL
    need no such pass.
    """
    out = []
    for f in spec.features:
        arr = F.col(PAST).getField(f)
        out.append((F.array_compact(arr) if compact else arr).alias(f))
    return out


def full_windows(spec: SequenceSpec, struct_form: bool) -> Column:
    """True when no past frame holds a NULL and the label has ``future`` values."""
    cond = F.size(spec.label_col) == spec.future
    if struct_form:
        return cond & (F.col(NULLS) == 0)
    for f in spec.features:
        cond = cond & (F.size(f) == spec.past)
    return cond


def anchor_metrics(windows: DataFrame, spec: SequenceSpec) -> list[Column]:
    """The two A6 metrics that count anchors, over windows that aren't trimmed."""
    return _metrics(spec, PAST in windows.columns)[2:]


def _metrics(spec: SequenceSpec, struct_form: bool, rn: str = RN, n: str = N) -> list[Column]:
    """A6 metrics over a windowed frame (before trimming): series, series too
    short for any window, anchors with a full range and how many of those hold
    a NULL in a frame (dropped under ``on_null="drop"``)."""
    in_range = head_keep(spec, rn) & tail_keep(spec, rn, n) & stride_keep(spec, rn)
    short = (F.col(rn) == 1) & (F.col(n) < F.lit(spec.past + spec.future + spec.shift - 1))
    return [
        F.sum(F.when(F.col(rn) == 1, 1).otherwise(0)).alias("series"),
        F.sum(F.when(short, 1).otherwise(0)).alias("short_series"),
        F.sum(F.when(in_range, 1).otherwise(0)).alias("anchors_in_range"),
        F.sum(F.when(in_range & ~full_windows(spec, struct_form), 1).otherwise(0)).alias("anchors_with_null"),
    ]


def apply_trims(df: DataFrame, spec: SequenceSpec, rn: str = RN, n: str = N, trim: bool = True,
                observation=None) -> DataFrame:
    """Head, tail and stride trims, the NULL policy, then the per-feature arrays.

    The trims only read ``rn`` and ``n``, so they run before any array is
    materialised per feature. ``trim=False`` keeps every row with its (possibly
    short) windows, NULLs skipped - the W1 / W2 building blocks.
    """
    struct_form = PAST in df.columns
    if observation is not None:
        df = df.observe(observation, *_metrics(spec, struct_form, rn, n))
    if not trim:
        if not struct_form:
            return df
        return df.select(*[c for c in df.columns if c not in (PAST, NULLS)], *split_past(spec, True))
    keep = head_keep(spec, rn) & tail_keep(spec, rn, n) & stride_keep(spec, rn)
    if spec.on_null == "drop":
        keep = keep & full_windows(spec, struct_form)
    elif spec.on_null == "fail":
        guard = F.when(
            ~full_windows(spec, struct_form),
            F.raise_error(F.lit(SHORT_WINDOW)),
        ).otherwise(F.lit(True))
        keep = keep & guard
    kept = df.filter(keep)
    if not struct_form:
        return kept
    compact = spec.on_null == "keep"
    return kept.select(*[c for c in kept.columns if c not in (PAST, NULLS)], *split_past(spec, compact))


def output_columns(df: DataFrame, spec: SequenceSpec) -> list[str]:
    cols = list(spec.features) + [spec.label_col]
    if spec.keep_keys:
        keys = list(spec.series) + [c for c in spec.order if c not in spec.series] + [RN]
        cols = [k for k in keys if k not in cols] + cols
    return cols


def sequence_windows_direct(df: DataFrame, spec: SequenceSpec, trim: bool = True, observation=None) -> DataFrame:
    """W4 (and W6): one Window node per series partition.

    Cost: one hash exchange on the series keys, one sort, O(rows x past) window
    output. A series is processed by one task, so a single huge series bounds
    the run time; :func:`sequor.plans.blocked.sequence_windows_blocked` splits it.
    """
    needed = set(spec.series) | set(spec.order) | set(spec.features) | {spec.label}
    base = df.select(*[c for c in df.columns if c in needed])
    w = series_window(spec)
    windowed = base.select(
        *[c for c in base.columns if c not in spec.features],
        *[e.alias(name) for name, e in window_expressions(spec, w).items()],
    )
    trimmed = apply_trims(windowed, spec, trim=trim, observation=observation)
    return trimmed.select(*output_columns(trimmed, spec))


def sequence_windows(df: DataFrame, spec: SequenceSpec, plan: str = "auto", **plan_options) -> DataFrame:
    """Turn every series of ``df`` into (past windows, future label) rows.

    plan:
      "direct"  - one task per series (fine when no series is huge);
      "blocked" - blocks with halo for every series (for one very long series);
      "auto"    - series with more than ``hot_rows`` rows go through the blocked
                  plan, all others through the direct plan.
    """
    if plan == "direct":
        return sequence_windows_direct(df, spec, trim=plan_options.get("trim", True),
                                       observation=plan_options.get("observation"))
    from ..plans import blocked

    if plan == "blocked":
        return blocked.sequence_windows_blocked(df, spec, **plan_options)
    if plan == "auto":
        return blocked.sequence_windows_auto(df, spec, **plan_options)
    raise ValueError(f"unknown plan {plan!r}")


def sequence_windows_observed(df: DataFrame, spec: SequenceSpec, plan: str = "auto", name: str = "seqwin",
                              **plan_options):
    """:func:`sequence_windows` plus run metrics collected during the action.

    Returns ``(result, metrics_in, metrics_out)``; after the result is written,
    ``metrics_in.get`` holds ``rows_in`` / ``null_time``, ``series``, ``short_series``,
    ``anchors_in_range`` and ``anchors_with_null`` (the windows the NULL policy
    drops), added up over the branches of the plan; ``metrics_out.get`` holds
    ``windows_out``. ``DataFrame.observe`` aggregates inside the same job, so no extra
    pass over the data is made.
    """
    from pyspark.sql import Observation

    obs_in, obs_out = Observation(f"{name}_in"), Observation(f"{name}_out")
    src = df.observe(
        obs_in,
        F.count(F.lit(1)).alias("rows_in"),
        F.sum(F.when(F.col(spec.time_col).isNull(), 1).otherwise(0)).alias("null_time"),
    )
    parts: list = []
    if plan == "direct":
        parts.append(Observation(f"{name}_windows"))
        out = sequence_windows(src, spec, plan=plan, observation=parts[0], **plan_options)
    else:
        out = sequence_windows(src, spec, plan=plan, metrics=parts, **plan_options)
    out = out.observe(obs_out, F.count(F.lit(1)).alias("windows_out"))
    return out, _Merged(obs_in, *parts), obs_out


class _Merged:
    """Observations and counts read as one: ``.get`` adds up metrics of one name."""

    def __init__(self, *parts):
        self.parts = parts

    @property
    def get(self) -> dict:
        total: dict = {}
        for p in self.parts:
            for k, v in (p if isinstance(p, dict) else p.get).items():
                total[k] = total.get(k, 0) + (v or 0)
        return total
