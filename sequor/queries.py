"""Registered queries: one per operator of the inventory, each with its DuckDB oracle.

Every query takes ``(spark, sf_dir)``, reads the driver's tables and returns a
DataFrame of scalar columns (arrays are summarised, see
:mod:`sequor.summaries`). ``ORACLES[name]`` is SQL over the same tables whose
result must equal the query's, column names included. Queries without an
oracle get a rows-only check and are tested against brute force in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.arrays import array_first, array_last, array_len, array_sum, wrap_elements
from .operators import windows as W
from .params import DEFAULT_FEATURES
from .plans import blocked
from .sources.tables import (
    EVENTS_SERIES_SQL,
    LINEITEM_ORDER,
    events_series,
    events_spec,
    lineitem_series,
    lineitem_spec,
)
from .summaries import DIGITS, micros, rounded, window_summary, window_summary_sql

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


FEATS = list(DEFAULT_FEATURES)
EV_ORDER = ["s_ts", "event_id"]
D = DIGITS

# ---------------------------------------------------------------------------
# W4 flagship and its variants
# ---------------------------------------------------------------------------


@query(
    "sequence_windows",
    window_summary_sql(EVENTS_SERIES_SQL, ["symbol"], EV_ORDER, "s_ts", FEATS, "ohlc_close", 60, 3),
)
def q_sequence_windows(spark, sf):
    """Past windows of all seven features + 3-step label, P=60, auto plan."""
    spec = events_spec(60, 3)
    return window_summary(W.sequence_windows(events_series(spark, sf), spec, plan="auto"), spec)


@query(
    "sequence_windows_p8",
    window_summary_sql(EVENTS_SERIES_SQL, ["symbol"], EV_ORDER, "s_ts", FEATS, "ohlc_close", 8, 3),
)
def q_sequence_windows_p8(spark, sf):
    """W4 minimum slice: P=8, F=3 (850 / 8 500 / 85 000 rows)."""
    spec = events_spec(8, 3)
    return window_summary(W.sequence_windows(events_series(spark, sf), spec, plan="auto"), spec)


_GLOBAL_EVENTS_SQL = f"SELECT 'all' AS stream, * FROM ({EVENTS_SERIES_SQL})"


@query(
    "sequence_windows_blocked",
    window_summary_sql(_GLOBAL_EVENTS_SQL, ["stream"], EV_ORDER, "s_ts", FEATS, "ohlc_close", 60, 3),
)
def q_sequence_windows_blocked(spark, sf):
    """All events as ONE series, in ranges of about 1 000 rows cut into
    blocks of arrays (the plan for a series too long for a task)."""
    spec = events_spec(60, 3).with_(series=("stream",))
    src = events_series(spark, sf).withColumn("stream", F.lit("all"))
    out = blocked.sequence_windows_blocked(src, spec, block_rows=2000, bucket_rows=1000)
    return window_summary(out, spec)


@query(
    "sequence_windows_auto_hot",
    window_summary_sql(EVENTS_SERIES_SQL, ["symbol"], EV_ORDER, "s_ts", FEATS, "ohlc_close", 60, 3),
)
def q_sequence_windows_auto_hot(spark, sf):
    """Auto plan with a low hot threshold: series above 70 rows take the blocked
    branch, the rest the direct one; the union equals W4."""
    spec = events_spec(60, 3)
    out = W.sequence_windows(
        events_series(spark, sf), spec, plan="auto", hot_rows=70, block_rows=16, bucket_rows=20
    )
    return window_summary(out, spec)


@query(
    "sequence_windows_lineitem",
    window_summary_sql(
        "SELECT * FROM lineitem", ["l_suppkey"], list(LINEITEM_ORDER), "l_shipdate",
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "l_extendedprice", 60, 3,
    ),
)
def q_sequence_windows_lineitem(spark, sf):
    """W4 on ``lineitem`` per supplier, ordered by ship date then every column."""
    spec = lineitem_spec(60, 3)
    return window_summary(W.sequence_windows(lineitem_series(spark, sf), spec, plan="auto"), spec)


@query(
    "win_stride_shift",
    window_summary_sql(
        EVENTS_SERIES_SQL, ["symbol"], EV_ORDER, "s_ts", FEATS, "ohlc_close", 60, 3, shift=2, step=5
    ),
)
def q_win_stride_shift(spark, sf):
    """Every 5th anchor, label starting 2 rows after the anchor; series over 70 rows take ranges."""
    spec = events_spec(60, 3, step=5, shift=2)
    out = W.sequence_windows(events_series(spark, sf), spec, plan="auto", hot_rows=70, block_rows=16, bucket_rows=40)
    return window_summary(out, spec)


# NULL handling: the value of an 'error' event counts as missing.
_NULLY_SQL = EVENTS_SERIES_SQL.replace(
    "value AS ohlc_close", "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS ohlc_close"
)


def _nully_events(spark, sf):
    return events_series(spark, sf, error_value_missing=True)


@query(
    "win_null_keep",
    window_summary_sql(
        _NULLY_SQL, ["symbol"], EV_ORDER, "s_ts", FEATS, "ohlc_close", 8, 3, on_null="keep"
    ),
)
def q_win_null_keep(spark, sf):
    """Reference behaviour: NULLs vanish from windows, short windows survive."""
    spec = events_spec(8, 3, on_null="keep")
    return window_summary(W.sequence_windows(_nully_events(spark, sf), spec, plan="auto"), spec)


@query(
    "win_null_drop",
    window_summary_sql(
        _NULLY_SQL, ["symbol"], EV_ORDER, "s_ts", FEATS, "ohlc_close", 8, 3, on_null="drop"
    ),
)
def q_win_null_drop(spark, sf):
    """Default policy: only anchors whose every window is full."""
    spec = events_spec(8, 3, on_null="drop")
    return window_summary(W.sequence_windows(_nully_events(spark, sf), spec, plan="auto"), spec)


# ---------------------------------------------------------------------------
# W1-W3, A1, P2-P5, F1 building blocks
# ---------------------------------------------------------------------------

_WO = "PARTITION BY symbol ORDER BY s_ts ASC NULLS FIRST, event_id ASC NULLS FIRST"


@query(
    "win_feature_seq",
    f"""
WITH src AS ({EVENTS_SERIES_SQL})
SELECT symbol, epoch_us(s_ts) AS ts_us,
  count(ohlc_close) OVER wp AS x_len,
  round(first_value(ohlc_close) OVER wp, {D}) AS x_first,
  round(sum(ohlc_close) OVER wp, {D}) AS x_sum,
  count(ohlc_pcr) OVER wp AS pcr_len,
  round(sum(ohlc_pcr) OVER wp, {D}) AS pcr_sum
FROM src WINDOW wp AS ({_WO} ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)
""",
)
def q_win_feature_seq(spark, sf):
    """Trailing 60-row windows on every row (no trims)."""
    spec = events_spec(60, 3)
    out = W.feature_sequences(events_series(spark, sf), spec)
    return out.select(
        "symbol", micros("s_ts").alias("ts_us"),
        array_len("ohlc_close").alias("x_len"), rounded(array_first("ohlc_close")).alias("x_first"),
        rounded(array_sum("ohlc_close")).alias("x_sum"),
        array_len("ohlc_pcr").alias("pcr_len"), rounded(array_sum("ohlc_pcr")).alias("pcr_sum"),
    )


@query(
    "win_label_seq",
    f"""
WITH src AS ({EVENTS_SERIES_SQL})
SELECT symbol, epoch_us(s_ts) AS ts_us,
  count(ohlc_close) OVER wf AS y_len,
  round(first_value(ohlc_close) OVER wf, {D}) AS y_first,
  round(last_value(ohlc_close) OVER wf, {D}) AS y_last,
  round(sum(ohlc_close) OVER wf, {D}) AS y_sum
FROM src WINDOW wf AS ({_WO} ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)
""",
)
def q_win_label_seq(spark, sf):
    """Leading 3-row label windows on every row (short at the series end)."""
    spec = events_spec(60, 3)
    out = W.label_sequence(events_series(spark, sf), spec)
    y = spec.label_col
    return out.select(
        "symbol", micros("s_ts").alias("ts_us"), array_len(y).alias("y_len"),
        rounded(array_first(y)).alias("y_first"), rounded(array_last(y)).alias("y_last"),
        rounded(array_sum(y)).alias("y_sum"),
    )


@query(
    "win_row_number",
    f"""
WITH src AS ({EVENTS_SERIES_SQL})
SELECT symbol, event_id, row_number() OVER ({_WO}) AS rn FROM src
""",
)
def q_win_row_number(spark, sf):
    """Row number inside each series."""
    out = W.row_numbers(events_series(spark, sf), events_spec())
    return out.select("symbol", "event_id", F.col("rn").cast("bigint").alias("rn"))


@query(
    "win_row_number_bucketed",
    f"""
WITH src AS ({EVENTS_SERIES_SQL})
SELECT symbol, event_id, row_number() OVER ({_WO}) AS rn,
       count(*) OVER (PARTITION BY symbol) AS n FROM src
""",
)
def q_win_row_number_bucketed(spark, sf):
    """W3, skew-safe form: series over 60 rows are numbered in ranges of about
    16 rows and offsets; equals the one-task row_number."""
    from .plans.numbering import number_rows

    out = number_rows(events_series(spark, sf), ["symbol"], EV_ORDER, hot_rows=60, bucket_rows=16)
    return out.select("symbol", "event_id", "rn", "n")


_NAN_TIME_SQL = """
SELECT user_id AS symbol, event_id,
       CASE WHEN event_id % 5 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(hour(ts) AS DOUBLE) END AS t
FROM events"""


@query(
    "win_row_number_nan_time",
    f"SELECT symbol, event_id, row_number() OVER (PARTITION BY symbol ORDER BY t ASC NULLS FIRST, event_id) AS rn, "
    f"count(*) OVER (PARTITION BY symbol) AS n FROM ({_NAN_TIME_SQL})",
)
def q_win_row_number_nan_time(spark, sf):
    """W3 by a time that is often NULL (first), NaN (last) or tied: series over 40 rows in ranges of about 10."""
    from .plans.numbering import number_rows

    t = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.hour("s_ts").cast("double"))
    ev = events_series(spark, sf).select("symbol", "event_id", t.alias("t"))
    return number_rows(ev, ["symbol"], ["t", "event_id"], hot_rows=40, bucket_rows=10).select("symbol", "event_id", "rn", "n")


@query(
    "win_row_number_string_ties",
    "SELECT user_id AS symbol, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_type ASC NULLS FIRST, props ASC NULLS FIRST, "
    "event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events",
)
def q_win_row_number_string_ties(spark, sf):
    """W3 by strings with many ties, split by the columns that break them."""
    from .plans.numbering import number_rows

    ev = table(spark, sf, "events").select(F.col("user_id").alias("symbol"), "event_type", "props", "event_id")
    return number_rows(ev, ["symbol"], ["event_type", "props", "event_id"], hot_rows=40, bucket_rows=10).select("symbol", "event_id", "rn", "n")


@query(
    "agg_series_count",
    "SELECT user_id AS symbol, count(*) AS n FROM events GROUP BY user_id",
)
def q_agg_series_count(spark, sf):
    """A1: whole-series row count (partial aggregation, no window needed)."""
    ev = events_series(spark, sf)
    return ev.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


_RN_N = f"""
WITH src AS ({EVENTS_SERIES_SQL}),
num AS (SELECT symbol, event_id, row_number() OVER ({_WO}) AS rn,
               count(*) OVER (PARTITION BY symbol) AS n FROM src)
"""


@query("flt_tail_trim", _RN_N + "SELECT symbol, event_id, rn, n FROM num WHERE rn <= n - 3")
def q_flt_tail_trim(spark, sf):
    """Drop anchors without 3 future rows."""
    spec = events_spec(60, 3)
    df = W.row_numbers(events_series(spark, sf), spec, n_name="n")
    out = W.trim_tail(df, spec)
    return out.select("symbol", "event_id", F.col("rn").cast("bigint").alias("rn"), F.col("n").cast("bigint").alias("n"))


@query("flt_head_trim", _RN_N + "SELECT symbol, event_id, rn, n FROM num WHERE rn >= 60")
def q_flt_head_trim(spark, sf):
    """P5: drop anchors without 59 past rows."""
    spec = events_spec(60, 3)
    df = W.row_numbers(events_series(spark, sf), spec, n_name="n")
    out = W.trim_head(df, spec)
    return out.select("symbol", "event_id", F.col("rn").cast("bigint").alias("rn"), F.col("n").cast("bigint").alias("n"))


def _flagship_sql_no_keys() -> str:
    inner = window_summary_sql(EVENTS_SERIES_SQL, ["symbol"], EV_ORDER, "s_ts", FEATS, "ohlc_close", 60, 3)
    cols = ["x_len", "y_len", "y_sum"] + [f"sum_{f}" for f in FEATS]
    return f"SELECT {', '.join(cols)} FROM ({inner})"


@query("proj_drop_keys", _flagship_sql_no_keys())
def q_proj_drop_keys(spark, sf):
    """Records without series key, time index or row number (keep_keys=False)."""
    spec = events_spec(60, 3, keep_keys=False)
    out = W.sequence_windows(events_series(spark, sf), spec, plan="auto")
    assert out.columns == FEATS + [spec.label_col], out.columns
    y = spec.label_col
    return out.select(
        array_len("ohlc_close").alias("x_len"), array_len(y).alias("y_len"),
        rounded(array_sum(y)).alias("y_sum"),
        *[rounded(array_sum(f)).alias(f"sum_{f}") for f in FEATS],
    )


@query(
    "proj_feature_label",
    "SELECT symbol, ts_us, 7 AS n_features, sum_ohlc_close AS feat_close_sum, sum_cmmc_max AS feat_cmmc_sum, "
    "y_sum AS label_sum FROM ("
    + window_summary_sql(EVENTS_SERIES_SQL, ["symbol"], EV_ORDER, "s_ts", FEATS, "ohlc_close", 60, 3)
    + ")",
)
def q_proj_feature_label(spark, sf):
    """Split a record into a features struct and the label."""
    from .operators.projections import split_features_label

    spec = events_spec(60, 3)
    rec = W.sequence_windows(events_series(spark, sf), spec, plan="auto")
    out = split_features_label(rec, spec, keys=["symbol", "s_ts"])
    return out.select(
        "symbol", micros("s_ts").alias("ts_us"),
        F.lit(len(out.schema["features"].dataType.fields)).cast("int").alias("n_features"),
        rounded(array_sum("features.ohlc_close")).alias("feat_close_sum"),
        rounded(array_sum("features.cmmc_max")).alias("feat_cmmc_sum"),
        rounded(array_sum("label")).alias("label_sum"),
    )


@query(
    "arr_wrap",
    f"""
WITH src AS ({EVENTS_SERIES_SQL})
SELECT symbol, epoch_us(s_ts) AS ts_us,
  count(ohlc_close) OVER wf AS outer_len,
  count(ohlc_close) OVER wf AS inner_total,
  round(first_value(ohlc_close) OVER wf, {D}) AS first_inner
FROM src WINDOW wf AS ({_WO} ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)
""",
)
def q_arr_wrap(spark, sf):
    """label window as the nested per-step layout ``[[a], [b], [c]]``."""
    spec = events_spec(60, 3)
    out = W.label_sequence(events_series(spark, sf), spec)
    wrapped = out.select("symbol", "s_ts", wrap_elements(spec.label_col).alias("w"))
    return wrapped.select(
        "symbol", micros("s_ts").alias("ts_us"), array_len("w").alias("outer_len"),
        F.aggregate("w", F.lit(0).cast("bigint"), lambda acc, v: acc + F.size(v)).alias("inner_total"),
        rounded(F.try_element_at(F.try_element_at("w", F.lit(1)), F.lit(1))).alias("first_inner"),
    )


# ---------------------------------------------------------------------------
# T1 split, P6-P8 selection, F3/F4 dates
# ---------------------------------------------------------------------------

from .functions.dates import format_mdy, is_valid_mdy  # noqa: E402
from .operators import dataset as DS  # noqa: E402
from .operators import forecast as FC  # noqa: E402
from .operators import projections as PJ  # noqa: E402
from .operators import registry as RG  # noqa: E402
from .operators.split import split_chronological  # noqa: E402
from .params import TrainingParams  # noqa: E402
from .session import scratch_path  # noqa: E402
from .sources.csv_series import series_schema  # noqa: E402
from .sources.layout import read_layout  # noqa: E402
from .sources.sinks import to_record_layout, write_plain_tree, write_sequences, write_series_csv  # noqa: E402
from .sources.tables import table  # noqa: E402

_SPLIT_SQL = f"""
WITH src AS ({EVENTS_SERIES_SQL}),
num AS (SELECT *, row_number() OVER ({_WO}) AS rn, count(*) OVER (PARTITION BY symbol) AS n FROM src),
split AS (SELECT *, CASE WHEN rn > n - (n * 20) // 100 THEN 'test'
                         WHEN rn > n - (n * 20) // 100 - (n * 20) // 100 THEN 'eval'
                         ELSE 'train' END AS channel FROM num)
"""
_DIR_CASE = "CASE channel WHEN 'train' THEN 'train' WHEN 'eval' THEN 'evaluation' WHEN 'test' THEN 'validation' ELSE channel END"


def _split_events(spark, sf, **kw):
    ev = events_series(spark, sf)
    return split_chronological(ev, ["symbol"], EV_ORDER, TrainingParams(), **kw)


@query("split_chronological", _SPLIT_SQL + "SELECT symbol, event_id, channel FROM split")
def q_split_chronological(spark, sf):
    """Last 20 % of each series -> test, the 20 % before -> eval, rest train."""
    return _split_events(spark, sf).select("symbol", "event_id", "channel")


@query("split_chronological_bucketed", _SPLIT_SQL + "SELECT symbol, event_id, channel FROM split")
def q_split_chronological_bucketed(spark, sf):
    """T1 with every series over 40 rows numbered in ranges (skew-safe path)."""
    return _split_events(spark, sf, hot_rows=40, bucket_rows=8).select("symbol", "event_id", "channel")


@query("proj_channel_alias", _SPLIT_SQL + f"SELECT symbol, event_id, channel, {_DIR_CASE} AS channel_dir FROM split")
def q_proj_channel_alias(spark, sf):
    """Channel alias -> directory name (train / evaluation / validation)."""
    out = _split_events(spark, sf)
    return out.select("symbol", "event_id", "channel", PJ.channel_dir("channel").alias("channel_dir"))


def _layout_frame(spark, sf):
    """Events split into channels, in the raw-series column layout + tree columns."""
    sp = _split_events(spark, sf)
    return sp.select(
        "s_ts", *FEATS,
        PJ.channel_dir("channel").alias("channel"),
        F.lit("price").alias("data_type"), F.lit("bn").alias("exchange"),
        format_mdy("s_ts").alias("date"), F.col("symbol").cast("string").alias("symbol"),
    )


_TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _write_layout(spark, sf) -> str:
    root = scratch_path(spark, "series-tree")
    write_series_csv(_layout_frame(spark, sf), root, ts_format=_TS_FMT)
    return root


_LAYOUT_SQL = _SPLIT_SQL + f""", lay AS (
  SELECT {_DIR_CASE} AS channel, 'price' AS data_type, 'bn' AS exchange,
         strftime(s_ts, '%m-%d-%y') AS date, symbol, s_ts,
         CAST(CAST(ohlc_close AS FLOAT) AS DOUBLE) AS close32,
         CAST(CAST(ohlc_pcr AS FLOAT) AS DOUBLE) AS pcr32
  FROM split)
"""


@query(
    "src_csv_series",
    _LAYOUT_SQL + f"SELECT CAST(symbol AS VARCHAR) AS symbol, date, epoch_us(s_ts) AS ts_us, "
    f"round(close32, {D}) AS close, round(pcr32, {D}) AS pcr FROM lay",
)
def q_src_csv_series(spark, sf):
    """Raw series written as header CSV, read back with the fixed
    float32 schema and timestamp format (malformed rows would be quarantined)."""
    root = _write_layout(spark, sf)
    df = read_layout(spark, root, layout="hive", schema=series_schema(quarantine=True), ts_format=_TS_FMT)
    return df.select(
        "symbol", "date", micros("s_ts").alias("ts_us"),
        rounded(F.col("ohlc_close")).alias("close"), rounded(F.col("ohlc_pcr")).alias("pcr"),
    )


@query(
    "src_layout_discovery",
    _LAYOUT_SQL + "SELECT channel, data_type, exchange, date, CAST(symbol AS VARCHAR) AS symbol, "
    "count(*) AS n, min(epoch_us(s_ts)) AS first_us FROM lay GROUP BY ALL",
)
def q_src_layout_discovery(spark, sf):
    """One scan of the whole tree; the five tree parts come from paths."""
    root = _write_layout(spark, sf)
    df = read_layout(spark, root, layout="hive", ts_format=_TS_FMT)
    return df.groupBy("channel", "data_type", "exchange", "date", "symbol").agg(
        F.count(F.lit(1)).alias("n"), F.min(micros("s_ts")).alias("first_us")
    )


@query(
    "flt_channel",
    _LAYOUT_SQL + "SELECT CAST(symbol AS VARCHAR) AS symbol, epoch_us(s_ts) AS ts_us FROM lay "
    "WHERE channel = 'evaluation' AND data_type = 'price' AND exchange = 'bn'",
)
def q_flt_channel(spark, sf):
    """Channel 'eval' (alias) of data type 'price' on exchange 'bn' - partition-pruned."""
    root = _write_layout(spark, sf)
    df = read_layout(spark, root, layout="hive", ts_format=_TS_FMT)
    out = PJ.select_source(df, channel="eval", data_type="price", exchange="bn")
    return out.select("symbol", micros("s_ts").alias("ts_us"))


@query(
    "flt_train_dates",
    _LAYOUT_SQL + "SELECT CAST(symbol AS VARCHAR) AS symbol, date, epoch_us(s_ts) AS ts_us FROM lay "
    "WHERE channel = 'train' AND date = '01-15-24'",
)
def q_flt_train_dates(spark, sf):
    """Train on one mm-dd-yy date (a partition filter on the date directory)."""
    root = _write_layout(spark, sf)
    df = read_layout(spark, root, layout="hive", channel="train", ts_format=_TS_FMT)
    out = PJ.training_dates(df, how="01-15-24")
    return out.select("symbol", "date", micros("s_ts").alias("ts_us"))


@query(
    "sink_csv_roundtrip",
    _LAYOUT_SQL + f"SELECT CAST(symbol AS VARCHAR) AS symbol, count(*) AS n, round(sum(close32), 4) AS close_sum, "
    f"round(sum(pcr32), 4) AS pcr_sum FROM lay GROUP BY symbol",
)
def q_sink_csv_roundtrip(spark, sf):
    """Per symbol, count and sums survive a CSV write + read."""
    root = _write_layout(spark, sf)
    df = read_layout(spark, root, layout="hive", ts_format=_TS_FMT)
    return df.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("ohlc_close").cast("double")), 4).alias("close_sum"),
        F.round(F.sum(F.col("ohlc_pcr").cast("double")), 4).alias("pcr_sum"),
    )


# the plain tree holds a file per series and day, so its series are the five event types
_PLAIN_SQL = _SPLIT_SQL.replace("user_id AS symbol", "event_type AS symbol") + f""", lay AS (
  SELECT {_DIR_CASE} AS channel, strftime(s_ts, '%m-%d-%y') AS date, symbol, s_ts,
         {", ".join(f"CAST(CAST({f} AS FLOAT) AS DOUBLE) AS {f}" for f in FEATS)}
  FROM split)
"""


def _write_plain(spark, sf) -> str:
    ev = events_series(spark, sf, symbol="event_type")
    sp = split_chronological(ev, ["symbol"], EV_ORDER, TrainingParams())
    tree = sp.withColumns({
        "channel": PJ.channel_dir("channel"), "data_type": F.lit("price"), "exchange": F.lit("bn"), "date": format_mdy("s_ts")})
    root = scratch_path(spark, "plain-tree")
    write_plain_tree(tree, root, ts_format=_TS_FMT)
    return root


@query(
    "src_plain_tree",
    _PLAIN_SQL + f"SELECT channel, date, symbol, epoch_us(s_ts) AS ts_us, round(ohlc_close, {D}) AS close, "
    f"round(ohlc_pcr, {D}) AS pcr, round(cmmc_max, {D}) AS cmmc FROM lay WHERE channel IN ('train', 'evaluation')",
)
def q_src_plain_tree(spark, sf):
    """S4/F5, plain spelling: ``<channel>/<data_type>/<exchange>/<date>/<symbol>.csv`` files read by one scan of the
    selected channels, the five parts taken from the path of each row's file."""
    root = _write_plain(spark, sf)
    df = read_layout(spark, root, channel=["train", "eval"], data_type="price", exchange="bn", ts_format=_TS_FMT)
    return df.select(
        "channel", "date", "symbol", micros("s_ts").alias("ts_us"), rounded(F.col("ohlc_close")).alias("close"),
        rounded(F.col("ohlc_pcr")).alias("pcr"), rounded(F.col("cmmc_max")).alias("cmmc"))


@query(
    "job_transform_tree",
    window_summary_sql("SELECT * FROM (" + _PLAIN_SQL + "SELECT * FROM lay) WHERE channel = 'train'",
                       ["channel", "date", "symbol"], ["s_ts"], "s_ts", FEATS, "ohlc_close", 20, 3, step=2),
)
def q_job_transform_tree(spark, sf):
    """The whole transform: every series file of the train channel of a plain tree becomes float32 sequence records
    (one series per file), written as Parquet by channel and date, and read back."""
    from .plans.jobs import transform_tree

    spec = events_spec(20, 3, step=2).with_(order=("s_ts",))
    path = scratch_path(spark, "transformed")
    transform_tree(spark, _write_plain(spark, sf), path, spec, series_schema(), channel="train",
                   data_type="price", exchange="bn", ts_format=_TS_FMT)
    back = spark.read.parquet(path)
    flat = back.withColumns({c: F.flatten(c).cast("array<double>") for c in [*FEATS, spec.label_col]})
    return window_summary(flat, spec, keys=[F.col(c) for c in ("channel", "date", "symbol")])


_F32_SQL = EVENTS_SERIES_SQL.replace("value AS ohlc_close", "CAST(CAST(value AS FLOAT) AS DOUBLE) AS ohlc_close")


@query(
    "sink_seq_parquet",
    f"SELECT symbol, strftime(make_timestamp(ts_us), '%m-%d-%y') AS date, ts_us, x_len, y_len, "
    f"round(y_sum, 4) AS y_sum, round(sum_ohlc_close, 4) AS close_sum FROM ("
    + window_summary_sql(_F32_SQL, ["symbol"], EV_ORDER, "s_ts", ["ohlc_close"], "ohlc_close", 60, 3)
    + ")",
)
def q_sink_seq_parquet(spark, sf):
    """float32 nested records written as Parquet partitioned by anchor date
    (dynamic overwrite), read back and summarised."""
    spec = events_spec(60, 3, nested=True)
    win = W.sequence_windows(events_series(spark, sf), spec, plan="auto")
    rec = to_record_layout(win, spec, keep=["symbol", "s_ts"]).withColumn("date", format_mdy("s_ts"))
    path = scratch_path(spark, "sequences")
    write_sequences(rec, path, partition_cols=["date"])
    back = spark.read.parquet(path)
    x = F.flatten("ohlc_close")
    y = F.flatten(spec.label_col)
    return back.select(
        F.col("symbol"), F.col("date"), micros("s_ts").alias("ts_us"),
        array_len(x).alias("x_len"), array_len(y).alias("y_len"),
        F.round(array_sum(y), 4).alias("y_sum"), F.round(array_sum(x), 4).alias("close_sum"),
    )


@query(
    "date_format_mdy",
    "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%m-%d-%y') AS mdy FROM events",
)
def q_date_format_mdy(spark, sf):
    """dates as mm-dd-yy text (the date directory names)."""
    ev = table(spark, sf, "events")
    return ev.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), format_mdy("ts").alias("mdy")).distinct()


_VALID_SQL = (
    "coalesce(regexp_matches(t, '^([0-9]{1,2})-([0-9]{1,2})-([0-9]{2})$') AND "
    "try_strptime('20' || regexp_extract(t, '^([0-9]{1,2})-([0-9]{1,2})-([0-9]{2})$', 3) || '-' || "
    "lpad(regexp_extract(t, '^([0-9]{1,2})-([0-9]{1,2})-([0-9]{2})$', 1), 2, '0') || '-' || "
    "lpad(regexp_extract(t, '^([0-9]{1,2})-([0-9]{1,2})-([0-9]{2})$', 2), 2, '0'), '%Y-%m-%d') IS NOT NULL, false)"
)


@query(
    "date_validate",
    "WITH texts AS (SELECT DISTINCT strftime(ts, '%m-%d-%y') AS t FROM events "
    "UNION SELECT DISTINCT strftime(ts, '%d-%m-%y') FROM events "
    "UNION SELECT DISTINCT strftime(ts, '%m-%d-%Y') FROM events "
    "UNION SELECT DISTINCT event_type FROM events) "
    f"SELECT t AS text, {_VALID_SQL} AS valid FROM texts",
)
def q_date_validate(spark, sf):
    """mm-dd-yy validity of date texts derived from the data (month/day
    swapped and four-digit years are invalid, as are non-dates)."""
    ev = table(spark, sf, "events")
    texts = (
        ev.select(F.date_format("ts", "MM-dd-yy").alias("t"))
        .union(ev.select(F.date_format("ts", "dd-MM-yy")))
        .union(ev.select(F.date_format("ts", "MM-dd-yyyy")))
        .union(ev.select("event_type"))
        .distinct()
    )
    return texts.select(F.col("t").alias("text"), is_valid_mdy("t").alias("valid"))


# ---------------------------------------------------------------------------
# A2-A4 sizing
# ---------------------------------------------------------------------------

_LEN_SQL = _SPLIT_SQL + """, lens AS (
  SELECT channel, strftime(s_ts, '%m-%d-%y') AS date, symbol, count(*) AS ds_len FROM split GROUP BY ALL)
"""


def _lengths(spark, sf):
    sp = _split_events(spark, sf).withColumn("date", format_mdy("s_ts"))
    return DS.dataset_lengths(sp, ("channel", "date", "symbol"))


@query("agg_dataset_length", _LEN_SQL + "SELECT * FROM lens")
def q_agg_dataset_length(spark, sf):
    """A2: rows per (channel, date, symbol), all series in one aggregation."""
    return _lengths(spark, sf)


@query(
    "agg_max_steps",
    _LEN_SQL + "SELECT channel, date, symbol, ds_len, "
    "CAST(floor(10.0 * ((ds_len / 10.0) / 64.0)) AS BIGINT) AS max_steps, "
    "CAST(10 * (ds_len // 64) AS BIGINT) AS epoch_steps FROM lens",
)
def q_agg_max_steps(spark, sf):
    """A3: reference step formula (epochs cancel) next to true epochs x batches."""
    sz = DS.sizing(_lengths(spark, sf), TrainingParams())
    return sz.select("channel", "date", "symbol", "ds_len", "max_steps", "epoch_steps")


@query(
    "agg_shuffle_buffer",
    _LEN_SQL + "SELECT channel, date, symbol, ds_len, CAST(floor(ds_len * 0.1) AS BIGINT) AS shuffle_buffer FROM lens",
)
def q_agg_shuffle_buffer(spark, sf):
    """A4: shuffle buffer = int(10 % of the dataset length)."""
    sz = DS.sizing(_lengths(spark, sf), TrainingParams())
    return sz.select("channel", "date", "symbol", "ds_len", "shuffle_buffer")


# ---------------------------------------------------------------------------
# D1-D4 dataset feeding (records = P=8, F=3 windows of every series)
# ---------------------------------------------------------------------------

_ANCHORS_SQL = f"""
WITH src AS ({EVENTS_SERIES_SQL}),
num AS (SELECT symbol, epoch_us(s_ts) AS ts_us, ohlc_close AS last,
               lead(ohlc_close, 1) OVER ({_WO}) AS y1, lead(ohlc_close, 2) OVER ({_WO}) AS y2,
               lead(ohlc_close, 3) OVER ({_WO}) AS y3,
               row_number() OVER ({_WO}) AS rn, count(*) OVER (PARTITION BY symbol) AS n FROM src),
anchors AS (SELECT * FROM num WHERE rn >= 8 AND rn <= n - 3)
"""
_SHUF_SQL = _ANCHORS_SQL + """, rep AS (
  SELECT symbol, ts_us, CAST(e AS INTEGER) AS epoch, md5(concat_ws('|', '13', CAST(e AS VARCHAR),
         CAST(symbol AS VARCHAR), CAST(ts_us AS VARCHAR))) AS shuffle_key
  FROM anchors, range(1, 3) AS r(e)),
pos AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY shuffle_key, symbol, ts_us) AS pos,
               count(*) OVER (PARTITION BY epoch) AS en FROM rep),
bat AS (SELECT *, (pos - 1) // 64 AS batch_id, (epoch - 1) * (en // 64) + (pos - 1) // 64 AS step
        FROM pos WHERE (pos - 1) // 64 < en // 64)
"""


def _records(spark, sf):
    spec = events_spec(8, 3)
    win = W.sequence_windows(events_series(spark, sf), spec, plan="auto")
    return win.select("symbol", micros("s_ts").alias("ts_us"))


@query("ds_repeat", _SHUF_SQL + "SELECT symbol, ts_us, epoch FROM rep")
def q_ds_repeat(spark, sf):
    """Every record once per epoch (2 epochs)."""
    return DS.repeat_epochs(_records(spark, sf), 2).select("symbol", "ts_us", "epoch")


@query("ds_epoch_shuffle", _SHUF_SQL + "SELECT symbol, ts_us, epoch, shuffle_key FROM rep")
def q_ds_epoch_shuffle(spark, sf):
    """Per-epoch md5 shuffle key with seed 13 (same in any engine)."""
    out = DS.epoch_shuffle(_records(spark, sf), ["symbol", "ts_us"], TrainingParams(), epochs=2)
    return out.select("symbol", "ts_us", "epoch", "shuffle_key")


@query("ds_batch", _SHUF_SQL + "SELECT symbol, ts_us, epoch, pos, batch_id, step FROM bat")
def q_ds_batch(spark, sf):
    """D3: global positions per epoch without a single task; batches of 64,
    the incomplete last batch of each epoch dropped."""
    out = DS.batches(_records(spark, sf), ["symbol", "ts_us"], TrainingParams(), epochs=2)
    return out.select("symbol", "ts_us", "epoch", "pos", "batch_id", "step")


@query("ds_step_cap", _SHUF_SQL + "SELECT symbol, ts_us, epoch, pos, batch_id, step FROM bat WHERE step < 50")
def q_ds_step_cap(spark, sf):
    """Debug cap of 50 global steps."""
    out = DS.batches(_records(spark, sf), ["symbol", "ts_us"], TrainingParams(), epochs=2, debug=True)
    return out.select("symbol", "ts_us", "epoch", "pos", "batch_id", "step")


@query(
    "ds_batch_unshuffled",
    _ANCHORS_SQL + """, pos AS (
  SELECT symbol, ts_us, row_number() OVER (ORDER BY symbol, ts_us) AS pos, count(*) OVER () AS n FROM anchors)
SELECT symbol, ts_us, e::INTEGER AS epoch, pos, (pos - 1) // 64 AS batch_id, (e - 1) * (n // 64) + (pos - 1) // 64 AS step
FROM pos, (SELECT unnest([1, 2]) AS e) WHERE (pos - 1) // 64 < n // 64
""",
)
def q_ds_batch_unshuffled(spark, sf):
    """D3 without the shuffle: records in key order, numbered by ranges once for both epochs."""
    out = DS.batches(_records(spark, sf), ["symbol", "ts_us"], TrainingParams(), epochs=2, shuffle=False, rows_per_bucket=2_000)
    return out.select("symbol", "ts_us", "epoch", "pos", "batch_id", "step")


@query(
    "ds_batch_many_epochs",
    _ANCHORS_SQL + """, rep AS (SELECT symbol, ts_us, unnest(range(1, 31))::INTEGER AS epoch FROM anchors),
pos AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY md5(concat_ws('|', '13', CAST(epoch AS VARCHAR), CAST(symbol AS VARCHAR),
               CAST(ts_us AS VARCHAR))), symbol, ts_us) AS pos, count(*) OVER (PARTITION BY epoch) AS n FROM rep)
SELECT symbol, ts_us, epoch, pos, (pos - 1) // 64 AS batch_id, (epoch - 1) * (n // 64) + (pos - 1) // 64 AS step
FROM pos WHERE (pos - 1) // 64 < n // 64
""",
)
def q_ds_batch_many_epochs(spark, sf):
    """D2 and D3 over 30 epochs."""
    out = DS.batches(_records(spark, sf), ["symbol", "ts_us"], TrainingParams(epochs=30))
    return out.select("symbol", "ts_us", "epoch", "pos", "batch_id", "step")


# ---------------------------------------------------------------------------
# M1-M6, A5 forecasting and registry
# ---------------------------------------------------------------------------

_HZ_SQL = _ANCHORS_SQL + """, hz AS (
  SELECT symbol, ts_us, last, 1 AS horizon, y1 AS y FROM anchors
  UNION ALL SELECT symbol, ts_us, last, 2, y2 FROM anchors
  UNION ALL SELECT symbol, ts_us, last, 3, y3 FROM anchors)
"""


def _windows8(spark, sf):
    spec = events_spec(8, 3)
    win = W.sequence_windows(events_series(spark, sf), spec, plan="auto")
    return spec, win.withColumn("ts_us", micros("s_ts"))


@query(
    "predict_persistence",
    _HZ_SQL + f"SELECT symbol, ts_us, horizon, round(y, {D}) AS y, round(last, {D}) AS pred FROM hz",
)
def q_predict_persistence(spark, sf):
    """M2: persistence forecast for every horizon of every window."""
    spec, win = _windows8(spark, sf)
    p = FC.predict_persistence(win, spec, keys=["ts_us"])
    return p.select("symbol", "ts_us", "horizon", rounded(F.col("y")).alias("y"), rounded(F.col("pred")).alias("pred"))


@query(
    "eval_regression_metrics",
    _HZ_SQL + f"""
SELECT 'horizon' AS scope, horizon, round(avg((y - last) * (y - last)), 4) AS mse,
       round(avg(abs(y - last)), 4) AS mae, round(avg(y), 4) AS label_mean,
       round(avg(last), 4) AS pred_mean, count(*) AS n FROM hz GROUP BY horizon
UNION ALL
SELECT 'all', 0, round(avg((y - last) * (y - last)), 4), round(avg(abs(y - last)), 4),
       round(avg(y), 4), round(avg(last), 4), count(*) FROM hz
""",
)
def q_eval_regression_metrics(spark, sf):
    """A5: MSE, MAE, label mean and prediction mean of the persistence forecast,
    per horizon and overall (sf0.01 overall MSE 4907.6297)."""
    spec, win = _windows8(spark, sf)
    p = FC.predict_persistence(win, spec, keys=["ts_us"])
    m = FC.regression_metrics(p, ["horizon"], rollup=True)
    return m.select(
        F.when(F.col("horizon").isNull(), F.lit("all")).otherwise(F.lit("horizon")).alias("scope"),
        F.coalesce(F.col("horizon"), F.lit(0)).cast("int").alias("horizon"),
        F.round("mse", 4).alias("mse"), F.round("mae", 4).alias("mae"),
        F.round("label_mean", 4).alias("label_mean"), F.round("pred_mean", 4).alias("pred_mean"), "n",
    )


_FIT_SQL = _HZ_SQL + """, fit AS (
  SELECT symbol, horizon, regr_slope(y, last) AS slope, regr_intercept(y, last) AS intercept,
         CAST(regr_count(y, last) AS BIGINT) AS n_obs FROM hz GROUP BY symbol, horizon)
"""


@query(
    "fit_linear_per_series",
    _FIT_SQL + f"SELECT symbol, horizon, round(slope, {D}) AS slope, round(intercept, {D}) AS intercept, n_obs FROM fit",
)
def q_fit_linear_per_series(spark, sf):
    """M1 v1: y_h = a + b * last per (series, horizon) for every series at once."""
    spec, win = _windows8(spark, sf)
    m = FC.fit_linear(win, spec)
    return m.select("symbol", "horizon", rounded(F.col("slope")).alias("slope"),
                    rounded(F.col("intercept")).alias("intercept"), F.col("n_obs").cast("bigint").alias("n_obs"))


_SPLIT_ANCHORS_SQL = _SPLIT_SQL + f""",
cw AS (SELECT symbol, channel, epoch_us(s_ts) AS ts_us, ohlc_close AS last,
         lead(ohlc_close, 1) OVER wc AS y1, lead(ohlc_close, 2) OVER wc AS y2, lead(ohlc_close, 3) OVER wc AS y3,
         row_number() OVER wc AS crn, count(*) OVER (PARTITION BY symbol, channel) AS cn
       FROM split WINDOW wc AS (PARTITION BY symbol, channel ORDER BY s_ts ASC NULLS FIRST, event_id ASC NULLS FIRST)),
ca AS (SELECT * FROM cw WHERE crn >= 8 AND crn <= cn - 3),
chz AS (SELECT symbol, channel, ts_us, last, 1 AS horizon, y1 AS y FROM ca
        UNION ALL SELECT symbol, channel, ts_us, last, 2, y2 FROM ca
        UNION ALL SELECT symbol, channel, ts_us, last, 3, y3 FROM ca),
trfit AS (SELECT symbol, horizon, regr_slope(y, last) AS slope, regr_intercept(y, last) AS intercept
          FROM chz WHERE channel = 'train' GROUP BY symbol, horizon),
scored AS (SELECT h.symbol, h.ts_us, h.horizon, h.y,
                  CASE WHEN f.slope IS NOT NULL AND f.intercept IS NOT NULL
                       THEN f.intercept + f.slope * h.last ELSE h.last END AS pred
           FROM chz h LEFT JOIN trfit f ON h.symbol = f.symbol AND h.horizon = f.horizon
           WHERE h.channel = 'test')
"""


def _split_windows(spark, sf):
    """Windows built per (series, channel) after the chronological split."""
    spec = events_spec(8, 3).with_(series=("symbol", "channel"))
    sp = _split_events(spark, sf)
    win = W.sequence_windows(sp, spec, plan="auto").withColumn("ts_us", micros("s_ts"))
    return spec, win


@query(
    "predict_batch",
    _SPLIT_ANCHORS_SQL + f"SELECT symbol, ts_us, horizon, round(y, {D}) AS y, round(pred, {D}) AS pred FROM scored",
)
def q_predict_batch(spark, sf):
    """M3/M4: fit per series on the train channel, score the test channel."""
    spec, win = _split_windows(spark, sf)
    fspec = spec.with_(series=("symbol",))
    train = win.filter(F.col("channel") == "train")
    test = win.filter(F.col("channel") == "test")
    model = FC.fit_linear(train, fspec)
    p = FC.predict_linear(test, model, fspec, keys=["ts_us"])
    return p.select("symbol", "ts_us", "horizon", rounded(F.col("y")).alias("y"), rounded(F.col("pred")).alias("pred"))


@query(
    "eval_split_metrics",
    _SPLIT_ANCHORS_SQL.replace("WHERE h.channel = 'test'", "WHERE h.channel IN ('eval', 'test')").replace(
        "SELECT h.symbol, h.ts_us,", "SELECT h.channel, h.symbol, h.ts_us,")
    + """
SELECT channel, round(avg((y - pred) * (y - pred)), 4) AS mse, round(avg(abs(y - pred)), 4) AS mae,
       round(avg(y), 4) AS label_mean, round(avg(pred), 4) AS pred_mean, count(*) AS n
FROM scored GROUP BY channel
""",
)
def q_eval_split_metrics(spark, sf):
    """M3 + A5: the train-fitted linear model evaluated once per row on the
    eval channel and on the test channel."""
    spec, win = _split_windows(spark, sf)
    fspec = spec.with_(series=("symbol",))
    model = FC.fit_linear(win.filter(F.col("channel") == "train"), fspec)
    held_out = win.filter(F.col("channel").isin("eval", "test"))
    p = FC.predict_linear(held_out, model, fspec, keys=["ts_us", "channel"])
    m = FC.regression_metrics(p, ["channel"])
    return m.select("channel", *[F.round(c, 4).alias(c) for c in ("mse", "mae", "label_mean", "pred_mean")], "n")


@query(
    "model_export",
    _FIT_SQL + f"""SELECT symbol, horizon, round(slope, {D}) AS slope, round(intercept, {D}) AS intercept,
    (SELECT epoch_us(max(ts)) // 1000000 FROM events) AS version FROM fit""",
)
def q_model_export(spark, sf):
    """M5: fitted models appended to a versioned model table and read back.
    The version is the data's last event time in epoch seconds."""
    spec, win = _windows8(spark, sf)
    model = FC.fit_linear(win, spec)
    last_us = table(spark, sf, "events").agg(F.max(micros("ts"))).first()[0]  # one scalar
    version = last_us // 1_000_000
    path = scratch_path(spark, "models")
    back = RG.export_models(model, path, int(version))
    return back.select("symbol", "horizon", rounded(F.col("slope")).alias("slope"),
                       rounded(F.col("intercept")).alias("intercept"), F.col("version").cast("bigint").alias("version"))


_ARTIFACTS_SQL = """
WITH listing AS (SELECT o_custkey AS symbol, o_orderkey AS version,
                        CASE WHEN o_orderstatus = 'F' THEN 'saved_model.pb' ELSE NULL END AS file_name
                 FROM orders)
"""


def _listing(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_custkey").alias("symbol"), F.col("o_orderkey").alias("version"),
        F.when(F.col("o_orderstatus") == "F", F.lit("saved_model.pb")).alias("file_name"),
    )


@query(
    "flt_complete_artifacts",
    _ARTIFACTS_SQL + "SELECT symbol FROM listing GROUP BY symbol HAVING bool_or(coalesce(file_name = 'saved_model.pb', false))",
)
def q_flt_complete_artifacts(spark, sf):
    """Symbols with at least one complete saved model (orders stand-in)."""
    return RG.complete_symbols(_listing(spark, sf))


@query(
    "model_latest_version",
    _ARTIFACTS_SQL + "SELECT symbol, max(version) AS version, count(*) AS complete_versions "
    "FROM listing WHERE file_name = 'saved_model.pb' GROUP BY symbol",
)
def q_model_latest_version(spark, sf):
    """M6: the highest complete version of each symbol (versions as numbers)."""
    lat = RG.latest_complete_versions(_listing(spark, sf))
    counts = _listing(spark, sf).filter(F.col("file_name") == "saved_model.pb").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("complete_versions"))
    return lat.join(counts, "symbol").select(
        "symbol", F.col("artifact.version").cast("bigint").alias("version"), "complete_versions")


_DAY_SQL = """
WITH src AS (SELECT strftime(ts, '%m-%d-%y') AS date, event_type AS symbol, ts, event_id, value AS v FROM events),
num AS (SELECT date, symbol, v AS last, lead(v, 1) OVER w AS y1, lead(v, 2) OVER w AS y2, row_number() OVER w AS rn,
               count(*) OVER (PARTITION BY date, symbol) AS n
        FROM src WINDOW w AS (PARTITION BY date, symbol ORDER BY ts ASC NULLS FIRST, event_id)),
anchors AS (SELECT * FROM num WHERE rn >= 4 AND rn <= n - 2 AND last IS NOT NULL AND y1 IS NOT NULL AND y2 IS NOT NULL),
hz AS (SELECT date, symbol, last, 1 AS horizon, y1 AS y FROM anchors UNION ALL SELECT date, symbol, last, 2, y2 FROM anchors),
fit AS (SELECT date, symbol, horizon, regr_slope(y, last) AS b, regr_intercept(y, last) AS a FROM hz GROUP BY ALL)
SELECT date, symbol, 2::BIGINT AS version, count(*) AS n, round(avg(power(y - CASE WHEN isfinite(a + b * last) THEN a + b * last ELSE last END, 2)), 3) AS mse
FROM hz JOIN fit USING (date, symbol, horizon) GROUP BY ALL
"""


@query("serve_latest_score", _DAY_SQL)
def q_serve_latest_score(spark, sf):
    """M5 to M6 to M4: models per (date, symbol) exported in two versions; windows are scored with the newest
    committed version of their key (symbol: the event type)."""
    from .params import SequenceSpec

    ev = table(spark, sf, "events").select(format_mdy("ts").alias("date"), F.col("event_type").alias("symbol"), "ts", "event_id", F.col("value").alias("v"))
    spec = SequenceSpec(series=("date", "symbol"), order=("ts", "event_id"), features=("v",), label="v", past=4, future=2)
    win = W.sequence_windows(ev, spec)
    model = FC.fit_linear(win, spec)
    root = scratch_path(spark, "served-models")
    RG.export_models(model.withColumn("intercept", F.lit(-1.0)), root, version=1)
    RG.export_models(model, root, version=2)
    scored = RG.score_latest(win, root, spec)
    err = F.col("y") - F.col("pred")
    return scored.groupBy("date", "symbol").agg(F.max("version").alias("version"), F.count(F.lit(1)).alias("n"), F.round(F.avg(err * err), 3).alias("mse"))


_NORMAL_SQL = _ANCHORS_SQL + """, hz AS (
  SELECT symbol, 1 AS horizon, y1 AS y FROM anchors UNION ALL SELECT symbol, 2, y2 FROM anchors UNION ALL SELECT symbol, 3, y3 FROM anchors)
SELECT symbol, horizon, count(*) AS n_obs, round(avg(y), 4) AS y_mean, 0.0::DOUBLE AS bias, 0.0::DOUBLE AS gradient
FROM hz GROUP BY symbol, horizon
"""


def _normal(win, model, spec, lags=None):
    out = FC.normal_residuals(win, model, spec, 1e-3, lags)
    return out.select("symbol", "horizon", "n_obs", F.round("y_mean", 4).alias("y_mean"), F.round(F.abs(F.col("pred_mean") - F.col("y_mean")), 6).alias("bias"),
                      F.round("gradient", 6).alias("gradient"))


@query("fit_window_ridge", _NORMAL_SQL)
def q_fit_window_ridge(spark, sf):
    """M1 v2: ridge regression on all values of the flattened window (8 steps of 7 features) per (series, horizon),
    from lagged cross products of the rows. Checked by the normal equations on the windows: the mean prediction
    is the mean label and no slope of the objective is left (tests also compare with numpy)."""
    spec, win = _windows8(spark, sf)
    model = FC.fit_window_ridge_rows(events_series(spark, sf), events_spec(8, 3))
    return _normal(win, model, spec)


@query("fit_lagged_ridge", _NORMAL_SQL)
def q_fit_lagged_ridge(spark, sf):
    """M1 v2, the lagged option: ridge regression on the last 4 values of the label, checked in the same way."""
    spec, win = _windows8(spark, sf)
    return _normal(win, FC.fit_lagged_ridge(win, spec, lags=4, ridge=1e-3), spec, lags=4)


@query(
    "sink_tfrecord_roundtrip",
    "SELECT symbol, ts_us, x_len, y_len, round(y_sum, 4) AS y_sum, round(sum_ohlc_close, 4) AS close_sum, "
    "round(sum_cmmc_max, 4) AS cmmc_sum FROM ("
    + window_summary_sql(_F32_SQL, ["symbol"], EV_ORDER, "s_ts", FEATS, "ohlc_close", 60, 3)
    + ")",
)
def q_sink_tfrecord_roundtrip(spark, sf):
    """float32 sequence examples written as TFRecord part files by
    every task, committed through a manifest, read back one partition per file."""
    from .sources.tfrecord import read_tfrecords, write_tfrecords

    spec = events_spec(60, 3, nested=True)
    win = W.sequence_windows(events_series(spark, sf), spec, plan="auto")
    rec = to_record_layout(win.withColumn("ts_us", micros("s_ts")), spec, keep=["symbol", "ts_us"])
    path = scratch_path(spark, "tfrecords")
    write_tfrecords(rec, path)
    back = read_tfrecords(spark, path, rec.schema)
    x, y, c = F.flatten("ohlc_close"), F.flatten(spec.label_col), F.flatten("cmmc_max")
    return back.select(
        "symbol", "ts_us", array_len(x).alias("x_len"), array_len(y).alias("y_len"),
        F.round(array_sum(y), 4).alias("y_sum"), F.round(array_sum(x), 4).alias("close_sum"),
        F.round(array_sum(c), 4).alias("cmmc_sum"),
    )


@query(
    "obs_run_metrics",
    f"""
WITH src AS ({_NULLY_SQL}),
num AS (SELECT symbol, row_number() OVER ({_WO}) AS rn, count(*) OVER (PARTITION BY symbol) AS n,
               count(ohlc_close) OVER ({_WO} ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS x,
               count(ohlc_close) OVER ({_WO} ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS y FROM src),
a AS (SELECT *, rn >= 8 AND rn <= n - 3 AS inside FROM num)
SELECT count(*) AS rows_in, 0::BIGINT AS null_time, count(*) FILTER (rn = 1) AS series,
       count(*) FILTER (rn = 1 AND n < 11) AS short_series, count(*) FILTER (inside) AS anchors_in_range,
       count(*) FILTER (inside AND (x < 8 OR y < 3)) AS anchors_with_null,
       count(*) FILTER (inside AND x = 8 AND y = 3) AS windows_out
FROM a
""",
)
def q_obs_run_metrics(spark, sf):
    """Run metrics of a routed plan, observed while it writes: series over 70 rows take ranges, the rest windows."""
    spec = events_spec(8, 3)
    out, m_in, m_out = W.sequence_windows_observed(_nully_events(spark, sf), spec, plan="auto", hot_rows=70, block_rows=16, bucket_rows=40)
    out.write.format("noop").mode("overwrite").save()
    got = {**m_in.get, **m_out.get}
    names = ["rows_in", "null_time", "series", "short_series", "anchors_in_range", "anchors_with_null", "windows_out"]
    return spark.createDataFrame([tuple(int(got[c]) for c in names)], ", ".join(f"{c} long" for c in names))


@query(
    "eval_batch_loss",
    _ANCHORS_SQL + """, rec AS (
  SELECT symbol, ts_us, (y1 - last) * (y1 - last) + (y2 - last) * (y2 - last) + (y3 - last) * (y3 - last) AS sse
  FROM anchors),
pos AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '13', '1', CAST(symbol AS VARCHAR),
               CAST(ts_us AS VARCHAR))), symbol, ts_us) AS pos, count(*) OVER () AS en FROM rec),
bat AS (SELECT (pos - 1) // 64 AS batch_id, sse FROM pos WHERE (pos - 1) // 64 < en // 64)
SELECT round(avg(bl), 4) AS loss, count(*) AS batches
FROM (SELECT batch_id, sum(sse) / (3.0 * count(*)) AS bl FROM bat GROUP BY batch_id)
""",
)
def q_eval_batch_loss(spark, sf):
    """A5: mean loss per batch (the estimator's ``loss``): persistence forecast,
    records in md5-shuffled batches of 64 (one epoch, last batch dropped)."""
    spec, win = _windows8(spark, sf)
    records = FC.record_losses(win, spec, ["symbol", "ts_us"])  # no arrays move
    out = FC.record_batch_losses(DS.batches(records, ["symbol", "ts_us"], TrainingParams(epochs=1)))
    return out.select(F.round("loss", 4).alias("loss"), "batches")


_RIDGE_SQL = f"""
WITH src AS ({EVENTS_SERIES_SQL}),
num AS (SELECT symbol, lag(ohlc_close, 3) OVER ({_WO}) AS x1, lag(ohlc_close, 2) OVER ({_WO}) AS x2, lag(ohlc_close, 1) OVER ({_WO}) AS x3, ohlc_close AS x4,
               lead(ohlc_close, 1) OVER ({_WO}) AS y1, lead(ohlc_close, 2) OVER ({_WO}) AS y2,
               lead(ohlc_close, 3) OVER ({_WO}) AS y3,
               row_number() OVER ({_WO}) AS rn, count(*) OVER (PARTITION BY symbol) AS n FROM src),
anchors AS (SELECT * FROM num WHERE rn >= 8 AND rn <= n - 3),
hz AS (SELECT symbol, x1, x2, x3, x4, 1 AS horizon, y1 AS y FROM anchors
       UNION ALL SELECT symbol, x1, x2, x3, x4, 2, y2 FROM anchors
       UNION ALL SELECT symbol, x1, x2, x3, x4, 3, y3 FROM anchors)
SELECT symbol, horizon, round(sum(1.0 * 1.0), 4) AS xx_0_0, round(sum(1.0 * x1), 4) AS xx_0_1, round(sum(1.0 * x2), 4) AS xx_0_2, round(sum(1.0 * x3), 4) AS xx_0_3, round(sum(1.0 * x4), 4) AS xx_0_4, round(sum(1.0 * y), 4) AS xy_0, round(sum(x1 * x1), 4) AS xx_1_1, round(sum(x1 * x2), 4) AS xx_1_2, round(sum(x1 * x3), 4) AS xx_1_3, round(sum(x1 * x4), 4) AS xx_1_4, round(sum(x1 * y), 4) AS xy_1, round(sum(x2 * x2), 4) AS xx_2_2, round(sum(x2 * x3), 4) AS xx_2_3, round(sum(x2 * x4), 4) AS xx_2_4, round(sum(x2 * y), 4) AS xy_2, round(sum(x3 * x3), 4) AS xx_3_3, round(sum(x3 * x4), 4) AS xx_3_4, round(sum(x3 * y), 4) AS xy_3, round(sum(x4 * x4), 4) AS xx_4_4, round(sum(x4 * y), 4) AS xy_4, count(*) AS n_obs FROM hz GROUP BY symbol, horizon
"""


@query("fit_lagged_ridge_stats", _RIDGE_SQL)
def q_fit_lagged_ridge_stats(spark, sf):
    """The lagged option of M1 v2, the Spark half: normal-equation sums X'X, X'y per (series,
    horizon) for X = [1, last 4 values], all plain sums with partial aggregation."""
    spec, win = _windows8(spark, sf)
    st = FC.normal_equations(win, spec, lags=4)
    return st.select(*[F.round(c, 4).alias(c) if c.startswith(("xx_", "xy_")) else F.col(c) for c in st.columns])


_SKEW_ORDER = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
               "l_extendedprice", "l_discount", "l_tax", "l_linestatus"]


@query(
    "sequence_windows_skewed_lineitem",
    window_summary_sql(
        "SELECT * FROM lineitem", ["l_returnflag"], _SKEW_ORDER, "l_shipdate",
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "l_extendedprice", 60, 3,
    ),
)
def q_sequence_windows_skewed_lineitem(spark, sf):
    """W4 under skew: ``lineitem`` keyed by return flag - one key holds about
    half of all rows, dates have day resolution. Keys above 10 000 rows take
    the hot path (size-checked hot list, ranges of about 4 000 rows of the full
    order, blocks of arrays)."""
    spec = lineitem_spec(60, 3).with_(series=("l_returnflag",), order=tuple(_SKEW_ORDER))
    out = W.sequence_windows(lineitem_series(spark, sf), spec, plan="auto",
                             hot_rows=10_000, bucket_rows=4_000, block_rows=8_000)
    return window_summary(out, spec)


@query(
    "win_null_fail_clean",
    window_summary_sql(EVENTS_SERIES_SQL, ["symbol"], EV_ORDER, "s_ts", FEATS, "ohlc_close", 8, 3),
)
def q_win_null_fail_clean(spark, sf):
    """on_null="fail" on data without NULLs: no error, same rows as "drop"."""
    spec = events_spec(8, 3, on_null="fail")
    return window_summary(W.sequence_windows(events_series(spark, sf), spec, plan="auto"), spec)


_ORDERS_SQL = "SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders"


@query(
    "sequence_windows_short_orders",
    window_summary_sql(_ORDERS_SQL, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate",
                       ["o_totalprice"], "o_totalprice", 3, 2),
)
def q_sequence_windows_short_orders(spark, sf):
    """Trimming edges on short series: orders per customer (1-25 rows each),
    P=3, F=2 - customers with fewer than 5 orders give no window."""
    from .params import SequenceSpec

    spec = SequenceSpec(series=("o_custkey",), order=("o_orderdate", "o_orderkey"), features=("o_totalprice",),
                        label="o_totalprice", past=3, future=2)
    return window_summary(W.sequence_windows(table(spark, sf, "orders"), spec, plan="auto"), spec)
