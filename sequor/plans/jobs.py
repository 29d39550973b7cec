"""End-to-end jobs built from the operators (one DAG each, no per-file loops).

* :func:`transform_tree` - every series file of a tree becomes sequence
  records: S4 scan -> P6/P7 selection -> W4 windows per (channel, date,
  symbol) -> float32 record layout -> S6 Parquet or S7 TFRecord sink.
* :func:`fit_evaluate_export` - per-series forecasters fitted on the train
  channel, evaluated once per row on eval and test (M1, M3, A5), appended to
  the model table as a new version (M5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import forecast as FC
from ..operators import registry as RG
from ..operators.projections import training_dates
from ..operators.windows import sequence_windows_observed
from ..params import SequenceSpec
from ..sources.csv_series import DEFAULT_TS_FORMAT
from ..sources.layout import LAYOUT_COLS, read_layout
from ..sources.sinks import to_record_layout, write_sequences


def transform_tree(
    spark: SparkSession,
    source_root: str,
    sink_path: str,
    spec: SequenceSpec,
    schema: T.StructType,
    layout: str = "plain",
    channel=None,
    data_type=None,
    exchange=None,
    dates: str = "all",
    ts_format: str = DEFAULT_TS_FORMAT,
    fmt: str = "parquet",
    plan: str = "auto",
) -> dict:
    """Transform every selected series file into sequence records; returns run metrics.

    A file (one symbol on one date in one channel) is one series, so the
    series keys are the five tree parts. Parquet output is partitioned by
    channel and date; TFRecord output is one part file per task.
    """
    src = read_layout(spark, source_root, layout=layout, channel=channel, data_type=data_type,
                      exchange=exchange, schema=schema, ts_format=ts_format)
    src = training_dates(src, how=dates)
    spec = spec.with_(series=LAYOUT_COLS, nested=True)
    windows, m_in, m_out = sequence_windows_observed(src, spec, plan=plan, name="transform")
    records = to_record_layout(windows, spec, keep=[*LAYOUT_COLS, spec.time_col, "rn"])
    if fmt == "parquet":
        write_sequences(records, sink_path, partition_cols=["channel", "date"])
    elif fmt == "tfrecord":
        from ..sources.tfrecord import write_tfrecords

        write_tfrecords(records, sink_path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return {**m_in.get, **m_out.get}


def fit_evaluate_export(
    windows: DataFrame,
    spec: SequenceSpec,
    model_path: str,
    version: int,
    channel_col: str = "channel",
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Fit on ``train``, evaluate on ``eval`` and ``test``, append version ``version``.

    ``windows`` carries a channel column (e.g. from
    :func:`sequor.operators.split.split_chronological` before windowing).
    Returns the metrics per channel (lazy; the export is written eagerly).
    """
    fspec = spec.with_(series=tuple(s for s in spec.series if s != channel_col))
    model = FC.fit_linear(windows.filter(F.col(channel_col) == "train"), fspec)
    exported = RG.export_models(model, model_path, version)
    model = exported.filter(F.col("version") == version).drop("version", "created")  # fitted once: the rows as exported
    held_out = windows.filter(F.col(channel_col).isin("eval", "test"))
    preds = FC.predict_linear(held_out, model, fspec, keys=[*keys, channel_col])
    return FC.regression_metrics(preds, [channel_col])
