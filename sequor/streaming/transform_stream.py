"""Transform series files as they arrive (Structured Streaming).

The single-machine flow transforms each series file right after it is saved.
Here a file-source stream watches the plain series tree
``<root>/<channel>/<data_type>/<exchange>/<mm-dd-yy>/<symbol>.csv``; every
micro-batch holds whole files, and a file is one whole series (one symbol on
one date), so windows never span micro-batches. Each batch runs the same
window kernel and writes its records under ``batch_id=<n>`` with overwrite,
so a batch replayed after a failure replaces its own output (idempotent);
the stream's offsets and commits live in the shared checkpoint folder, so a
restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.windows import sequence_windows
from ..params import SequenceSpec
from ..session import ensure_checkpoint_dir
from ..sources.csv_series import DEFAULT_TS_FORMAT
from ..sources.layout import LAYOUT_COLS, file_path, parts_from_path
from ..sources.sinks import to_record_layout, write_sequences


def series_file_stream(spark: SparkSession, root: str, schema: T.StructType, ts_format: str = DEFAULT_TS_FORMAT,
                       max_files_per_trigger: int | None = None, ext: str = "csv") -> DataFrame:
    """Streaming read of every series file in the plain tree, with the five layout columns."""
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("timestampFormat", ts_format)
        .option("timestampNTZFormat", ts_format)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.csv(f"{root.rstrip('/')}/*/*/*/*/*.{ext}")
    return df.withColumns(parts_from_path(file_path()))


def start_transform_stream(
    spark: SparkSession,
    source_root: str,
    sink_root: str,
    spec: SequenceSpec,
    schema: T.StructType,
    ts_format: str = DEFAULT_TS_FORMAT,
    checkpoint: str | None = None,
    name: str = "series_transform",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what exists and stops."""
    spec = spec.with_(series=LAYOUT_COLS, nested=True)
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/sequor-streams/{name}"
    sink_root = sink_root.rstrip("/")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        windows = sequence_windows(batch, spec)  # counts the files' rows first: a long file takes ranges
        records = to_record_layout(windows, spec, keep=[*LAYOUT_COLS, spec.time_col, "rn"])
        write_sequences(records, f"{sink_root}/batch_id={batch_id}", mode="overwrite")

    stream = series_file_stream(spark, source_root, schema, ts_format, max_files_per_trigger)
    writer = stream.writeStream.queryName(name).option("checkpointLocation", ckpt).foreachBatch(per_batch)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
