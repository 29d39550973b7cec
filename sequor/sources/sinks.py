"""Sinks (S5, S6) and the at-rest record layout.

* :func:`write_series_csv` - raw series as header CSV in the Hive spelling of
  the series tree (one directory per channel / data_type / exchange / date /
  symbol), readable back with :func:`sequor.sources.layout.read_layout`.
* :func:`write_plain_tree` - the same rows as ``<channel>/<data_type>/<exchange>/<date>/<symbol>.csv``, one
  file per series and day, for readers that walk the tree by name.
* :func:`write_sequences` - sequence records as Parquet, partitioned by the
  given columns, with dynamic partition overwrite (re-running one date
  replaces only that date).
* :func:`to_record_layout` - float32 nested arrays ``[[x], ...]`` per feature
  and label, the per-step layout a sequence-example consumer expects.

Partitioned writes go through Spark's ``REBALANCE`` hint on the partition
columns: rows arriving hash-partitioned by series would otherwise make every
task write a file into every date directory (tasks x dates small files). The
rebalance shuffle groups rows by directory while AQE splits directories that
are too large (a hot date never becomes one task) and coalesces small ones;
``maxRecordsPerFile`` bounds file size. ``rebalance=False`` skips that shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import wrap_elements
from ..params import DEFAULT_FEATURES, DEFAULT_INDEX_COL, SequenceSpec
from .csv_series import DEFAULT_TS_FORMAT
from .layout import LAYOUT_COLS, TREE_COLS


def write_series_csv(
    df: DataFrame,
    root: str,
    ts_format: str = DEFAULT_TS_FORMAT,
    index_col: str = DEFAULT_INDEX_COL,
    features: Sequence[str] = DEFAULT_FEATURES,
    partition_cols: Sequence[str] = TREE_COLS,
    mode: str = "overwrite",
    max_records_per_file: int = 5_000_000,
    rebalance: bool = True,
) -> None:
    """Header CSV, index column first, partitioned into the series tree.

    The tree stops at the date level; ``symbol`` is the last column of every
    file. (A directory per symbol and date would mean one tiny file per series
    and day - the single-machine layout - and millions of files at scale.)
    """
    cols = [index_col, *features, "symbol", *partition_cols]
    out = df.select(*cols)
    if rebalance and partition_cols:
        out = out.hint("rebalance", *partition_cols)
    (
        out.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", ts_format)
        .option("timestampNTZFormat", ts_format)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_cols)
        .csv(root)
    )


def _moved_name(relative: str) -> str:
    """``channel=c/data_type=t/exchange=e/date=d/symbol=s/part-x.csv`` -> ``c/t/e/d/s.csv``."""
    values = [unquote(part.split("=", 1)[1]) for part in relative.split("/")[:-1]]
    if any("/" in v or ":" in v or v in (".", "..", "__HIVE_DEFAULT_PARTITION__") for v in values):
        raise ValueError(f"not a name in a plain tree: {values}")
    return "/".join(values) + ".csv"


def write_plain_tree(
    df: DataFrame,
    root: str,
    ts_format: str = DEFAULT_TS_FORMAT,
    index_col: str = DEFAULT_INDEX_COL,
    features: Sequence[str] = DEFAULT_FEATURES,
) -> int:
    """S5, plain spelling: one header CSV per (channel, data_type, exchange, date, symbol); returns the files written.

    Spark's partitioned writer makes one file per series and day, its rows in time order, in a staging folder
    beside ``root``; once that job has committed, the driver gives each file its name in the tree (a rename of
    names alone: no row passes it) and takes the place of an earlier file of that name. The number of renames is
    the number of files, so for millions of series-days :func:`write_series_csv` is the one to use. A file is
    written by one task, which streams it. NULL or empty tree parts, and parts with a slash or colon, raise ``ValueError``
    before any file is moved; a job that breaks off earlier leaves ``root`` as it was.
    """
    spark = df.sparkSession
    staging = f"{root.rstrip('/')}.staging"
    out = df.select(index_col, *features, *LAYOUT_COLS).repartition(*LAYOUT_COLS)
    (
        out.sortWithinPartitions(*LAYOUT_COLS, index_col).write.mode("overwrite")
        .option("header", True)
        .option("timestampFormat", ts_format)
        .option("timestampNTZFormat", ts_format)
        .partitionBy(*LAYOUT_COLS)
        .csv(staging)
    )
    path = spark._jvm.org.apache.hadoop.fs.Path
    base = path(staging)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    below = fs.makeQualified(base).toString() + "/"
    moves, files = [], fs.listFiles(base, True)
    while files.hasNext():
        file = files.next().getPath()
        if file.getName().startswith("part-"):
            moves.append((file, _moved_name(file.toString()[len(below):])))
    made = set()
    for file, name in moves:
        to = path(f"{root.rstrip('/')}/{name}")
        if to.getParent().toString() not in made:
            fs.mkdirs(to.getParent())
            made.add(to.getParent().toString())
        if fs.exists(to):
            fs.delete(to, False)
        if not fs.rename(file, to):
            raise OSError(f"could not move {file} to {to}")
    fs.delete(base, True)
    return len(moves)


RECORD_TYPE = T.ArrayType(T.ArrayType(T.FloatType()))


def to_record_layout(df: DataFrame, spec: SequenceSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Features and label as ``array<array<float>>`` (F1 + F6), plus ``keep`` columns.

    Columns already in that layout (windows built with ``nested=True``) pass
    through untouched.
    """
    ftype = T.FloatType()
    types = {f.name: f.dataType for f in df.schema.fields}

    def rec(name: str):
        dt = types[name]
        if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.ArrayType):
            return F.col(name).cast(RECORD_TYPE).alias(name)
        return wrap_elements(name, ftype).alias(name)

    cols = [F.col(c) for c in keep]
    cols += [rec(f) for f in spec.features]
    cols.append(rec(spec.label_col))
    return df.select(*cols)


def write_sequences(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = (),
    mode: str = "overwrite",
    fmt: str = "parquet",
    max_records_per_file: int = 1_000_000,
    rebalance: bool = True,
) -> None:
    """Partition-parallel dataset write with dynamic partition overwrite."""
    if rebalance and partition_cols:
        df = df.hint("rebalance", *partition_cols)
    writer = (
        df.write.mode(mode)
        .format(fmt)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
    )
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.save(path)
