"""Series layout discovery.

Raw series live in a tree ``<root>/<channel>/<data_type>/<exchange>/<mm-dd-yy>/<symbol>.csv``.
Instead of globbing dates and symbols on the driver and looping over files,
one scan reads every matching file and derives the five path parts from the
hidden ``_metadata.file_path`` column, so all symbols and dates are processed
by one distributed job.

Two spellings of the tree are read:

* ``plain``: the tree above (directory names are the values). Selection on
  channel / data_type / exchange / dates is turned into the glob, so files
  outside the selection are never listed;
* ``hive``: ``channel=<c>/data_type=<t>/exchange=<e>/date=<d>/part-*.csv``
  with ``symbol`` as the last column of each file, as written by
  :func:`sequor.sources.sinks.write_series_csv`; the four tree parts are
  partition columns (declared as strings in the schema), so predicates on
  them become ``PartitionFilters``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..params import CHANNEL_DIRS
from .csv_series import DEFAULT_TS_FORMAT, read_series_csv, series_schema

LAYOUT_COLS = ("channel", "data_type", "exchange", "date", "symbol")
TREE_COLS = ("channel", "data_type", "exchange", "date")


def _path_part(path: Column, index_from_end: int) -> Column:
    """``index_from_end``-th path segment counted from the end (1 = file name)."""
    return F.element_at(F.split(path, "/"), -index_from_end)


def symbol_from_file(path: Column) -> Column:
    """``.../<symbol>.csv`` -> symbol (file name without its extension)."""
    return F.regexp_extract(_path_part(path, 1), r"^(.*?)(\.[^.]*)?$", 1)


def parts_from_path(path: Column) -> dict[str, Column]:
    """The five layout parts of a plain-layout file path."""
    return {
        "channel": _path_part(path, 5),
        "data_type": _path_part(path, 4),
        "exchange": _path_part(path, 3),
        "date": _path_part(path, 2),
        "symbol": symbol_from_file(path),
    }


def file_path() -> Column:
    """The path of a row's file as it is spelled on disk: the hidden column holds a URI, whose percent-encoding is
    undone here (a plus stands for itself in it)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _glob_part(value: str | Sequence[str] | None) -> str:
    if value is None:
        return "*"
    if isinstance(value, str):
        return value
    values = list(value)
    return values[0] if len(values) == 1 else "{" + ",".join(values) + "}"


def read_layout(
    spark: SparkSession,
    root: str,
    layout: str = "plain",
    channel: str | Sequence[str] | None = None,
    data_type: str | Sequence[str] | None = None,
    exchange: str | Sequence[str] | None = None,
    dates: str | Sequence[str] | None = None,
    schema: T.StructType | None = None,
    ts_format: str = DEFAULT_TS_FORMAT,
    quarantine: bool = False,
    ext: str = "csv",
) -> DataFrame:
    """Every series file under ``root`` as one DataFrame with the five layout columns.

    ``channel`` accepts aliases (train/eval/test) or directory names.
    """
    schema = schema if schema is not None else series_schema(quarantine=quarantine)

    def chan(v):
        if v is None:
            return None
        return CHANNEL_DIRS.get(v, v) if isinstance(v, str) else [CHANNEL_DIRS.get(x, x) for x in v]

    root = root.rstrip("/")
    if layout == "plain":
        glob = "/".join(
            [root, _glob_part(chan(channel)), _glob_part(data_type), _glob_part(exchange),
             _glob_part(dates), f"*.{ext}"]
        )
        df = read_series_csv(spark, glob, schema=schema, ts_format=ts_format, quarantine=quarantine)
        return df.withColumns(parts_from_path(file_path()))
    if layout == "hive":
        data_fields = [f for f in schema.fields if f.name != "_corrupt_record"]
        data_fields.append(T.StructField("symbol", T.StringType(), True))
        data_fields += [f for f in schema.fields if f.name == "_corrupt_record"]
        part_fields = [T.StructField(c, T.StringType(), True) for c in TREE_COLS]
        full = T.StructType(data_fields + part_fields)
        df = read_series_csv(spark, root, schema=full, ts_format=ts_format, quarantine=quarantine,
                             basePath=root)
        cond = F.lit(True)
        for col, val in (("channel", chan(channel)), ("data_type", data_type),
                         ("exchange", exchange), ("date", dates)):
            if val is None:
                continue
            vals = [val] if isinstance(val, str) else list(val)
            cond = cond & F.col(col).isin(vals)
        return df.filter(cond)
    raise ValueError(f"unknown layout {layout!r}")
