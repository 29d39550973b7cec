"""Raw series CSV reader.

A raw series file has a header row, the time index first and then float
features. The schema is fixed (no inference): it is the contract between the
writer and every reader. Reading is permissive: a blank or malformed cell
becomes NULL, and with ``quarantine=True`` the raw line of a malformed record
lands in ``_corrupt_record`` so it can be counted or routed away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..params import DEFAULT_FEATURES, DEFAULT_INDEX_COL

DEFAULT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
CORRUPT_COL = "_corrupt_record"


def series_schema(
    features: Sequence[str] = DEFAULT_FEATURES,
    index_col: str = DEFAULT_INDEX_COL,
    ntz: bool = True,
    feature_type: T.DataType | None = None,
    extra: Sequence[T.StructField] = (),
    quarantine: bool = False,
) -> T.StructType:
    """Index column + float features (declared non-null, nullable in practice)."""
    ts_type = T.TimestampNTZType() if ntz else T.TimestampType()
    ftype = feature_type if feature_type is not None else T.FloatType()
    fields = [T.StructField(index_col, ts_type, True)]
    fields += [T.StructField(f, ftype, True) for f in features]
    fields += list(extra)
    if quarantine:
        fields.append(T.StructField(CORRUPT_COL, T.StringType(), True))
    return T.StructType(fields)


def read_series_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    ts_format: str = DEFAULT_TS_FORMAT,
    quarantine: bool = False,
    **options,
) -> DataFrame:
    """Read one or many series CSV files with a fixed schema.

    Raises ``FileNotFoundError`` (S9) when the path or glob matches nothing.
    """
    schema = schema if schema is not None else series_schema(quarantine=quarantine)
    if quarantine and CORRUPT_COL not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("timestampFormat", ts_format)
        .option("timestampNTZFormat", ts_format)
    )
    if quarantine:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    for k, v in options.items():
        reader = reader.option(k, v)
    path_list = [paths] if isinstance(paths, str) else list(paths)
    if not path_list:
        raise FileNotFoundError("no input series files given")
    try:
        return reader.csv(path_list)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            raise FileNotFoundError(f"no series files at {path_list}: {exc}") from exc
        raise
