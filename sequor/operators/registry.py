"""Model registry as tables.

Exported models are rows of a model table ``(symbol, version, horizon, slope,
intercept, created)``, appended per export. An export writes the rows of an attempt
first and a commit row (version, attempt, time) last; readers take the newest
committed attempt of a version, so an export that broke off, or is still being
written, is never read and a retry doubles nothing. :func:`score_latest` scores with the
newest committed version of each series key. An artifact listing is a table
``(symbol, version, file_name)``: a symbol is servable when some version
holds the saved-model file, and the served version is the highest complete
one (versions compare as numbers).

All of it is aggregation by symbol with partial aggregation - no driver-side
directory walk. :func:`list_artifacts` builds the listing from an export tree
with the ``binaryFile`` source, selecting only the path so no file content is
read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import SAVED_MODEL_FILE, SequenceSpec
from .forecast import predict_linear


COMMITS = "_commits"  # readers of the model rows skip folders with this first letter


def write_attempt(model: DataFrame, path: str, version: int, created_col=None) -> str:
    """Write the rows of an export without committing them; returns the attempt."""
    attempt = uuid.uuid4().hex
    created = created_col if created_col is not None else F.current_timestamp()
    out = model.withColumn("version", F.lit(version).cast("long")).withColumn("created", created).withColumn("attempt", F.lit(attempt))
    out.write.mode("append").partitionBy("version", "attempt").parquet(path)
    return attempt


def commit(spark: SparkSession, path: str, version: int, attempt: str) -> None:
    """The last step of an export: one row."""
    row = spark.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(attempt).alias("attempt"), F.current_timestamp().alias("committed"))
    row.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/{COMMITS}")


def export_models(model: DataFrame, path: str, version: int, created_col=None) -> DataFrame:
    """M5: write the fitted model table under ``path`` as version ``version`` and commit it.

    Exporting a version again replaces it. Returns the table of all committed
    versions (lazily re-read from ``path``).
    """
    spark = model.sparkSession
    commit(spark, path, version, write_attempt(model, path, version, created_col))
    return read_models(spark, path)


def read_models(spark: SparkSession, path: str) -> DataFrame:
    """The model rows of every committed version."""
    commits = spark.read.schema("version long, attempt string, committed timestamp").parquet(f"{path.rstrip('/')}/{COMMITS}")
    # one row per version
    newest = commits.groupBy("version").agg(F.max_by("attempt", F.struct("committed", "attempt")).alias("attempt"))
    rows = spark.read.parquet(path).withColumn("version", F.col("version").cast("long"))
    return rows.join(newest, ["version", "attempt"]).drop("attempt")


def newest_models(models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each key the rows of its newest version: ``keys..., horizon, slope, intercept, version``."""
    own = F.struct("version", "slope", "intercept")
    best = models.groupBy(*keys, "horizon").agg(F.max_by(own, "version").alias("m"))
    return best.select(*keys, "horizon", "m.slope", "m.intercept", "m.version")


def score_latest(windows: DataFrame, path: str, spec: SequenceSpec, keys: Sequence[str] = ()) -> DataFrame:
    """Score windows with the newest committed version of their series key (``version``: NULL where there is none, and
    the last value is the prediction then)."""
    model = newest_models(read_models(windows.sparkSession, path), spec.series)
    return predict_linear(windows, model, spec, keys, extra=("version",))


def complete_symbols(listing: DataFrame, model_file: str = SAVED_MODEL_FILE) -> DataFrame:
    """Symbols whose export holds at least one complete artifact."""
    return (
        listing.groupBy("symbol")
        .agg(F.bool_or(F.coalesce(F.col("file_name") == F.lit(model_file), F.lit(False))).alias("_ok"))
        .filter("_ok")
        .select("symbol")
    )


def latest_complete_versions(listing: DataFrame, model_file: str = SAVED_MODEL_FILE) -> DataFrame:
    """M6: per symbol the highest version holding the model file.

    ``max_by`` keeps the whole row of that version (path etc.) without a
    self-join; symbols without a complete version are absent.
    """
    version_num = F.col("version").try_cast("long")  # an export that broke off may leave other folders
    complete = listing.filter((F.col("file_name") == F.lit(model_file)) & version_num.isNotNull())
    return complete.groupBy("symbol").agg(
        F.max(version_num).alias("version"),
        F.max_by(F.struct(*[c for c in listing.columns if c != "symbol"]), version_num).alias("artifact"),
    )


def list_artifacts(spark: SparkSession, export_root: str, pattern: str = "*") -> DataFrame:
    """Artifact listing of ``<root>/<symbol>/<version>/<file>`` via ``binaryFile``.

    Only ``path`` is selected, so file contents are never read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(export_root)
        .select("path")
    )
    root = export_root.split(":", 1)[-1].rstrip("/")
    root = "/" + root.lstrip("/")
    # exactly <symbol>/<version>/<file> below the root: deeper files belong to an artifact's own folders
    parts = F.split(F.substring_index("path", root + "/", -1), "/")
    return files.select(parts.alias("p")).filter(F.size("p") == 3).select(
        F.col("p")[0].alias("symbol"), F.col("p")[1].alias("version"), F.col("p")[2].alias("file_name"))
