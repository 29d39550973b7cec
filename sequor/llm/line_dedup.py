"""Operator 3, line dedup: range-partitioned line hashes with secondary sort.

Every long line becomes one narrow row (two 64-bit hashes of its key, document,
position). The rows are range-partitioned by (hash, document) and sorted by
(hash, document, position), so a key that a third of all documents hold is
spread over many partitions. Each partition numbers the occurrences of a key in a
document as they pass in that order and lets the first through; these are counted
per hash, in the partition first, before the small second shuffle. The hashes found
in enough documents are written: their size on disk tells Spark whether to broadcast
them to the narrow rows, and where not, its skew join splits a hot hash. What comes
back per document is not text but a run-length compressed keep bitmap.

Defined cases. Null or empty text: one empty line. A null id counts as one
document that is smaller than every other. Rows that repeat an id are one
document for the counts; each row gets the bitmap of its own text. Lines whose
key is shorter than ``min_chars`` always stay. Extra input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, row_key, stored, two_hashes


def line_key(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


def _lower_ascii(key: Column) -> Column:
    """A string that is equal for two keys exactly if they are equal with A-Z
    lower-cased. For keys with other letters the UTF-8 bytes are read as Latin-1
    first: lower() then maps A-Z and lead bytes only, one to one for valid UTF-8
    (the count of continuation bytes tells a mapped lead byte from a real one)."""
    latin = F.decode(F.encode(key, "UTF-8"), "ISO-8859-1")
    return F.lower(F.when(F.octet_length(key) == F.length(key), key).otherwise(latin))


def first_occurrences(keyed: DataFrame) -> DataFrame:
    """Of rows (h1, h2, doc, pos) the first of every hash and document. The range partitioning and the sort are
    those that the window asks for, so neither is made twice, and rows only pass by."""
    stream = (
        keyed.select("h1", "h2", "doc", "pos")
        .repartitionByRange("h1", "h2", "doc")
        .sortWithinPartitions("h1", "h2", "doc", "pos")
    )
    nth = F.row_number().over(Window.partitionBy("h1", "h2", "doc").orderBy("pos"))
    return stream.withColumn("nth", nth).filter("nth = 1").drop("nth")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """For every document that loses a line: ``doc``, ``row_key`` (hash of its
    text), ``n_lines``, ``n_dropped`` and ``keep_runs``, the keep bitmap as
    array<struct<start,len>> of its runs of ones (lines counted from 0).

    A key found in at least ``min_docs`` documents keeps the lines of the largest
    document that holds it and loses all others."""
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    lines = rows.select("doc", row_key(F.col("t")).alias("rk"), F.split("t", "\n").alias("ls"))
    lines = lines.select("doc", "rk", F.size("ls").alias("n_lines"), F.posexplode("ls").alias("pos", "line"))
    keyed = lines.select("doc", "rk", "n_lines", "pos", line_key(F.col("line")).alias("key"))
    keyed = keyed.filter(F.length("key") >= min_chars)
    h1, h2 = two_hashes(_lower_ascii(F.col("key")))
    keyed = stored(keyed.select(h1.alias("h1"), h2.alias("h2"), "doc", "rk", "n_lines", "pos"), "line-keys")

    shared = (
        first_occurrences(keyed).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs).drop("n_docs")
    )
    shared = stored(shared, "shared-lines")
    gone = keyed.join(shared, ["h1", "h2"]).filter(~F.col("doc").eqNullSafe(F.col("keeper")))

    per_row = Window.partitionBy("doc", "rk")
    gone = gone.select("doc", "rk", "n_lines", "pos").distinct()
    gone = gone.withColumn("run", F.col("pos") - F.row_number().over(per_row.orderBy("pos")))
    runs = gone.groupBy("doc", "rk", "run").agg(
        F.min("pos").alias("start"), F.count(F.lit(1)).cast("int").alias("len"), F.first("n_lines").alias("n_lines"))
    runs = runs.groupBy("doc", "rk").agg(
        F.first("n_lines").alias("n_lines"), F.sum("len").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("start", "len"))).alias("cut"))
    # the runs of ones lie before each run of zeros, and after the last one
    ends = F.concat(F.col("cut"), F.array(F.struct(F.col("n_lines").alias("start"), F.lit(0).alias("len"))))

    def before(cut: Column, i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1)["start"] + F.get(ends, i - 1)["len"])
        return F.struct(start.alias("start"), (cut["start"] - start).alias("len"))

    keep = F.filter(F.transform(ends, before), lambda r: r["len"] > 0)
    return runs.select("doc", F.col("rk").alias("row_key"), "n_lines", "n_dropped", keep.alias("keep_runs"))


def kept_text(text: Column, keep_runs: Column) -> Column:
    """The lines of a non-null text that the bitmap keeps (null bitmap: all), joined by newlines."""
    lines = F.split(text, "\n")
    kept = F.flatten(F.transform(keep_runs, lambda r: F.slice(lines, r["start"] + 1, r["len"])))
    return F.when(keep_runs.isNull(), text).otherwise(F.array_join(kept, "\n"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, whose names can't clash with the bitmap columns beside it:
    n_dropped and keep_runs (null: nothing dropped)."""
    d = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), row_key(F.coalesce(F.col(text_col), F.lit(""))).alias("rk"))
    on = F.col("id").eqNullSafe(F.col("doc")) & (F.col("rk") == F.col("row_key"))
    return d.join(bitmaps, on, "left").select("row", "n_dropped", "keep_runs")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """``docs`` with the dropped lines taken out of the text, same columns."""
    both = apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, **rule), id_col, text_col)
    old = F.col("row")[text_col]  # a null text has one short line, so it never has a bitmap
    text = F.when(F.col("keep_runs").isNull(), old).otherwise(kept_text(old, F.col("keep_runs")))
    return both.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """The digest of query op3: one row per document."""
    both = apply_bitmaps(docs.select("doc_id", "text"), keep_bitmaps(docs))
    text = F.coalesce(F.col("row")["text"], F.lit(""))
    return both.select(
        F.col("row")["doc_id"].alias("doc_id"), F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.col("n_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept_text(text, F.col("keep_runs")), 256).alias("kept_sha256"))


SQL = """
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM docs),
keyed AS (
  SELECT doc_id, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, (s.key IS NOT NULL AND k.doc_id <> s.keeper) AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
