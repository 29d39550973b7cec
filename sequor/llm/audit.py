"""Operator 13, source divergence audit: how the vocabularies of the sources of a language differ.

1. Tasks count terms per (lang, source) in bounded dictionaries; Spark adds the counts.
2. A language keeps the terms that enough of its documents hold. Kept terms get an id (bucket,
   chunk, bit): terms are dealt to buckets by hash and numbered inside a bucket by falling
   count, 64 to a chunk, so no task numbers a whole vocabulary and the terms of a chunk have
   similar counts.
3. Count-level bitmaps: per (group, count) the set of term ids with that count, held as the
   64-bit words that aren't empty, one per chunk.
4. Two groups of a language meet chunk by chunk: AND and population count of two words give the
   number of terms with count i here and j there, a joint cell, which is multiplied by f(i, j).
   Cells with a zero on one side come by complement: every term counts as f(0, 0), a term with
   count i adds f(i, 0) - f(0, 0), and a joint cell adds f(i, j) - f(i, 0) - f(0, j) + f(0, 0).

All arithmetic is in integers. f is below 10^9, so a sum is exact up to 9 * 10^9 kept terms.

Defined cases. Null text, lang or source: the empty string, a value like any other. Every row is a
document, also one that repeats an id (the id isn't read). Texts without terms still make a group;
its counts are 0. A language without kept terms: values 0 between its sources, no terms listed.
A language with one source has no pairs. An empty table gives an empty result. Extra columns are
ignored. A term has no greatest length.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LEAST_DOCS = 10
TOP_TERMS = 10
#: Entries of a task's dictionaries before they are sent on.
MOST_ENTRIES = 200_000
#: Groups or languages up to which their table is broadcast (a row each of a few numbers).
MOST_BROADCAST = 100_000
BUCKET_TERMS = 32_768

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of UTF-8: letters and all of other code points stay (A-Z lower-cased), the rest parts terms.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), df (documents) of every term; input lang, source, t without nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, df) in found.items():
                terms = pa.array(list(n), pa.binary()).cast(pa.string())
                each = [pa.array([x] * len(n), pa.string()) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays([*each, terms, pa.array(n.values(), pa.int64()), pa.array([df[t] for t in n], pa.int64())],
                                                 names=["lang", "source", "term", "n", "df"])
            found.clear()

        entries = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source")), batch.column("t").cast(pa.binary()), strict=True):
                n, df = found[lang, source]
                terms = terms_of(text.as_py())
                entries -= len(n)
                n.update(terms)
                entries += len(n)
                df.update(set(terms))
                if entries > MOST_ENTRIES:
                    yield from out()
                    entries = 0
        yield from out()

    parts = docs.mapInArrow(run, "lang string, source string, term string, n long, df long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(n: str, whole: str) -> Column:
    """1 + floor(10^9 (n + 2) / whole); null where whole is 0."""
    return F.expr(f"CASE WHEN {whole} > 0 THEN 1 + (CAST({n} + 2 AS DECIMAL(20, 0)) * 1000000000BD) DIV {whole} END")


def gap(p: str, q: str) -> str:
    """SQL of f for two shares."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) DIV (({p}) + ({q})))"


def _small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has at most MOST_BROADCAST rows."""
    return F.broadcast(df) if df.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else df


def vocabulary(counts: DataFrame, least_docs: int) -> tuple[DataFrame, DataFrame]:
    """The kept terms (lang, term, total, bucket, chunk, bit); and per language with kept terms v and whole (N + 2 V)."""
    kept = counts.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("total")).filter(F.col("df") >= least_docs)
    kept = stored(kept.select("lang", "term", "total"), "audit-kept")
    buckets = max(1, -(-kept.count() // BUCKET_TERMS))
    kept = kept.withColumn("bucket", F.pmod(F.xxhash64("lang", "term"), F.lit(buckets)).cast("int"))
    place = F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(F.desc("total"), "term")) - 1
    ids = kept.withColumn("place", place).select(
        "lang", "term", "total", "bucket", F.expr("CAST(place DIV 64 AS INT)").alias("chunk"), (F.col("place") % 64).cast("int").alias("bit"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("all"))
    return ids, langs.select("lang", "v", (F.col("all") + 2 * F.col("v")).alias("lang_whole"))


def level_bitmaps(cells: DataFrame) -> DataFrame:
    """Per group and count the words of its term-id bitset: lang, source, n, p, p0, bucket, chunk, bits."""
    keys = ["lang", "source", "n", "p", "p0", "bucket", "chunk"]
    return cells.groupBy(*keys).agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def pair_values(levels: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (sources, a < b), value: f summed over all kept terms. ``groups``: lang, source, v, p0."""
    a = levels.select("lang", "bucket", "chunk", *[F.col(c).alias(f"a_{c}") for c in ("source", "p", "p0", "bits")])
    b = levels.select("lang", "bucket", "chunk", *[F.col(c).alias(f"b_{c}") for c in ("source", "p", "p0", "bits")])
    meet = (F.col("a_source") < F.col("b_source")) & (F.col("a_bits").bitwiseAND(F.col("b_bits")) != 0)
    keys = [a[c] == b[c] for c in ("lang", "bucket", "chunk")]
    joint = a.join(b, keys[0] & keys[1] & keys[2] & meet).select(
        a["lang"], F.col("a_source").alias("a"), F.col("b_source").alias("b"), F.expr(
            f"bit_count(a_bits & b_bits) * ({gap('a_p', 'b_p')} - {gap('a_p', 'b_p0')} - {gap('a_p0', 'b_p')} + {gap('a_p0', 'b_p0')})").alias("value"))
    # terms with a count here and zero there, had they zero in all other groups
    sizes = levels.groupBy("lang", "source", "p", "p0").agg(F.sum(F.bit_count("bits")).alias("size"))
    other = groups.filter("v > 0").select("lang", F.col("source").alias("other"), F.col("p0").alias("other_p0"))
    alone = sizes.join(_small(other), "lang").filter("source != other").select(
        "lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"),
        F.expr(f"size * ({gap('p', 'other_p0')} - {gap('p0', 'other_p0')})").alias("value"))
    # every term, had it zero in both; this also lists every pair
    mine = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("a_p0"), "v")
    others = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("b_p0"))
    base = mine.join(others, "lang").filter("a < b").select(
        "lang", "a", "b", F.expr(f"CASE WHEN v > 0 THEN v * {gap('a_p0', 'b_p0')} ELSE 0 END").alias("value"))
    return joint.unionByName(alone).unionByName(base).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank: for every (lang, source) how far each other source of
    the language is from it, and the terms that it has most in excess of its language."""
    some = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = docs.select(some(lang_col).alias("lang"), some(source_col).alias("source"), some(text_col).alias("t"))
    counts = stored(term_counts(rows), "audit-counts")
    ids, langs = vocabulary(counts, least_docs)
    cells = stored(counts.select("lang", "source", "term", "n").join(ids, ["lang", "term"]), "audit-cells")
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), "lang_whole",
                           (F.coalesce("own", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("whole"))
    groups = stored(groups.withColumn("p0", share("0", "whole")), "audit-groups")
    cells = cells.join(_small(groups), ["lang", "source"]).withColumn("p", share("n", "whole"))

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    levels = stored(level_bitmaps(cells), "audit-levels")
    pairs = pair_values(levels, groups)
    both = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                  F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    both = both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value").withColumn("rank", F.row_number().over(by_value))

    over = cells.withColumn("q", share("total", "lang_whole")).filter("p > q")
    over = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(gap("p", "q")).alias("value"))
    over = over.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    return both.unionByName(over)


SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t
  FROM documents),
w AS (SELECT lang, source, r, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS df FROM w GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS total FROM c GROUP BY ALL HAVING sum(df) >= {LEAST_DOCS}),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(total) AS n FROM kept GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gt AS (
  SELECT lang, source, term, total, coalesce(c.n, 0)::HUGEINT AS n
  FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
own AS (SELECT lang, source, sum(n) AS own FROM gt GROUP BY ALL),
p AS (
  SELECT gt.lang, gt.source, term, gt.n, 1 + (1000000000::HUGEINT * (gt.n + 2)) // (own + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (total + 2)) // (v.n + 2 * v) AS q
  FROM gt JOIN own USING (lang, source) JOIN v ON v.lang = gt.lang),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
part AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM part)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
