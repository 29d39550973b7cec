"""Operator 7, quality rules: distribution divergence from language references.

Per document two histograms: character classes, and the common words of its
language (plus all other words). The common words of a language are the ``COMMON_WORDS`` words that
most of its documents hold, counted over all its documents. The reference of a language is the mean histogram
over all documents of it that pass the length guards, so one giant document weighs
no more than another. A document is rejected if the Jensen-Shannon divergence
(base 2) of either histogram from its reference, or their sum, is above its limit. Each test only
applies from a minimum length on, and where the reference rests on enough documents.

Proportions are integers per million before they are averaged, so the references
don't depend on the order of summation.

Defined cases. Null text: like an empty text (no words; base_failed). Null language:
a language of its own. A language with fewer than ``MIN_REFERENCE_DOCS`` documents that pass a guard has no reference,
so that test does not apply. Words held by equally many documents: the smaller word is the more common one.
Repeated rows are judged alike. An empty table gives an empty result. Extra input
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, words_array

# Limits in bits, and the least lengths from which a test applies.
MAX_CLASS_DIVERGENCE = 0.05
MAX_WORD_DIVERGENCE = 0.25
MAX_SUM_DIVERGENCE = 0.125
MIN_CHARS = 200
MIN_WORDS = 50
MIN_REFERENCE_DOCS = 20
COMMON_WORDS = 32
WINDOW = 8
_MILLION = 1_000_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column, width: int = WINDOW) -> Column:
    """Words that lie in windows of ``width`` words found twice or more (windows compared by 64-bit hash)."""
    n = F.size(words)

    def grams(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(width)]))

    def covered(pairs: Column) -> Column:
        def twice(s: Column, i: Column) -> Column:
            near = F.get(pairs, i - 1)["h"].eqNullSafe(s["h"]) | F.get(pairs, i + 1)["h"].eqNullSafe(s["h"])
            return near

        at = F.sort_array(F.transform(F.filter(pairs, twice), lambda s: s["p"]))
        start = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(at, start, lambda a, p: F.struct(
            p.alias("last"), (a["n"] + F.least(F.lit(width), p - a["last"])).alias("n")), lambda a: a["n"])

    def count(g: Column) -> Column:
        pairs = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(_let(pairs, covered))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(n < width, F.lit(0)).otherwise(_let(hashes, lambda h: _let(grams(h), count)))


def _texts(docs: DataFrame, id_col: str | Column, text_col: str, lang_col: str) -> DataFrame:
    """doc, lang (marked by a first character; a null one is empty), t and words."""
    t = docs.select((F.col(id_col) if isinstance(id_col, str) else id_col).alias("doc"), F.concat(F.lit("="), F.col(lang_col)).alias("lang"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return t.select("doc", F.coalesce("lang", F.lit("")).alias("lang"), "t", words_array(F.col("t")).alias("words"))


def common_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = COMMON_WORDS) -> DataFrame:
    """lang and list: the lower-cased words that most documents of each language hold, most common first."""
    t = _texts(docs.withColumn(text_col, F.lower(text_col)), F.lit(None), text_col, lang_col)
    held = t.select("lang", F.explode(F.array_distinct("words")).alias("word"))
    held = held.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))  # the limit is taken before the shuffle
    top = held.withColumn("rank", rank).filter(F.col("rank") <= most)
    inside = F.transform(F.sort_array(F.collect_list(F.struct("rank", "word"))), lambda s: s["word"])
    return top.groupBy("lang").agg(inside.alias("list"))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc, lang, the base counts, and the two histograms as arrays of counts."""
    lists = stored(common_words(docs, text_col, lang_col), "quality-words")
    t = _texts(docs, id_col, text_col, lang_col).join(lists, "lang", "left")
    t = t.select(
        "doc", "lang", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length("t").cast("long").alias("n_chars"),
        (F.octet_length("t") - F.length("t")).cast("long").alias("beyond"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("t", F.lit(r"[A-Z]")).cast("long").alias("upper"),
        F.regexp_count("t", F.lit(r"[0-9]")).cast("long").alias("digits"),
        F.regexp_count("t", F.lit(r"[.,;:!?'\"()-]")).cast("long").alias("marks"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        "list", F.filter(F.transform("words", F.lower), lambda w: F.array_contains("list", w)).alias("hits"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"))
    space = F.col("n_chars") - F.col("word_chars")
    plain = F.greatest(F.lit(0), F.col("word_chars") - F.col("n_symbols") - F.col("upper") - F.col("digits") - F.col("marks") - F.col("beyond"))
    t = t.withColumn("counts", F.transform("list", lambda w: (F.size("hits") - F.size(F.array_remove("hits", w))).cast("long")))
    rest = F.col("n_words") - F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)
    return t.select(
        "doc", "lang", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words", "n_chars",
        F.array(space, plain, "upper", "digits", "marks", "n_symbols", "beyond").alias("classes"),
        F.concat("counts", F.array(rest)).alias("common"))


def _shares(counts: Column) -> Column:
    """Counts as integers per million of their sum (sum above 0)."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)
    return _let(total, lambda n: F.transform(counts, lambda c: F.floor(c * _MILLION / n).cast("long")))


def _bits(p: Column, m: Column) -> Column:
    return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))


def js_divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon divergence in bits of two arrays of shares per million."""

    def term(a: Column, b: Column) -> Column:
        x, y = a / F.lit(float(_MILLION)), b / F.lit(float(_MILLION))
        return (_bits(x, (x + y) / 2) + _bits(y, (x + y) / 2)) / 2

    return F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda s, x: s + x)


def references(rows: DataFrame, kind: str, guard: Column) -> DataFrame:
    """lang and the mean shares of ``kind`` over its documents within the guard."""
    each = rows.filter(guard & F.col(kind).isNotNull()).select("lang", F.posexplode(_shares(F.col(kind))).alias("i", "x"))
    per = each.groupBy("lang", "i").agg(F.sum("x").alias("s"), F.count(F.lit(1)).alias("n"))
    per = per.filter(F.col("n") >= MIN_REFERENCE_DOCS).withColumn("x", F.floor(F.col("s") / F.col("n")).cast("long"))
    whole = F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"])
    return per.groupBy("lang").agg(whole.alias(f"{kind}_ref"))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           max_class: float = MAX_CLASS_DIVERGENCE, max_word: float = MAX_WORD_DIVERGENCE,
           max_sum: float = MAX_SUM_DIVERGENCE) -> DataFrame:
    """The base counts of every row, both divergences (null where the test doesn't apply), base_failed and kept."""
    rows = stored(measured(docs, id_col, text_col, lang_col), "quality-counts")
    long_text, many_words = F.col("n_chars") >= MIN_CHARS, F.col("n_words") >= MIN_WORDS
    out = rows.join(references(rows, "classes", long_text), "lang", "left").join(references(rows, "common", many_words), "lang", "left")
    by_class = F.when(long_text & F.col("classes_ref").isNotNull(), js_divergence(_shares(F.col("classes")), F.col("classes_ref")))
    by_word = F.when(many_words & F.col("common").isNotNull() & F.col("common_ref").isNotNull(),
                     js_divergence(_shares(F.col("common")), F.col("common_ref")))
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    own = F.when(F.col("lang") != "", F.substring("lang", 2, 2**31 - 1)).alias("lang")  # without the mark that tells it from null
    out = out.select("doc", own, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     by_class.alias("class_divergence"), by_word.alias("word_divergence"), failed.alias("base_failed"))
    by_class, by_word = F.coalesce("class_divergence", F.lit(0.0)), F.coalesce("word_divergence", F.lit(0.0))
    near = (by_class <= max_class) & (by_word <= max_word) & (by_class + by_word <= max_sum)
    return out.withColumn("kept", ~F.col("base_failed") & near)


def report(docs: DataFrame) -> DataFrame:
    """The digest of query op7."""
    return judged(docs).select(F.col("doc").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                               "n_repeat_words", "base_failed", "kept")
