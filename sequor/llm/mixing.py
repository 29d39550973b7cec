"""Operator 9, mixing sources to target weights: blocks drawn by index.

The word streams of each source are packed into blocks of ``block_words`` words.
A source whose target is t words fills about t / block_words slots of the mix.
How many slots each source has in each output shard is drawn first
(``shard_counts``): multinomial counts given that their totals meet the targets,
so no source misses its target by sampling noise. The slots are mapped from
these counts (``slots``): a source numbers its slots shard after shard, and its
slot i takes block perm(i mod blocks) of it, perm being a permutation of its own
for each pass; the sources' slots of a shard are permuted within it. Slots and
blocks are then joined by (source, block), both sides shuffled: a block has at most
``block_words`` pieces and a slot per pass, so no key is large.

``mixed`` returns the shards with the words of their slots in place, ``mix`` the
documents resampled by them, ``taken`` the words drawn of each row.

All permutations are swap-or-not shuffles: a few rounds, each a
reflection of the index decided by one hashed bit, hence a bijection on any
range. Nothing depends on partitioning or time: reruns agree.

Offsets of documents in their source's stream are two-level running sums over
about sqrt(n) buckets of about sqrt(n) documents, so no window holds a source.

Defined cases. Null text: size 0, takes 0. Null source: a source of its own,
last. Repeated rows: each row takes its own words. A source of size 0 has target
0. An empty table gives an empty result. Extra input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_key, stored, words_array

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 128
SHARD_SLOTS = 4096
ROUNDS = 24
_CHUNK = 4096


def permuted(index: Column, n: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0 .. n-1, told apart by ``key`` (swap-or-not)."""

    def step(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        return F.when(F.xxhash64(key, r, F.greatest(x, mirror)).bitwiseAND(1) == 1, mirror).otherwise(x)

    rounds = F.array(*[F.lit(r) for r in range(ROUNDS)])
    return F.aggregate(rounds, index.cast("long"), step)


def _with_source_key(docs: DataFrame, source_col: str) -> Column:
    # '0' + name for named sources, '1' for null: sorts by code point, null last
    return F.coalesce(F.concat(F.lit("0"), F.col(source_col)), F.lit("1"))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc, rk, sk (source key) and size in words of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return docs.select(F.col(id_col).alias("doc"), row_key(text).alias("rk"),
                       _with_source_key(docs, source_col).alias("sk"), size.alias("size"))


def source_targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """One row per source: sk, source_size, target. The targets are shares of
    ``share`` x all sizes by weight, cut at ``cap`` x the source's size, what is
    cut being shared anew by weight. Sorted by size per weight, the cut sources are
    a prefix, and the level of the others is the largest that running sums over sources give."""
    per = rows.groupBy("sk").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("sk")) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * float(cap))
    by_need = Window.orderBy(F.col("cap") / F.col("w"), "sk")
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = by_need.rowsBetween(Window.unboundedPreceding, -1)
    later = by_need.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(all_rows) * share
    level = (total - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) / F.sum("w").over(later)
    per = per.withColumn("level", level)
    # the level grows along the sources that are cut and falls after them
    target = F.least(F.max("level").over(all_rows) * F.col("w"), F.col("cap"))
    return per.select("sk", "source_size", target.alias("target"))


def placed(rows: DataFrame, n_rows: int) -> DataFrame:
    """Every row with ``start``, its offset in its source's stream of words."""
    buckets = 1 << max(0, (max(n_rows, 1).bit_length() + 1) // 2)
    rows = rows.withColumn("b", F.pmod(F.xxhash64("doc", F.lit("place")), F.lit(buckets)))
    sums = rows.groupBy("sk", "b").agg(F.sum("size").alias("bs"))
    ahead = Window.partitionBy("sk").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sk", "b", F.coalesce(F.sum("bs").over(ahead), F.lit(0)).alias("base"))
    inner = Window.partitionBy("sk", "b").orderBy("doc", "rk").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    return rows.join(sums, ["sk", "b"]).withColumn("start", F.col("base") + F.col("inside")).drop("b", "base", "inside")


def shard_counts(targets: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The draw: one row per source and output shard that has slots of it, with sk, blocks (of the
    source), shard, shard_n (slots of the shard) and count. All shards but the last have
    ``shard_slots`` slots. The counts are those of dealing all slots to the shards by one
    permutation, that is, multinomial given the totals."""
    size, target = F.col("source_size"), F.col("target")
    full = F.floor(target / size)
    rest = F.round((target - full * size) / block_words)
    plan = targets.filter(size > 0).select(
        "sk", F.ceil(size / block_words).cast("long").alias("blocks"), full.cast("long").alias("full"), rest.cast("long").alias("rest"))
    plan = plan.withColumn("n", F.col("full") * F.col("blocks") + F.least("rest", "blocks")).filter("n > 0")
    before = Window.orderBy("sk").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    plan = plan.withColumns({"ahead": F.coalesce(F.sum("n").over(before), F.lit(0)), "all": F.sum("n").over(every)})
    chunks = plan.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(_CHUNK).cast("long"))))
    # few bytes, much work: a fixed number of partitions, which isn't coalesced by size
    chunks = chunks.repartition(int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "sk", "c")
    each = chunks.withColumn("i", F.explode(F.sequence("c", F.least(F.col("c") + _CHUNK - 1, F.col("n") - 1))))
    at = permuted(F.col("ahead") + F.col("i"), F.col("all"), F.lit(9).cast("long"))
    each = each.select("sk", "blocks", "all", F.floor(at / shard_slots).cast("long").alias("shard"))
    counts = each.groupBy("sk", "blocks", "all", "shard").agg(F.count(F.lit(1)).alias("count"))
    shard_n = F.least(F.lit(shard_slots).cast("long"), F.col("all") - F.col("shard") * shard_slots)
    return counts.select("sk", "blocks", "shard", shard_n.alias("shard_n"), "count")


def slots(targets: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix: one row per slot with shard, slot (its place in the shard, from 0), sk, pass and
    block (of that source)."""
    counts = shard_counts(targets, block_words, shard_slots)
    of_source = Window.partitionBy("sk").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    of_shard = Window.partitionBy("shard").orderBy("sk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({"first": F.coalesce(F.sum("count").over(of_source), F.lit(0)),
                                 "ahead": F.coalesce(F.sum("count").over(of_shard), F.lit(0))})
    counts = counts.repartition(int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "sk", "shard")
    each = counts.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
    each = each.withColumn("i", F.col("first") + F.col("k"))
    each = each.withColumn("pass", F.floor(F.col("i") / F.col("blocks")).cast("long"))
    block = permuted(F.pmod("i", "blocks"), F.col("blocks"), F.xxhash64("sk", "pass"))
    slot = permuted(F.col("ahead") + F.col("k"), F.col("shard_n"), F.xxhash64("shard", F.lit("slot")))
    return each.select("shard", slot.alias("slot"), "sk", "pass", block.alias("block"))


def pieces(places: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The part of every row in every block it touches: sk, doc, rk, start, size, block, lo and
    len (words of the row, lo counted from its first)."""
    size, start = F.col("size"), F.col("start")
    blocks = F.sequence(F.floor(start / block_words), F.floor((start + size - 1) / block_words))
    out = places.filter(size > 0).withColumn("block", F.explode(blocks))
    lo = F.greatest(start, F.col("block") * block_words)
    hi = F.least(start + size, (F.col("block") + 1) * block_words)
    return out.withColumns({"lo": lo - start, "len": hi - lo})


def with_draws(parts: DataFrame, draws: DataFrame, how: str = "inner") -> DataFrame:
    """``parts`` (rows of :func:`pieces`) with the rows of ``draws`` for their block. Spark takes the
    exploded slots for as small as the counts they come from and would broadcast all of them."""
    return parts.join(draws.hint("merge"), ["sk", "block"], how)


def taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per input row: doc, size, source_size, target, taken (words in the mix, repeats counted)."""
    rows = stored(sized(docs, id_col, text_col, source_col), "mix-sizes")
    targets = stored(source_targets(rows), "mix-targets")
    places = placed(rows, rows.count())
    times = slots(targets, block_words).groupBy("sk", "block").agg(F.count(F.lit(1)).alias("times"))
    got = with_draws(pieces(places, block_words), times, "left")
    got = got.groupBy("sk", "start", "doc", "size").agg(F.coalesce(F.sum(F.col("len") * F.col("times")), F.lit(0)).alias("taken"))
    none = rows.filter("size = 0").select("sk", "doc", "size", F.lit(0).cast("long").alias("taken"))
    both = got.select("sk", "doc", "size", "taken").unionByName(none)
    return both.join(targets, "sk").select("doc", "size", "source_size", "target", "taken")


def _drawn(docs: DataFrame, got: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """The rows of ``docs`` (as ``_row``) with those of ``got`` for them; got has sk, doc, rk and start."""
    # identical rows are alike: number them, so that each input row meets its own draws
    got = got.withColumn("copy", F.dense_rank().over(Window.partitionBy("sk", "doc", "rk").orderBy("start"))).drop("start")
    d = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_doc"), _with_source_key(docs, source_col).alias("_sk"),
                    row_key(F.coalesce(F.col(text_col), F.lit(""))).alias("_rk"))
    d = d.withColumn("_copy", F.row_number().over(Window.partitionBy("_sk", "_doc", "_rk").orderBy("_rk")))
    on = F.col("_doc").eqNullSafe(F.col("doc")) & (F.col("_sk") == F.col("sk")) & (F.col("_rk") == F.col("rk")) & (F.col("_copy") == F.col("copy"))
    return d.join(got, on)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: each row of the input comes out once
    per pass that draws words of it, its text being the drawn words of that pass in order,
    parted by single spaces (the whole text as it was where the pass draws all of it). Rows
    without words aren't drawn. ``mixed`` has the same words by shard and slot."""
    rows = stored(sized(docs, id_col, text_col, source_col), "mix-sizes")
    targets = stored(source_targets(rows), "mix-targets")
    got = with_draws(pieces(placed(rows, rows.count()), block_words), slots(targets, block_words))
    got = got.groupBy("sk", "doc", "rk", "start", "size", "pass").agg(
        F.sum("len").alias("n"), F.sort_array(F.collect_list(F.struct("lo", "len"))).alias("runs"))
    whole = F.col("_row")[text_col]
    words = words_array(whole)
    some = F.array_join(F.flatten(F.transform("runs", lambda r: F.slice(words, (r["lo"] + 1).cast("int"), r["len"].cast("int")))), " ")
    text = F.when(F.col("n") == F.col("size"), whole).otherwise(some)
    d = _drawn(docs, got, id_col, text_col, source_col)
    return d.select(*[(text if c == text_col else F.col("_row")[c]).alias(c) for c in docs.columns])


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The shards of the mix: one row per slot and document in it, with shard, slot, part (order
    in the slot), doc, source and text (the document's words there, parted by single spaces).
    A slot is one block of one source, so its parts have at most ``block_words`` words."""
    rows = stored(sized(docs, id_col, text_col, source_col), "mix-sizes")
    targets = stored(source_targets(rows), "mix-targets")
    parts = pieces(placed(rows, rows.count()), block_words)
    # the words before it in the block: a row's place among the slot's parts
    part = F.col("start") + F.col("lo") - F.col("block") * block_words
    got = with_draws(parts.withColumn("part", part), slots(targets, block_words, shard_slots))
    got = got.groupBy("sk", "doc", "rk", "start").agg(F.collect_list(F.struct("shard", "slot", "part", "lo", "len")).alias("runs"))
    text = lambda w, r: F.array_join(F.slice(w, (r["lo"] + 1).cast("int"), r["len"].cast("int")), " ")
    # the outer lambda binds the words, so that a text is split once and not for each of its runs
    texts = F.transform(F.array(words_array(F.col("_row")[text_col])), lambda w: F.transform(
        "runs", lambda r: F.struct(r["shard"], r["slot"], r["part"], text(w, r).alias("text"))))
    d = _drawn(docs, got, id_col, text_col, source_col)
    d = d.select("doc", F.col("_row")[source_col].alias("source"), F.explode(texts[0]).alias("run"))
    return d.select("run.shard", "run.slot", "run.part", "doc", "source", "run.text")


def report(docs: DataFrame) -> DataFrame:
    """The digest of query op9."""
    return taken(docs).select(F.col("doc").alias("doc_id"), "size", "source_size", "target", "taken")
