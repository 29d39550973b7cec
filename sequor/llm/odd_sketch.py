"""Operator 11, MinHash near-dedup with odd sketches.

1. One pass over the texts gives each document's shingle set its size, a digest, MinHash samples,
   the hashes of their bands and its odd sketch: every (sample number, sample) flips one bit of a
   bitmap, so samples that two sets share cancel in the XOR of their sketches, and its population
   count tells how many differ. Equal sets form one class; from here on each class counts once.
2. Classes that share a band hash are a bucket. Each of its classes meets the bucket's leader (the
   least), so a bucket of any size costs one narrow row a class and is never gathered. Pairs
   whose XOR has more bits than two linked sets have but once in 10^9 go; the rest are
   compared on their full sets, read again from the texts. The links give components.
3. Most buckets are one component now and done. In the others a class outside the leader's component
   (an outsider) can still link with any class of another component. Such a bucket meets in tasks of
   bounded size, small ones several at a time, larger ones as blocks of all its classes times
   blocks of outsiders. A task lists by XOR counts what could link with each outsider,
   and compares full sets, the likeliest first, only between groups that aren't linked yet.
4. All links give the components.

Two sets at the threshold share no band, or exceed the count, with a chance under 10^-9 each; the samples
are seeded by constants, so reruns agree. Shingles are compared by 64 bits of hash, classes by 128 bits.

Defined cases. Null text, or text without words: empty set, linked with nothing. A text with fewer
words than a shingle: its whole sequence is its shingle. Rows that repeat an id are
one document, linked by each of their texts. A null id has no links, a null component and is kept.
An empty table gives an empty result. Extra input columns are ignored. Ids are integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, stored
from .components import components
from .hashing import chunks, mixed, shingles, text_buffer, word_hashes

WIDTH = 5
THRESHOLD = 80  # percent
ROWS = 4  # samples in a band
BITS = 1024
MISS = 1e-9
#: Shingles in a task of step 3 (of its classes and, again, of its outsiders).
BLOCK_SHINGLES = 1_000_000
#: Needed texts up to which the list of their ids is broadcast (two numbers each).
MOST_BROADCAST = 100_000
_SEED, _SEED2 = 0x2545F4914F6CDD1D, 0x9E6C63D0876A9A63  # fixed values: any two numbers


@dataclass(frozen=True)
class Sampling:
    """The samples, bands and count limit for a threshold."""

    percent: int

    @property
    def bands(self) -> int:
        """So many that two sets at the threshold share none with a chance under MISS."""
        return math.ceil(math.log(MISS) / math.log1p(-((self.percent / 100) ** ROWS)))

    @property
    def samples(self) -> int:
        return self.bands * ROWS

    def numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """An odd factor and a mask per sample."""
        rng = np.random.default_rng(11)
        draw = lambda: rng.integers(0, 2**63, self.samples, dtype=np.uint64)
        return draw() * np.uint64(2) + np.uint64(1), draw()

    def limit(self) -> int:
        """The least count that the XOR of two sketches at the threshold exceeds with a chance under MISS."""
        k, differ = self.samples, 1 - self.percent / 100
        odd = np.zeros(BITS + 1)  # chance of so many odd bits after the flips so far
        odd[0], at, total = 1, np.arange(BITS + 1), np.zeros(BITS + 1)
        for d in range(k + 1):  # d samples differ: 2 d flips
            chance = math.exp(math.lgamma(k + 1) - math.lgamma(d + 1) - math.lgamma(k - d + 1) + d * math.log(differ) + (k - d) * math.log1p(-differ))
            total += chance * odd
            for _ in range(2):
                up, down = odd * (BITS - at) / BITS, odd * at / BITS
                odd = np.r_[0, up[:-1]] + np.r_[down[1:], 0]
        beyond = 1 - np.cumsum(total)
        return int(np.flatnonzero(beyond < MISS)[0])


def shingle_sets(texts: pa.StringArray, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, the sorted distinct shingle hashes of each row) by slices of a column."""
    for lo, part in chunks(texts):
        words, row = word_hashes(*text_buffer(part))
        hashes, row, _ = shingles(words, row, width)
        hashes = hashes[np.argsort(row, kind="stable")]
        ends = np.cumsum(np.bincount(row, minlength=len(part)))
        out = []
        for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True):
            s = np.sort(hashes[a:b])
            out.append(s[np.r_[True, s[1:] != s[:-1]]] if len(s) else s)
        yield lo, out


def samples_of(sets: list[np.ndarray], sampling: Sampling) -> np.ndarray:
    """The MinHash samples (columns) of non-empty sets (rows)."""
    h = np.concatenate(sets)
    starts = np.r_[0, np.cumsum([len(s) for s in sets])[:-1]]
    out = np.empty((len(sets), sampling.samples), np.uint64)
    for i, (factor, mask) in enumerate(zip(*sampling.numbers(), strict=True)):
        out[:, i] = np.minimum.reduceat((h ^ mask) * factor, starts)
    return out


def sketch(samples: np.ndarray) -> np.ndarray:
    """Odd sketches (rows of BITS / 64 words): the parity of how many samples fall on each bit."""
    number = np.arange(samples.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bit = (mixed(samples + number) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
    out = []
    for lo in range(0, len(samples), 1024):
        part = bit[lo:lo + 1024]
        odd = np.bincount((part + np.arange(len(part))[:, None] * BITS).ravel(), minlength=len(part) * BITS) & 1
        out.append(np.packbits(odd.reshape(len(part), BITS).astype(np.uint8), axis=1, bitorder="little").view("<u8"))
    return np.concatenate(out) if out else np.zeros((0, BITS // 64), np.uint64)


def band_hashes(samples: np.ndarray) -> np.ndarray:
    """One hash per band; it covers the band's number."""
    turn = np.random.default_rng(12).integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    by = samples.reshape(len(samples), -1, ROWS)
    return mixed((by * turn).sum(2) + np.arange(by.shape[1], dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.searchsorted(b, a)
    shared = int((b[np.minimum(both, len(b) - 1)] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def profile(rows: DataFrame, width: int, sampling: Sampling) -> DataFrame:
    """Per row doc, rk, n, d1, d2 (size and digest of its set), sketch and bands (null for the empty set)."""

    def lists(values: np.ndarray, has: np.ndarray) -> pa.Array:
        ends = np.r_[0, np.cumsum(np.where(has, values.shape[1], 0))].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64).ravel()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, sets in shingle_sets(batch.column("t"), width):
                n = np.array([len(s) for s in sets], np.int64)
                has = n > 0
                some = [s for s in sets if len(s)]
                mins = samples_of(some, sampling) if some else np.zeros((0, sampling.samples), np.uint64)
                digests = [np.array([mixed(s ^ np.uint64(seed)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64) for seed in (_SEED, _SEED2)]
                own = batch.slice(lo, len(sets))
                yield pa.RecordBatch.from_arrays([own.column("doc"), own.column("rk"), pa.array(n), *map(pa.array, digests),
                                                  lists(sketch(mins), has), lists(band_hashes(mins), has)],
                                                 names=["doc", "rk", "n", "d1", "d2", "sketch", "bands"])

    return rows.mapInArrow(run, "doc long, rk long, n long, d1 long, d2 long, sketch array<long>, bands array<long>")


def differing_bits(a: str, b: str) -> Column:
    """The population count of the XOR of two sketch columns."""
    return F.expr(" + ".join(f"bit_count(get({a}, {i}) ^ get({b}, {i}))" for i in range(BITS // 64)))


def _texts(rows: DataFrame, need: DataFrame) -> DataFrame:
    """doc, rk, t of the needed (doc, rk), once each."""
    need = stored(need.distinct(), "odd-need")
    small = need.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    return stored(rows.join(F.broadcast(need) if small else need, ["doc", "rk"]).groupBy("doc", "rk").agg(F.any_value("t").alias("t")), "odd-texts")


def leader_links(pairs: DataFrame, classes: DataFrame, rows: DataFrame, width: int, sampling: Sampling) -> DataFrame:
    """The links (a, b: documents) among pairs (c, leader) of classes, by sketches and then on full sets."""
    percent = sampling.percent
    own = [F.col(c).alias(f"a_{c}") for c in ("c", "n", "doc", "rk", "sketch")]
    other = [F.col(c).alias(f"b_{c}") for c in ("c", "n", "doc", "rk", "sketch")]
    near = pairs.join(classes.select(*own), F.col("c") == F.col("a_c")).join(classes.select(*other), F.col("leader") == F.col("b_c"))
    near = near.filter((F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent)
                       & (differing_bits("a_sketch", "b_sketch") <= sampling.limit()))
    near = stored(near.select("a_doc", "a_rk", "b_doc", "b_rk"), "odd-pairs")
    sides = [near.select(F.col(f"{x}_doc").alias("doc"), F.col(f"{x}_rk").alias("rk")) for x in "ab"]
    texts = _texts(rows, sides[0].unionByName(sides[1]))
    for x in "ab":
        same = (F.col(f"{x}_doc") == F.col(f"{x}_k")) & (F.col(f"{x}_rk") == F.col(f"{x}_r"))
        near = near.join(texts.select(F.col("doc").alias(f"{x}_k"), F.col("rk").alias(f"{x}_r"), F.col("t").alias(f"{x}_t")), same).drop(f"{x}_k", f"{x}_r")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            b = pa.chunked_array([batch.column("b_t")]).dictionary_encode().combine_chunks()  # a leader's text in many rows
            leaders = [s for _, some in shingle_sets(b.dictionary, width) for s in some]
            which = b.indices.to_numpy()
            for lo, sets in shingle_sets(batch.column("a_t"), width):
                for i, s in enumerate(sets, lo):
                    good[i] = linked(s, leaders[which[i]], percent)
            some = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([some.column("a_doc"), some.column("b_doc")], names=["a", "b"])

    return near.select("a_doc", "b_doc", "a_t", "b_t").mapInArrow(verify, "a long, b long")


def open_links(members: list[dict], sets: list[np.ndarray], sketches: np.ndarray, sampling: Sampling) -> list[tuple[int, int]]:
    """A spanning forest of the links between outsiders and all members of shared buckets, beside the given components.
    ``members``: component, keys (list of key, out, all)."""
    sizes = np.array([len(s) for s in sets])
    _, group = np.unique([m["comp"] for m in members], return_inverse=True)
    limit, percent = sampling.limit(), sampling.percent
    held: dict[int, tuple[list[int], list[int]]] = {}
    for i, m in enumerate(members):
        for k in m["keys"]:
            all_, out = held.setdefault(k["key"], ([], []))
            if k["all"]:
                all_.append(i)
            if k["out"]:
                out.append(i)
    tested: set[tuple[int, int]] = set()
    found = []
    for all_, out in held.values():
        every = np.array(all_, int)
        for x in out:
            mine, theirs = sizes[x], sizes[every]
            every_ok = every[(group[every] != group[x]) & (np.minimum(mine, theirs) * 100 >= percent * np.maximum(mine, theirs))]
            if not len(every_ok):
                continue
            bits = np.bitwise_count(sketches[every_ok] ^ sketches[x]).sum(1)
            order = np.argsort(bits, kind="stable")
            for y in every_ok[order[: np.searchsorted(bits[order], limit, side="right")]]:
                pair = (min(x, y), max(x, y))
                if group[y] == group[x] or pair in tested:
                    continue
                tested.add(pair)
                if linked(sets[x], sets[y], percent):
                    found.append((x, int(y)))
                    group[group == group[y]] = group[x]
    return found


def rest_links(shared: DataFrame, classes: DataFrame, comps: DataFrame, rows: DataFrame, width: int, sampling: Sampling) -> DataFrame | None:
    """The links (a, b: documents) in buckets that aren't one component. ``shared``: key, c, leader; ``comps``: c, comp, n."""
    held = shared.join(comps, "c")
    spread = held.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    held = stored(held.join(stored(spread, "odd-open"), "key"), "odd-held")
    if held.isEmpty():
        return None
    home = held.filter("c = leader").groupBy("key").agg(F.min("comp").alias("home"))
    groups = held.join(home, "key").groupBy("key", "home").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("c")).alias("who"), F.min("c").alias("a"),
        F.sum("n").alias("load"), F.sum(F.when(F.col("comp") != F.col("home"), F.col("n"))).alias("out_load"))
    # buckets with the same classes count once
    groups = groups.groupBy("who", "size", "a", "load", "home", "out_load").agg(F.min("key").alias("key"))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK_SHINGLES).cast("int")
    groups = stored(groups.select("key", "home", "a", "load", blocks("load").alias("rows"), blocks("out_load").alias("cols")), "odd-groups")
    shards = groups.filter("rows = 1").agg(F.ceil(F.coalesce(F.sum("load"), F.lit(0)) / BLOCK_SHINGLES)).first()[0] or 1
    # a class heads at most as many buckets as it has bands, so a shard stays bounded
    groups = groups.withColumn("shard", F.when(F.col("rows") > 1, F.col("key")).otherwise(F.pmod(F.xxhash64("a"), F.lit(shards))))
    held = held.join(groups.drop("load", "a"), "key").withColumn("out", F.col("comp") != F.col("home"))
    i, j = F.pmod(F.xxhash64("c"), "rows").cast("int"), F.pmod(F.xxhash64("c", F.lit(1)), "cols").cast("int")
    every = held.withColumn("i", i).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("cols") - 1)))
    outs = held.filter("out").withColumn("j", j).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    cols = ["shard", "rows", "i", "j", "c", "comp", "key"]
    both = every.select(*cols, F.lit(True).alias("all"), F.lit(False).alias("out")).unionByName(outs.select(*cols, F.lit(False).alias("all"), F.lit(True).alias("out")))
    tasks = both.groupBy("shard", "rows", "i", "j", "c", "comp").agg(F.collect_list(F.struct("key", "all", "out")).alias("keys"))
    tasks = tasks.join(classes.select("c", "doc", "rk", "sketch"), "c")
    tasks = stored(tasks, "odd-tasks")
    tasks = tasks.join(_texts(rows, tasks.select("doc", "rk")), ["doc", "rk"])

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc", "ascending"), ("rk", "ascending")]).combine_chunks()
        members = table.select(["comp", "keys"]).to_pylist()
        sets = [s for part in table.column("t").chunks for _, some in shingle_sets(part, width) for s in some]
        words = np.array(table.column("sketch").to_pylist(), np.int64).view(np.uint64)
        docs = table.column("doc").to_pylist()
        got = open_links(members, sets, words, sampling)
        return pa.table({"a": pa.array([docs[x] for x, _ in got], pa.int64()), "b": pa.array([docs[y] for _, y in got], pa.int64())})

    return tasks.groupBy("shard", "rows", "i", "j").applyInArrow(join, "a long, b long")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = THRESHOLD) -> DataFrame:
    """One row per input row: doc, rk, n_shingles, component (the smallest id reachable by links)."""
    sampling = Sampling(percent)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), row_key(text).alias("rk"), text.alias("t"))
    seen = stored(profile(rows, width, sampling), "odd-profile")
    known = seen.filter("n > 0 and doc is not null")
    classes = known.groupBy("d1", "d2", "n").agg(F.min(F.struct("doc", "rk")).alias("rep"), F.any_value("sketch").alias("sketch"), F.any_value("bands").alias("bands"))
    classes = stored(classes.select(F.col("d1").alias("c"), "d2", "n", "rep.doc", "rep.rk", "sketch", "bands"), "odd-classes")

    tokens = classes.select("c", F.explode("bands").alias("key"))
    leaders = tokens.groupBy("key").agg(F.min("c").alias("leader"), F.count(F.lit(1)).alias("size")).filter("size > 1").drop("size")
    shared = stored(tokens.join(stored(leaders, "odd-leaders"), "key"), "odd-shared")
    pairs = shared.filter("c != leader").select("c", "leader").distinct()
    links = stored(leader_links(pairs, classes, rows, width, sampling), "odd-links")
    # an id with several texts joins the classes of all of them
    member = known.join(classes.select(F.col("c").alias("d1"), "d2", "n", F.col("doc").alias("rep")), ["d1", "d2", "n"]).select("doc", "rep")
    several = member.groupBy("doc").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a < z").select("doc", "a")
    several = stored(member.join(stored(several, "odd-several"), "doc").select("a", F.col("rep").alias("b")).distinct(), "odd-ids")
    links = links.unionByName(several)

    root = lambda found: classes.join(found, F.col("doc") == F.col("node"), "left").withColumn("comp", F.coalesce("root", "doc"))
    found = stored(components(links), "odd-components")
    more = rest_links(shared, classes, root(found).select("c", "comp", "n"), rows, width, sampling)
    if more is not None:
        # each component is a node now
        found = stored(components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(stored(more, "odd-rest"))), "odd-all")
    of_class = stored(root(found).select(F.col("c").alias("d1"), "d2", "n", "comp"), "odd-roots")
    out = seen.select("doc", "rk", "n", "d1", "d2").join(of_class, ["d1", "d2", "n"], "left")
    return out.select("doc", "rk", F.col("n").alias("n_shingles"), F.when(F.col("doc").isNotNull(), F.coalesce("comp", "doc")).alias("component"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = THRESHOLD) -> DataFrame:
    """``docs`` without the rows of documents that are linked with one of a smaller id (null ids stay)."""
    gone = near_components(docs, id_col, text_col, width, percent).filter("component < doc").select(F.col("doc").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == F.col("_gone"), "left_anti")


def report(docs: DataFrame) -> DataFrame:
    """The digest of query op11: four words, 80 %."""
    out = near_components(docs, width=4, percent=80)
    kept = F.coalesce(F.col("component") == F.col("doc"), F.lit(True))
    return out.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), kept.alias("kept"))
