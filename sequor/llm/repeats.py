"""Operator 10, suffix-array dedup: repeated strings of 200 bytes by external induced sorting.

1. Every window of ``LENGTH`` bytes selects the smallest of its hashed ``GRAM``-byte grams, by content alone: two
   equal windows select the same gram at the same place. The selected grams (about one in 85 bytes)
   are anchors; a repeated window has an anchor whose gram occurs as an anchor again. An anchor's context is the bytes of the
   windows that select it, so that each window lies in one context.
2. Anchors are dealt once, by gram, without any text; those whose gram occurs once are done. Equal contexts are known by
   128 bits of hash: what occurs twice as a whole is repeated as a whole. Of equal ones that a task meets in one piece of
   text, one is dealt by gram, so that a frequent string is no large group.
3. A window of LENGTH bytes around an anchor holds ``SIDE`` bytes before it and its gram, or ``SIDE`` + GRAM bytes from it
   on. So only contexts that share one of these two strings with another context can share a window: all others
   are done, and of one that shares a single side only the bytes that its windows on that side reach are
   needed. One copy of each context that is left goes to shards by gram. A shard is sorted by external induced sorting (:mod:`.induced`), which streams suffixes with their common
   prefixes: neighbours that share LENGTH bytes and lie at different places are repeated.
4. Repeated contexts and the spans found in single ones are merged per document, and cut out.

Sharding by content is what lets shards be sorted apart: both places of a match are in the shard of
each gram they share. A shard above memory is spooled to disk by its sort.

Defined cases. Null or short text: nothing removed. Rows that repeat an id are documents of their own;
rows alike in id and text too. Matches never cross documents. An empty table gives an empty
result. Extra input columns are ignored. Removed bytes may split a character, so what is kept is bytes.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import row_key, stored
from .hashing import chunks, mixed, text_buffer
from .induced import CLAMP, suffixes

LENGTH = 200
GRAM = 32
REACH = LENGTH - GRAM  # how far before an anchor a window that selects it can begin
SIDE = REACH // 2  # a window has so many bytes before its anchor, or so many after its gram
SHARD_BYTES = 4 << 20
_PIECE = 1 << 20
_PLACE_BITS = 28
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
_LAST = np.uint64(2**64 - 1)
_rng = np.random.default_rng(77)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_ODD = _rng.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
assert LENGTH <= CLAMP


def gram_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of all GRAM-byte, 64-byte and 128-byte strings."""
    h, width, k, short, middle = _BYTE[data], 1, 0, None, None
    while width < 128:
        if len(h) <= width:
            h = h[:0]
            break
        h = h[:-width] * _ODD[k] + h[width:]
        h ^= h >> np.uint64(29)
        width, k = 2 * width, k + 1
        if width == GRAM:
            short = h
        if width == 64:
            middle = h
    return (mixed(short) if short is not None else h), (middle if middle is not None else h), h


def window_least(v: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    n = len(v)
    if n < width:
        return v[:0]
    full = np.full(-(-n // width) * width, _LAST)
    full[:n] = v
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places of the anchors of texts that lie end to end (``ends``: where each ends), where the first window that
    selects each begins and the last one ends, the hashes of their grams, and the hashes of all 64-byte and 128-byte strings."""
    short, middle, long = gram_hashes(data)
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, short[:0], middle, long
    v = (short & ~_PLACE) | np.arange(len(short), dtype=np.uint64)
    for e in ends.tolist():  # grams across two texts select nothing
        v[max(e - GRAM + 1, 0) : e] = _LAST
    least = window_least(v, REACH + 1)
    lo = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])  # windows that select the same place are neighbours
    hi = np.r_[lo[1:], len(least)] - 1 + LENGTH
    some = least[lo] != _LAST
    lo, hi = lo[some], hi[some]
    at = (least[lo] & _PLACE).astype(np.int64)
    return at, lo, hi, short[at], middle, long


def context_hashes(long: np.ndarray, lo: np.ndarray, hi: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The hashes of data[lo:hi] (LENGTH to REACH + LENGTH bytes), told apart by the anchor's place in them."""
    size = hi - lo
    h = long[lo] * _ODD[8] + long[lo + (size - 128) // 2] * _ODD[9] + long[hi - 128] * _ODD[10]
    return mixed(h + before.astype(np.uint64) * _ODD[11] + size.astype(np.uint64) * _ODD[12])


def side_hashes(middle: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the SIDE bytes before an anchor with its gram, and of the SIDE + GRAM bytes from it on. Where a
    context has fewer, no window of it holds that string: the context's own hash, which nothing else has, stands for it."""
    width = SIDE + GRAM
    both = []
    for lo, whole, k in ((at - SIDE, before >= SIDE, 13), (at, after >= width, 14)):
        lo = np.where(whole, lo, 0)
        h = mixed(middle[lo] * _ODD[k] + middle[np.where(whole, lo + width - 64, 0)] * _ODD[15]) if len(at) else context
        both.append(np.where(whole, h, context))
    return both[0], both[1]


def _of_batch(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(row, place, gram, context, before, after, left, right) arrays of the anchors of a batch."""
    for first, part in chunks(batch.column("t"), _PIECE):
        data, starts = text_buffer(part)
        if len(part) == 1 and len(data) > 2 * _PIECE:
            yield from _of_long(first, data)
            continue
        at, lo, hi, gram, middle, long = anchors(data, starts[1:])
        row = np.searchsorted(starts, at, side="right") - 1
        before, after = at - np.maximum(lo, starts[row]), np.minimum(hi, starts[row + 1]) - at
        ok = before + after >= LENGTH  # others are selected by windows across two texts alone
        at, gram, row, before, after = (x[ok] for x in (at, gram, row, before, after))
        context = context_hashes(long, at - before, at + after, before)
        yield first + row, at - starts[row], gram, context, before, after, *side_hashes(middle, at, before, after, context)


def _of_long(row: int, data: np.ndarray) -> Iterator[tuple]:
    """The same for one long text, piece by piece."""
    margin = 2 * LENGTH  # holds all windows of the anchors of a piece
    for base in range(0, len(data), _PIECE):
        lo, hi = max(base - margin, 0), min(base + _PIECE + margin, len(data))
        at, first, last, gram, middle, long = anchors(data[lo:hi], np.array([hi - lo]))
        ok = (at + lo >= base) & (at + lo < base + _PIECE)
        at, first, last, gram = (x[ok] for x in (at, first, last, gram))
        before, after = at - first, last - at
        if len(at):
            context = context_hashes(long, first, last, before)
            yield np.full(len(at), row), at + lo, gram, context, before, after, *side_hashes(middle, at, before, after, context)


def dealt(gram: np.ndarray, context: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What to deal anchors by, and how many equal contexts (2: or more) are known by then. The first of equal ones is
    dealt by its gram and stands for the others; these are known to be repeated and are dealt anywhere, by ``seed``."""
    order = np.argsort(context, kind="stable")
    g, c = gram[order], context[order]
    later = np.r_[False, (g[1:] == g[:-1]) & (c[1:] == c[:-1])][: len(order)]
    copies = np.empty(len(order), np.int32)
    copies[order] = 1 + (later | np.r_[later[1:], False][: len(order)])
    fp = gram.copy()
    fp[order[later]] = mixed(seed[order[later]])
    return fp, copies


def find_anchors(rows: DataFrame) -> DataFrame:
    """fp, ctx, doc, rk, pos, before, after, left, right, copies of every anchor of the rows (doc, rk, t). left and right
    are cut to 32 bits, as they only tell contexts of one gram apart that may share bytes; fp and copies as in ``dealt``."""
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, place, gram, context, before, after, left, right in _of_batch(batch):
                own = batch.select(["doc", "rk"]).take(pa.array(row))
                rk = own.column("rk").to_numpy().view(np.uint64)
                gram, copies = dealt(gram, context, rk + place.astype(np.uint64) * _ODD[13] + row.astype(np.uint64) * _ODD[14])
                yield pa.RecordBatch.from_arrays([
                    pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), *own.columns,
                    pa.array(place, pa.int64()), pa.array(before, pa.int16()), pa.array(after, pa.int16()),
                    pa.array(left.astype(np.uint32).view(np.int32)), pa.array(right.astype(np.uint32).view(np.int32)), pa.array(copies)],
                    names=["fp", "ctx", "doc", "rk", "pos", "before", "after", "left", "right", "copies"])

    return rows.mapInArrow(run, f"fp long, ctx long, doc {kind}, rk long, pos long, before short, after short, left int, right int, copies int")


class Shard:
    """The contexts of one shard, as one text on disk; each ends with a separator."""

    def __init__(self):
        self.file, self.size = tempfile.TemporaryFile(), 0
        self.columns: list[list[np.ndarray]] = [[], [], []]  # length, copies, place of the first byte
        self.rows: dict = {}
        self.row: list[int] = []

    def add(self, batch: pa.RecordBatch) -> None:
        data = batch.column("bytes").to_pylist()
        table = bytes((b + 2) & 255 for b in range(256))  # UTF-8 has no byte above 0xF4: 0 and 1 stay free
        joined = b"".join(d.translate(table) + b"\x01" for d in data)
        self.file.write(joined)
        self.size += len(joined)
        got = [np.array([len(d) for d in data], np.int64), *(batch.column(c).to_numpy() for c in ("n", "first"))]
        for own, x in zip(self.columns, got, strict=True):
            own.append(x)
        self.kind = batch.schema.field("doc").type
        for key in zip(batch.column("doc").to_pylist(), batch.column("rk").to_pylist(), strict=True):
            self.row.append(self.rows.setdefault(key, len(self.rows)))

    def spans(self) -> pa.RecordBatch | None:
        """doc, rk, s, e: where repeated bytes lie in the documents of the contexts that occur once."""
        if not self.size:
            return None
        self.file.write(b"\x00" * (1 + CLAMP + 8))
        self.file.flush()
        n = self.size + 1
        text = np.memmap(self.file, np.uint8, "r", shape=(n + CLAMP + 8,))
        length, copies, first = (np.concatenate(c) for c in self.columns)
        starts = np.cumsum(length + 1) - (length + 1)
        row = np.array(self.row, np.int64)
        mark = np.zeros(n, bool)

        def settle(pos: np.ndarray, heads: np.ndarray) -> None:
            """Marks the groups of equal windows (heads: where each begins) that lie at two places at least."""
            own = np.searchsorted(starts, pos, side="right") - 1
            at = (row[own] << 40) + first[own] + pos - starts[own]
            least, most = np.minimum.reduceat(at, heads), np.maximum.reduceat(at, heads)
            many = np.maximum.reduceat(copies[own], heads) > 1
            size = np.diff(np.r_[heads, len(pos)])
            mark[pos[np.repeat((least != most) | many, size)]] = True

        def groups(pos: np.ndarray, joins: np.ndarray) -> None:
            """Settles groups of two and more; ``joins``: shares LENGTH bytes with the tuple before."""
            heads = np.flatnonzero(~joins)
            size = np.diff(np.r_[heads, len(pos)])
            several = np.repeat(size > 1, size)
            if several.any():
                size = size[size > 1]
                settle(pos[several], np.cumsum(size) - size)

        held = np.zeros(0, np.int64)  # the group that the chunks so far end with
        for pos, lcp in suffixes(text, n):
            joins = np.r_[np.arange(len(held)) > 0, lcp >= LENGTH]
            pos = np.r_[held, pos]
            cut = int(np.flatnonzero(~joins)[-1])
            if cut:
                groups(pos[:cut], joins[:cut])
            held = pos[cut:]
        groups(held, np.arange(len(held)) > 0)

        at = np.flatnonzero(mark)
        own = np.searchsorted(starts, at, side="right") - 1
        ok = (copies[own] == 1) & (at - starts[own] + LENGTH <= length[own])
        at, own = at[ok], own[ok]
        if not len(at):
            return None
        heads = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (at[1:] - at[:-1] > LENGTH)])
        tails = np.r_[heads[1:], len(at)] - 1
        own = own[heads]
        place, keys = first[own] - starts[own], list(self.rows)
        doc, rk = zip(*(keys[r] for r in row[own].tolist()), strict=True)
        return pa.RecordBatch.from_arrays([
            pa.array(doc, self.kind), pa.array(rk, pa.int64()), pa.array(at[heads] + place),
            pa.array(at[tails] + place + LENGTH)], names=["doc", "rk", "s", "e"])


def sorted_spans(contexts: DataFrame, shards: int) -> DataFrame:
    """Spans (doc, rk, s, e) found by sorting each shard of contexts (fp, n, doc, rk, first, bytes)."""
    kind = contexts.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for batch in batches:
            if batch.num_rows:
                shard.add(batch)
        got = shard.spans()
        if got is not None:
            yield got

    return contexts.repartition(shards, "fp").mapInArrow(run, f"doc {kind}, rk long, s long, e long")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, rk and spans (array<struct<s,e>> in bytes, neither sorted nor merged) of rows with repeated strings."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc"), row_key(text).alias("rk"), text.alias("t"))
    # every window below keeps to the one exchange by gram
    order = ["doc", "rk", "pos"]
    grams = Window.partitionBy("fp").orderBy("ctx", *order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    alike = Window.partitionBy("fp", "ctx").orderBy(*order)
    again = find_anchors(rows).repartition("fp").withColumn("c", F.sum("copies").over(grams)).filter("c > 1").drop("c")
    again = again.withColumn("n", F.sum("copies").over(alike.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    again = again.withColumn("one", F.row_number().over(alike) == 1)
    for side in ("left", "right"):
        same = Window.partitionBy("fp", side)
        again = again.withColumn(f"by_{side}", F.min("ctx").over(same) < F.max("ctx").over(same)).drop(side)
    # of equal contexts, one copy goes to the sort
    again = again.withColumn("sort", F.expr("one AND (by_left OR by_right)")).filter("n > 1 OR sort").drop("one", "ctx", "copies")
    again = stored(again, "repeats-again")
    whole = again.filter("n > 1").select("doc", "rk", (F.col("pos") - F.col("before")).alias("s"), (F.col("pos") + F.col("after")).alias("e"))

    several = again.filter("sort")
    lead = F.when(F.col("by_left"), F.col("before")).otherwise(F.least(F.col("before").cast("int"), F.lit(SIDE)))
    tail = F.when(F.col("by_right"), F.col("after")).otherwise(F.least(F.col("after").cast("int"), F.lit(SIDE + GRAM)))
    several = several.select("fp", "n", "doc", "rk", (F.col("pos") - lead).alias("first"), (lead + tail).alias("size"))
    shards = max(1, -(-(several.agg(F.sum("size")).first()[0] or 0) // SHARD_BYTES))
    wanted = several.groupBy("doc", "rk").agg(F.collect_list(F.struct("fp", "n", "first", "size")).alias("w"))
    d, w = rows.alias("d"), wanted.alias("w")
    both = d.join(w, F.col("d.doc").eqNullSafe(F.col("w.doc")) & (F.col("d.rk") == F.col("w.rk")))
    both = both.select("d.doc", "d.rk", F.encode("t", "UTF-8").alias("b"), "w.w")
    cut = F.transform("w", lambda x: F.struct(x["fp"].alias("fp"), x["n"].alias("n"), x["first"].alias("first"),
                                              F.substring(F.col("b"), (x["first"] + 1).cast("int"), x["size"].cast("int")).alias("bytes")))
    contexts = both.select("doc", "rk", F.explode(cut).alias("c")).select("doc", "rk", "c.*")
    found = stored(sorted_spans(contexts, shards), "repeats-sorted").unionByName(whole)
    return found.groupBy("doc", "rk").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the spans cover."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, n_bytes, n_removed, n_spans, kept (the remaining bytes) and kept_sha256 of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc"), row_key(text).alias("rk"), text.alias("t")).alias("d")
    s = repeated_spans(docs, id_col, text_col).alias("s")
    both = d.join(s, F.col("d.doc").eqNullSafe(F.col("s.doc")) & (F.col("d.rk") == F.col("s.rk")), "left")
    # arrays of plain numbers, as they reach Python more cheaply than structs
    both = both.select("d.doc", "t", F.transform("spans", lambda x: x["s"]).alias("ss"), F.transform("spans", lambda x: x["e"]).alias("es"))
    kind = d.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                got = []
                for t, ss, es in zip(part.column("t"), part.column("ss"), part.column("es"), strict=True):
                    data = t.as_buffer().to_pybytes() if t.as_buffer() else b""
                    runs = merged(list(zip(ss.as_py(), es.as_py(), strict=True))) if ss.is_valid else []
                    kept = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in runs)], [*(s for s, _ in runs), len(data)], strict=True))
                    got.append((len(data), len(data) - len(kept), len(runs), kept, hashlib.sha256(kept).hexdigest()))
                cols = list(zip(*got, strict=True)) if got else [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                                                 names=["doc", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return both.mapInArrow(run, f"doc {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def report(docs: DataFrame) -> DataFrame:
    """The digest of query op10."""
    out = without_repeats(docs)
    return out.select(F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
