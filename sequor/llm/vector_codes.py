"""Operator 12, vector code compression: product quantisation on Hilbert-sorted flat blocks.

1. Components become integers floor(1024 x); a vector is cut into four parts. Each part is one
   narrow row with its place on a Hilbert curve through the parts of that position.
2. The rows are range-partitioned and sorted by that place and cut into flat blocks of a fixed
   number of neighbours. A block holds its box (least and greatest value per component), its
   component sums and its integers, and is written once for all rounds.
3. Each round the codebook (of a fixed size) is broadcast. For a block, the distances from an
   entry to the box bound the distances to all its parts from below and above: entries whose
   lower bound is beyond the least upper bound are nearest to no part of it. What remains is the
   block's shortlist. One entry left: the block's stored sums are added as they are. Otherwise a
   small exact integer kernel compares the parts with the shortlist, ascending, so that ties go
   to the lower index. Tasks add up their sums per entry; Spark adds those of the tasks.
4. A last pass gives each part its code and squared distance.

Defined cases. A vector that is null or holds null, NaN or infinite components is dropped. A null
vec_id takes part, is returned and begins no codebook entry while there are other ids for it (nulls
last). Of rows with one vec_id, the smaller vector (component by component) comes first in the
first codebook; rows alike each count and are each returned. Fewer than 256 rows: as many
entries. Vectors of another dimension are quantised by codebooks of their own;
codebooks_sha256 covers all, by dimension. A dimension that four doesn't divide: the first
parts have one component more; an empty vector has code 00000000 and error 0. An
integer beyond +-2^26 (a component beyond +-65536) counts as that, so that sums stay in 64 bits.
An empty table gives an empty result. Extra input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
MOST = 1 << 26
BLOCK = 64
#: Bits of the Hilbert place: more components take fewer bits each.
PLACE_BITS = 60


def cuts(dim: int) -> list[int]:
    """Where the parts of a vector begin (and the last ends)."""
    small, more = divmod(dim, PARTS)
    return [i * small + min(i, more) for i in range(PARTS + 1)]


def hilbert_place(cells: np.ndarray, bits: int) -> np.ndarray:
    """The places on the Hilbert curve of points (rows) with ``bits`` bits per coordinate,
    by exchanging and inverting coordinates from the highest bit down, then Gray coding."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    if not n:
        return np.zeros(len(cells), np.int64)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            on = (x[i] >> b) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= flip
    out = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def shortlist(lo: np.ndarray, hi: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The entries (ascending) that can be nearest to a part within the box lo..hi."""
    below, above = lo - book, book - hi
    near = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(np.abs(below), np.abs(above))
    return np.flatnonzero((near * near).sum(1) <= (far * far).sum(1).min())


def nearest(x: np.ndarray, entries: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For parts x the nearest of ``entries`` (ties: the first) and the squared distance."""
    if len(entries) == 1:
        d = x - book[entries[0]]
        return np.full(len(x), entries[0]), (d * d).sum(1)
    c = book[entries]
    # x.x - 2 x.c + c.c: the first doesn't change which is least
    score = (c * c).sum(1) - 2 * (x @ c.T)
    at = score.argmin(1)
    return entries[at], (x * x).sum(1) + score[np.arange(len(x)), at]


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label, v (integers), dim and rk (hash of v) of the rows that take part."""
    fine = F.col(vector_col).isNotNull() & ~F.exists(
        vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    whole = lambda x: F.floor(F.least(F.greatest(x.cast("double"), F.lit(-float(MOST))), F.lit(float(MOST))) * SCALE)
    held = lambda x: F.least(F.greatest(whole(x), F.lit(-MOST)), F.lit(MOST)).cast("int")
    out = rows.filter(fine).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.transform(vector_col, held).alias("v"))
    return out.select("*", F.size("v").alias("dim"), F.xxhash64("v").alias("rk"))


def first_books(rows: DataFrame) -> dict[int, list[np.ndarray]]:
    """Per dimension the first codebook of each part position: the vectors of the smallest ids. At most ENTRIES rows a dimension."""
    order = Window.partitionBy("dim").orderBy(F.asc_nulls_last("id"), "v")
    some = rows.select("dim", "id", "v").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= ENTRIES)
    books: dict[int, list[list[int]]] = {}
    for r in some.orderBy("dim", "r").collect():
        books.setdefault(r["dim"], []).append(r["v"])
    out = {}
    for dim, vectors in books.items():
        x, at = np.array(vectors, np.int64).reshape(len(vectors), dim), cuts(dim)
        out[dim] = [x[:, at[i]:at[i + 1]].copy() for i in range(PARTS)]
    return out


def blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The flat blocks: dim, part, n, lo, hi, sums (per component), ids, rks, data (int32, little-endian)."""
    span = rows.select("dim", F.explode("v").alias("x")).groupBy("dim").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    spans = {r["dim"]: (r["lo"], r["hi"]) for r in span.collect()}  # a row per dimension

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                x = np.frombuffer(some.column("v").flatten().to_numpy().astype("<i4").tobytes(), "<i4").reshape(some.num_rows, dim)
                lo, hi = spans.get(dim, (0, 0))
                for i, (a, b) in enumerate(zip(cuts(dim), cuts(dim)[1:], strict=False)):
                    used = min(b - a, PLACE_BITS)
                    bits = max(1, min(8, PLACE_BITS // max(used, 1)))
                    cells = ((x[:, a:a + used].astype(np.int64) - lo) << bits) // (hi - lo + 1)
                    yield pa.RecordBatch.from_arrays([
                        some.column("dim"), pa.array(np.full(len(x), i, np.int32)), pa.array(hilbert_place(cells, bits)), some.column("id"), some.column("rk"),
                        pa.array([r.tobytes() for r in np.ascontiguousarray(x[:, a:b])], pa.binary())], names=["dim", "part", "place", "id", "rk", "x"])

    keys = ["dim", "part", "place", "id", "rk"]
    cut = rows.select("dim", "id", "rk", "v").mapInArrow(places, "dim int, part int, place long, id long, rk long, x binary")
    cut = cut.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("dim").to_numpy().astype(np.int64) * PARTS + batch.column("part").to_numpy()
            heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else key
            found: dict[str, list] = {c: [] for c in ("dim", "part", "n", "lo", "hi", "sums", "ids", "rks", "data")}
            for first, end in zip(heads, np.r_[heads[1:], len(key)], strict=True):
                for at in range(first, end, block):
                    some = batch.slice(at, min(block, end - at))
                    data = b"".join(some.column("x").to_pylist())
                    x = np.frombuffer(data, "<i4").reshape(some.num_rows, -1 if data else 0).astype(np.int64)
                    row = (some.column("dim")[0].as_py(), some.column("part")[0].as_py(), len(x), x.min(0).tolist(), x.max(0).tolist(),
                           x.sum(0).tolist(), some.column("id").to_pylist(), some.column("rk").to_pylist(), data)
                    for c, value in zip(found, row, strict=True):
                        found[c].append(value)
            longs = pa.list_(pa.int64())
            kinds = [pa.int32(), pa.int32(), pa.int32(), longs, longs, longs, longs, longs, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(found[c], k) for c, k in zip(found, kinds, strict=True)], names=list(found))

    kinds = "dim int, part int, n int, lo array<long>, hi array<long>, sums array<long>, ids array<long>, rks array<long>, data binary"
    return cut.mapInArrow(flat, kinds)


def _of(row: dict, books: dict[int, list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The codebook of a block and its shortlist."""
    book = books[row["dim"]][row["part"]]
    return book, shortlist(np.array(row["lo"], np.int64), np.array(row["hi"], np.int64), book)


def _parts(row: dict) -> np.ndarray:
    return np.frombuffer(row["data"], "<i4").reshape(row["n"], len(row["lo"])).astype(np.int64)


def one_round(flat: DataFrame, books: dict[int, list[np.ndarray]]) -> dict[int, list[np.ndarray]]:
    """The codebooks after a round: the mean of each entry's parts, rounded down; unused entries stay."""
    shared = flat.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}  # per entry, last column: count
        for batch in batches:
            for row in batch.to_pylist():
                book, entries = _of(row, shared.value)
                total = sums.setdefault((row["dim"], row["part"]), np.zeros((len(book), book.shape[1] + 1), np.int64))
                if len(entries) == 1:
                    total[entries[0]] += np.array([*row["sums"], row["n"]], np.int64)
                else:
                    x = _parts(row)
                    np.add.at(total, nearest(x, entries, book)[0], np.c_[x, np.ones(len(x), np.int64)])
        for (dim, part), total in sums.items():
            used = np.flatnonzero(total[:, -1])
            each = [pa.array(np.full(len(used), k, np.int32)) for k in (dim, part)]
            yield pa.RecordBatch.from_arrays([*each, pa.array(used.astype(np.int32)), pa.array(total[used].tolist(), pa.list_(pa.int64()))],
                                             names=["dim", "part", "entry", "total"])

    got = flat.select("dim", "part", "n", "lo", "hi", "sums", "data").mapInArrow(run, "dim int, part int, entry int, total array<long>")
    widest = max((b.shape[1] for book in books.values() for b in book), default=0) + 1
    got = got.groupBy("dim", "part", "entry").agg(F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(widest)]).alias("total"))
    new = {dim: [b.copy() for b in book] for dim, book in books.items()}
    for r in got.collect():  # ENTRIES rows a part position at most
        book = new[r["dim"]][r["part"]]
        width = book.shape[1]
        book[r["entry"]] = np.array(r["total"][:width], np.int64) // r["total"][width]
    shared.destroy()
    return new


def codes(flat: DataFrame, books: dict[int, list[np.ndarray]]) -> DataFrame:
    """id, rk, dim, part, entry, distance of every part."""
    shared = flat.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                book, entries = _of(row, shared.value)
                entry, distance = nearest(_parts(row), entries, book)
                each = [pa.array(np.full(row["n"], k, np.int32)) for k in (row["dim"], row["part"])]
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(row["rks"], pa.int64()), *each, pa.array(entry.astype(np.int32)),
                                                  pa.array(distance)], names=["id", "rk", "dim", "part", "entry", "distance"])

    kinds = "id long, rk long, dim int, part int, entry int, distance long"
    return flat.select("dim", "part", "n", "lo", "hi", "ids", "rks", "data").mapInArrow(run, kinds)


def digest(books: dict[int, list[np.ndarray]]) -> str:
    """SHA-256 of all components as decimals joined by commas: by dimension, part, entry, position."""
    return hashlib.sha256(",".join(str(x) for dim in sorted(books) for b in books[dim] for x in b.ravel().tolist()).encode()).hexdigest()


def compress(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             rounds: int = ROUNDS, block: int = BLOCK) -> tuple[DataFrame, dict[int, list[np.ndarray]]]:
    """(id, label, code, error of every row that takes part; the codebooks per dimension and part position)."""
    own = stored(usable(rows, id_col, vector_col, label_col), "codes-rows")
    books = first_books(own)
    flat = stored(blocks(own, block), "codes-blocks")
    for _ in range(rounds):
        books = one_round(flat, books)
    of = lambda p, c: F.max(F.when(F.col("part") == p, F.col(c)))
    code = F.concat(*[F.lower(F.lpad(F.hex(of(p, "entry")), 2, "0")) for p in range(PARTS)])
    error = sum((of(p, "distance") for p in range(1, PARTS)), of(0, "distance"))
    # rows alike have the same code
    found = codes(flat, books).groupBy("id", "rk", "dim").agg(code.alias("code"), error.alias("error"))
    found = found.select(F.col("id").alias("f_id"), F.col("rk").alias("f_rk"), F.col("dim").alias("f_dim"), "code", "error")
    same = F.col("id").eqNullSafe(F.col("f_id")) & (F.col("rk") == F.col("f_rk")) & (F.col("dim") == F.col("f_dim"))
    return own.drop("v").join(found, same).select("id", "label", "code", "error"), books


def report(rows: DataFrame) -> DataFrame:
    """The digest of query op12."""
    out, books = compress(rows)
    out = stored(out, "codes-found")
    sums = stored(out.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")
    out = out.join(sums.withColumnRenamed("label", "s_label"), F.col("label").eqNullSafe(F.col("s_label")))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same for vectors of one dimension that four divides, in DuckDB."""
    steps, book = [], "b0"
    for i in range(ROUNDS + 1):
        steps.append(f"""
d{i} AS (SELECT x.r, x.part, b.entry, sum((x.x - b.x) * (x.x - b.x)) AS d FROM x JOIN {book} b USING (part, pos) GROUP BY ALL),
a{i} AS (SELECT r, part, min(d) AS d, arg_min(entry, (d, entry)) AS entry FROM d{i} GROUP BY ALL)""")
        if i < ROUNDS:
            steps.append(f"""
m{i} AS (SELECT part, pos, entry, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x FROM x JOIN a{i} USING (r, part) GROUP BY ALL),
b{i + 1} AS (SELECT part, pos, entry, coalesce(m{i}.x, {book}.x) AS x FROM {book} LEFT JOIN m{i} USING (part, pos, entry))""")
            book = f"b{i + 1}"
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding AS v, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
flat AS (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS place, len(v) // {PARTS} AS width FROM kept),
x AS (SELECT r, place // width AS part, place % width AS pos, floor({SCALE} * x::DOUBLE)::BIGINT AS x FROM flat),
b0 AS (SELECT part, pos, r AS entry, x FROM x WHERE r < {ENTRIES}),{",".join(steps)},
sha AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) AS sha FROM {book}),
found AS (
  SELECT vec_id, label, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM a{ROUNDS} JOIN kept USING (r) GROUP BY r, vec_id, label)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, sha AS codebooks_sha256 FROM found, sha
"""


SQL = _sql()
