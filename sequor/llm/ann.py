"""Operator 6, approximate nearest neighbours: adaptive dimension scan over probed lists.

An inverted file for each dimension: k-means centroids, fitted with a random rotation on a bounded sample
(``FIT_ROWS`` over all dimensions), split all vectors into lists; every row is indexed. A dimension so rare that the
sample holds none of it is one list. A query probes the nearest lists of its own dimension. Within a list the rotated vectors are scanned in blocks of columns: after each block
a hypothesis test compares the partial distance, scaled up to all columns, with the
fifth-best distance so far, and abandons the candidate when its true distance is
almost surely larger (a rotation makes partial distances concentrate). Survivors get
their exact cosine from the original vectors.

Lists are cut into blocks of about ``BLOCK_ROWS`` rows and queries into blocks of the
same size, so the work of a task is bounded when a list is hot (a vector with very
many copies, say). The fitted parameters have a fixed size and are broadcast.

Defined cases. Vectors that are null, zero, or holding null or non-finite components take no part; nor do rows
with a null id. A cosine needs equal dimensions, so candidates are the vectors of the query's own. Of rows that repeat an id the smallest vector counts. Ties go to the smaller id. Fewer
than k candidates: all of them. An empty table gives an empty result. Extra input columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, stored

FIT_ROWS = 20_000
MOST_LISTS = 4096
PROBE_SHARE = 0.7
LEAST_PROBES = 8
COLUMNS = 16
EPSILON = 2.1
BLOCK_ROWS = 4096
K = 5
_STEP = 512  # candidates scanned before the bound is taken anew


@dataclass
class Index:
    rotation: np.ndarray
    centroids: np.ndarray
    first: int  # the number of its first list; lists of all dimensions are numbered on
    sizes: np.ndarray | None = None

    def directions(self, x: np.ndarray) -> np.ndarray:
        """Rotated unit vectors."""
        scale = np.abs(x).max(axis=1, keepdims=True)
        x = x / scale
        return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))) @ self.rotation

    def nearness(self, u: np.ndarray) -> np.ndarray:
        """Squared distances to the centroids, but for a constant of the row."""
        return (self.centroids**2).sum(axis=1) - 2 * u @ self.centroids.T

    def probes(self, u: np.ndarray, share: float, least: int, k: int) -> list[np.ndarray]:
        """Lists of each vector, nearest first: enough for the share of lists and for 16 k candidates."""
        order = np.argsort(self.nearness(u), axis=1, kind="stable")
        most = max(least, int(np.ceil(share * len(self.centroids))))
        full = np.cumsum(self.sizes[order], axis=1)
        return [o[: max(most, int(np.searchsorted(f, 16 * k + 1)) + 1)] for o, f in zip(order, full, strict=True)]


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id and v (array<double>) of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.filter(~bad & F.exists("v", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def fit(rows: DataFrame, n_rows: int, most: int = FIT_ROWS, seed: int = 11) -> dict[int, Index]:
    """An index for each dimension among at most ``most`` vectors."""
    some = bounded_sample(rows, "id", most)
    got = rows.join(F.broadcast(some), "id").orderBy("id").select("v").toPandas()["v"]
    kinds: dict[int, list] = {}
    for v in got:
        kinds.setdefault(len(v), []).append(np.asarray(v))
    fitted, first = {}, 0
    for dim in sorted(kinds):
        fitted[dim] = _fitted(np.array(kinds[dim]), n_rows * len(kinds[dim]) // len(got), first, seed)
        first += len(fitted[dim].centroids)
    return fitted


def _fitted(x: np.ndarray, n_rows: int, first: int, seed: int) -> Index:
    """Rotation and centroids from sampled vectors of one dimension that has about ``n_rows``."""
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
    index = Index(rotation, np.zeros((1, x.shape[1])), first)
    u = np.unique(index.directions(x).round(12), axis=0)  # copies would pull centroids together
    u = u[rng.permutation(len(u))]
    lists = max(1, min(MOST_LISTS, int(np.sqrt(n_rows)), len(u) // 8))
    index.centroids = u[:lists].copy()
    for _ in range(8):
        near = np.concatenate([index.nearness(u[lo : lo + 4096]).argmin(axis=1) for lo in range(0, len(u), 4096)])
        count = np.bincount(near, minlength=lists)
        for j in range(u.shape[1]):
            total = np.bincount(near, weights=u[:, j], minlength=lists)
            index.centroids[:, j] = np.where(count > 0, total / np.maximum(count, 1), index.centroids[:, j])
    return index


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """dimension, rows and their vectors as a matrix, for each dimension in a batch of (id, v)."""
    size = batch.column("v").value_lengths().to_numpy()
    for dim in np.unique(size).tolist():
        part = batch if (size == dim).all() else batch.take(pa.array(np.flatnonzero(size == dim)))
        yield dim, part, part.column("v").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


def _index_of(fitted: dict[int, Index], dim: int) -> Index:
    """The index of a dimension; one list, numbered below zero, if none was fitted."""
    return fitted.get(dim) or Index(np.eye(dim), np.zeros((1, dim)), -dim, np.zeros(1))


def exact_cosine(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of rows with one vector; equal rows give equal values."""
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def adaptive_scan(u: np.ndarray, q: np.ndarray, bound: float, columns: int = COLUMNS, epsilon: float = EPSILON) -> np.ndarray:
    """Indexes of the rows of ``u`` that no test abandoned at the bound (a squared distance)."""
    dim = u.shape[1]
    alive, partial = np.arange(len(u)), np.zeros(len(u))
    for lo in range(0, dim, columns):
        hi = min(dim, lo + columns)
        d = u[alive, lo:hi] - q[lo:hi]
        partial = partial + (d * d).sum(axis=1)
        slack = (1 + epsilon / np.sqrt(hi)) ** 2 if hi < dim else 1 + 1e-9
        near = partial * (dim / hi) <= bound * slack
        alive, partial = alive[near], partial[near]
    return alive


def search_block(index: Index, ids: np.ndarray, x: np.ndarray, qids: np.ndarray, qx: np.ndarray, k: int = K) -> list[tuple]:
    """(query, id, score) of each query's k nearest among the survivors of a block."""
    u, qu = index.directions(x), index.directions(qx)
    out = []
    for q, qv, qd in zip(qids, qx, qu, strict=True):
        best_id, best = np.zeros(0, ids.dtype), np.zeros(0)
        bound = np.inf
        for lo in range(0, len(u), _STEP):
            at = lo + adaptive_scan(u[lo : lo + _STEP], qd, bound)
            at = at[ids[at] != q]
            best_id, best = np.r_[best_id, ids[at]], np.r_[best, exact_cosine(x[at], qv)]
            order = np.lexsort((best_id, -best))[:k]
            best_id, best = best_id[order], best[order]
            if len(best) == k:
                bound = 2 - 2 * best[-1] + 1e-9
        out += zip([q] * len(best), best_id, best, strict=True)
    return out


def search(vectors: DataFrame, query_filter, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
           share: float = PROBE_SHARE, least: int = LEAST_PROBES) -> DataFrame:
    """query, rank, id and score: the k nearest found of each row that ``query_filter`` (a
    Column over the column ``id``) selects, among all other rows."""
    rows = stored(usable(vectors, id_col, vec_col), "ann-rows")
    n = rows.count()
    indexes = fit(rows, n)
    sc = rows.sparkSession.sparkContext
    kind = rows.schema["id"].dataType.simpleString()
    fitted = sc.broadcast(indexes)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part, x in _by_dimension(batch):
                index = _index_of(fitted.value, dim)
                lists = index.nearness(index.directions(x)).argmin(axis=1) + index.first
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.int32())], names=["id", "v", "list"])

    listed = stored(rows.mapInArrow(assign, f"id {kind}, v array<double>, list int"), "ann-lists")
    counts = {r["list"]: r["count"] for r in listed.filter("list >= 0").groupBy("list").count().collect()}  # one row per fitted list
    for index in indexes.values():
        index.sizes = np.array([counts.get(index.first + i, 0) for i in range(len(index.centroids))])
    probing = sc.broadcast(indexes)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part, x in _by_dimension(batch):
                index = _index_of(probing.value, dim)
                lists = index.probes(index.directions(x), share, least, k)
                own = part.select(["id", "v"]).take(pa.array(np.repeat(np.arange(part.num_rows), [len(x) for x in lists])))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(np.concatenate(lists) + index.first, pa.int32())], names=["id", "v", "list"])

    queries = rows.filter(query_filter)
    q_blocks = -(-max(queries.count(), 1) // BLOCK_ROWS)
    asked = queries.mapInArrow(probe, f"id {kind}, v array<double>, list int")
    blocks = F.create_map(*[x for i, c in counts.items() for x in (F.lit(i), F.lit(-(-c // BLOCK_ROWS)))]) if counts else F.create_map(F.lit(0), F.lit(1))
    asked = asked.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(q_blocks)).cast("int"))
    asked = asked.withColumn("b", F.explode(F.sequence(F.lit(0), F.coalesce(F.element_at(blocks, F.col("list")), F.lit(1)) - 1)))
    held = listed.withColumn("b", F.pmod(F.xxhash64("id"), F.coalesce(F.element_at(blocks, F.col("list")), F.lit(1))).cast("int"))
    held = held.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))

    def scan(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query": [], "id": [], "score": []})
        left = left.sort_values("id")
        x = np.stack(left["v"]).astype(float)
        index = _index_of(probing.value, x.shape[1])
        got = search_block(index, left["id"].to_numpy(), x, right["id"].to_numpy(), np.stack(right["v"]).astype(float), k)
        return pd.DataFrame(got, columns=["query", "id", "score"])

    keys = ["list", "b", "qb"]
    near = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(scan, f"query {kind}, id {kind}, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query", "rank", "id", "score")


def report(vectors: DataFrame) -> DataFrame:
    """The digest of query op6."""
    out = search(vectors, F.col("id") % 50 == 0)
    return out.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
