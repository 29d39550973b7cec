"""Operator 1, toxicity: a subsequence string-kernel SVM with Nystroem landmarks.

The kernel compares two units (words) by the gapped subsequences of three characters
they share, each weighted by DECAY to the length it spans, spans of up to SPAN
characters: characters put in between only cost some decay. Marks inside a word are
dropped and runs of single letters are joined first, so spelled-out words are units too.

Training, on the driver, takes a bounded sample of labelled texts (``TRAIN_DOCS``,
half of each label, smallest hashes first), each a bag of its words: a clean text
holds only clean words, a toxic one at least one toxic word. Landmarks are the words
that speak most for the toxic label and frequent clean ones. A squared-hinge SVM is
fitted on the Nystroem features: positive are words that many different toxic
bags hold and, chosen anew in turns, the strongest word of each bag without one; and a logistic curve maps the strongest margin of a text to its score.

Scoring: a decision function that is a sum of kernel values with landmarks is linear
in the subsequences, so it collapses into one weight per triple of characters (a table
of fixed size that is broadcast). Texts are scored whole and vectorised, in batches.

Defined cases. Null or empty text: the score of no word, near 0. Labels that are null
or without a document are not used; of repeated labels of an id the largest counts.
Without labels of both kinds every score is 0. Repeated rows score alike. Extra input
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, words_array

DECAY = 0.6
SPAN = 5
TRAIN_DOCS = 3000
LANDMARKS = 160
ROUNDS = 5
THRESHOLD = 0.7
_A = 60  # classes of characters: a-z, 32 of bytes beyond ASCII, digits


def _classes() -> np.ndarray:
    """Class of each byte: 0 parts words, 255 is dropped."""
    t = np.full(256, 255, np.uint8)
    t[[9, 10, 11, 12, 13, 32]] = 0
    for b in range(26):
        t[97 + b] = t[65 + b] = 1 + b
    t[128:] = 27 + (np.arange(128, 256) & 31)
    t[48:58] = 59
    return t


_CLASS = _classes()


def units(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the characters kept, and the unit (from 0) that each belongs to."""
    c = _CLASS[np.frombuffer(data, np.uint8)]
    c = c[c != 255]
    inside = c != 0
    word = np.cumsum(~inside)[inside]  # words by the spaces before them
    c = c[inside]
    if not len(c):
        return c, word
    starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    single = np.diff(np.r_[starts, len(c)]) == 1
    joined = np.r_[False, single[1:] & single[:-1]]  # a single letter after a single letter
    first = np.zeros(len(c), np.int64)
    first[starts] = ~joined
    return c, np.cumsum(first) - 1


def triples(c: np.ndarray, unit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each shape of gaps: positions of the first character, code of the triple, weight."""
    c = c.astype(np.int32)
    for g in range(1, SPAN - 1):
        pair = c[:-g] * _A + c[g:] if len(c) > g else c[:0]
        for h in range(1, SPAN - g):
            if len(c) <= g + h:
                continue
            at = np.flatnonzero(unit[g + h :] == unit[: -g - h])
            yield at, pair[at] * _A + c[at + g + h], DECAY ** (g + h + 1)


@dataclass
class Model:
    weight: np.ndarray  # of each triple of classes
    bias: float
    slope: float
    shift: float

    def margins(self, data: bytes) -> np.ndarray:
        """The SVM's margin of every unit of a text."""
        c, unit = units(data)
        if not len(c):
            return np.zeros(0)
        total = np.zeros(len(c), np.float32)
        for at, code, w in triples(c, unit):
            total[at] += self.weight[code] * np.float32(w)
        starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        size = np.diff(np.r_[starts, len(c)])
        return np.add.reduceat(total, starts) / _norm(size) + self.bias

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -60, 60)))


def _norm(size: np.ndarray) -> np.ndarray:
    """Length of a unit's vector of subsequences (if none of them repeats in it): it depends on its size alone."""
    size = np.asarray(size, float)
    shapes = [g + h for g in range(1, SPAN - 1) for h in range(1, SPAN - g)]
    square = sum(np.maximum(size - s, 0) * DECAY ** (2 * (s + 1)) for s in shapes)
    return np.sqrt(np.where(square > 0, square, 1.0))


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """word index, triple code and normalised weight of every subsequence of some words."""
    c, unit = units("\n".join(words).encode())
    size = np.bincount(unit, minlength=len(words))
    got = [(unit[at], code, np.full(len(at), w)) for at, code, w in triples(c, unit)]
    u, code, w = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*got, strict=True)) if got else (np.zeros(0, np.int64),) * 3
    order = np.argsort(u, kind="stable")
    return u[order], code[order], (w / _norm(size[u]))[order] if len(u) else w


def _plain(word: str) -> str:
    """The word as its unit sees it (empty if it has fewer than three characters)."""
    kept = "".join(ch for ch in word.lower() if not ch.isascii() or ch.isalnum())
    return kept if len(kept) >= 3 else ""


def _hinge(x: np.ndarray, rows: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Squared-hinge linear SVM on some rows of x, by Newton steps on those within the margin; the
    last coefficient is the bias. Sums are taken in chunks, so that no second copy of x is held."""
    k = x.shape[1] + 1
    w = np.zeros(k)
    reg = np.full(k, ridge)
    reg[-1] = 1e-6
    for _ in range(20):
        square, right = np.diag(reg), np.zeros(k)
        for lo in range(0, len(rows), 8192):
            part = x[rows[lo : lo + 8192]].astype(float)
            part = np.c_[part, np.ones(len(part))]
            t, c = y[lo : lo + 8192], weight[lo : lo + 8192]
            on = t * (part @ w) < 1
            part, t = part[on] * np.sqrt(c[on, None]), t[on] * np.sqrt(c[on])
            square += part.T @ part
            right += part.T @ t
        new = np.linalg.solve(square, right)
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def fit(bags: list[tuple[int, list[str]]], landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> Model:
    """A model from (label, distinct words) of each text."""
    bags = [(int(y), sorted({p for w in words if (p := _plain(w))})) for y, words in bags]
    none = Model(np.zeros(_A**3, np.float32), 0.0, 0.0, -60.0)
    n1 = sum(y for y, _ in bags)
    n0 = len(bags) - n1
    if not n1 or not n0:
        return none
    df = [Counter(), Counter()]
    for y, words in bags:
        df[y].update(words)
    vocab = sorted(df[0].keys() | df[1].keys())
    number = {w: i for i, w in enumerate(vocab)}
    odds = np.array([np.log((df[1][w] + 0.1) / (n1 + 0.2)) - np.log((df[0][w] + 0.1) / (n0 + 0.2)) for w in vocab])
    # rare words speak for a label by chance: shrink by how often they were seen
    seen = np.array([df[1][w] + df[0][w] for w in vocab], float)
    proof = odds * (1 - np.exp(-seen / 3))
    bad = np.argsort(-proof, kind="stable")[: landmarks * 3 // 4]
    common = np.argsort(-(seen * (odds < 0.5)), kind="stable")[: landmarks - len(bad)]
    marks = [vocab[i] for i in dict.fromkeys([*bad, *common])]

    zu, zc, zw = _features(marks)
    codes, zi = np.unique(zc, return_inverse=True)
    z = np.zeros((len(codes), len(marks)), np.float32)
    np.add.at(z, (zi, zu), zw)
    values, vectors = np.linalg.eigh((z.T @ z).astype(float))
    keep = values > 1e-6 * values.max()
    root = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)  # K_mm^(-1/2)

    x = np.zeros((len(vocab), root.shape[1]), np.float32)
    for lo in range(0, len(vocab), 2048):
        u, c, w = _features(vocab[lo : lo + 2048])
        at = np.minimum(np.searchsorted(codes, c), len(codes) - 1)
        hit = codes[at] == c
        u, at, w = u[hit], at[hit], w[hit]
        if len(u):
            first = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
            x[lo + u[first]] = np.add.reduceat(z[at] * w[:, None].astype(np.float32), first) @ root

    clean = np.unique([number[w] for y, words in bags if not y for w in words])
    toxic = [np.array([number[w] for w in words]) for y, words in bags if y and words]
    every = [np.array([number[w] for w in words]) for _, words in bags]
    spoken = _spoken(toxic, odds, [df[1][w] for w in vocab], n1 / len(bags))
    marked = np.array(sorted(spoken), int)
    rest = [b for b in toxic if not np.isin(b, marked).any()]
    margin = proof
    for _ in range(rounds):
        witness = Counter(int(b[np.argmax(margin[b])]) for b in rest)
        ids = np.array(sorted(witness | spoken))
        ids = ids[~np.isin(ids, clean)] if (~np.isin(ids, clean)).any() else ids
        much = np.array([witness[i] + spoken.get(i, 0) for i in ids], float)
        rows = np.r_[ids, clean]
        y = np.r_[np.ones(len(ids)), -np.ones(len(clean))]
        weight = np.r_[3 * much, np.ones(len(clean))]
        w = _hinge(x, rows, y, weight)
        new = x @ w[:-1].astype(np.float32) + w[-1]
        done = np.allclose(new, margin)
        margin = new
        if done:
            break

    alpha = root.astype(float) @ w[:-1]
    weight = np.zeros(_A**3, np.float32)
    weight[codes] = z @ alpha
    top = np.array([margin[b].max() if len(b) else w[-1] for b in every])
    slope, shift = _logistic(top, np.array([y for y, _ in bags], float))
    return Model(weight, float(w[-1]), slope, shift)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(y = 1 | x), both labels weighing the same, slightly shrunk."""
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    a = np.array([1.0, 0.0])
    rows = np.c_[x, np.ones(len(x))]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ a, -30, 30)))
        grad = rows.T @ (weight * (p - y)) + np.array([0.05, 0.0]) * a
        hess = (rows * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ rows + np.diag([0.05, 1e-9])
        step = np.linalg.solve(hess, grad)
        a = a - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(a[0]), float(a[1])


def _spoken(toxic: list[np.ndarray], odds: np.ndarray, df: list[int], share: float) -> Counter:
    """Words that speak clearly for the toxic label, with the bags that hold them: in more
    toxic bags than chance gives any word of the vocabulary (``share`` of all bags being
    toxic), and those bags are different texts, not copies of one."""
    least = max(3, int(np.ceil(np.log(len(odds)) / -np.log(share))))
    holds: dict[int, list[int]] = {}
    for k, b in enumerate(toxic):
        for i in b:
            if odds[i] > 2.5 and df[i] >= least:
                holds.setdefault(int(i), []).append(k)
    taken: Counter = Counter()
    for i, own in holds.items():
        sets = [toxic[k] for k in own]
        alike = [len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for a, b in zip(sets, sets[1:], strict=False)]
        if np.median(alike) < 0.5:
            taken[i] = len(own)
    return taken


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          most: int = TRAIN_DOCS) -> Model:
    """Fits on at most ``most`` of the labelled documents, half of each label."""
    marked = labels.select(F.col(id_col).alias("doc"), F.col(label_col).alias("y")).dropna().groupBy("doc").agg(F.max("y").alias("y"))
    bags = []
    for y in (0, 1):
        some = bounded_sample(marked.filter(F.col("y") == y), "doc", most // 2)
        words = F.array_distinct(words_array(F.coalesce(F.col(text_col), F.lit(""))))
        rows = docs.select(F.col(id_col).alias("doc"), words.alias("words")).join(F.broadcast(some), "doc")
        got = rows.orderBy("doc", F.xxhash64("words")).select("words").toArrow().column("words")
        names: dict[str, str] = {}  # one string object for each word, however many texts hold it
        bags += [(y, [names.setdefault(w, w) for w in x.as_py()]) for x in got]
    return fit(bags)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[Column, ...] = ()) -> DataFrame:
    """doc, score (0 to 1) and the columns ``keep`` of every row."""
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("t"), *keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in rows.columns if c != "t"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            top = []
            for t in batch.column("t"):
                m = model.margins(t.as_buffer().to_pybytes() if t.is_valid else b"")
                top.append(m.max() if len(m) else model.bias)
            score = model.score(np.array(top, float))
            yield pa.RecordBatch.from_arrays([*batch.select(others).columns, pa.array(score, pa.float64())], names=[*others, "score"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others)
    return rows.mapInArrow(run, f"{schema}, score double")


def clean(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, as they were."""
    kept = scores(docs, model, id_col, text_col, keep=(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),))
    return kept.filter(F.col("score") < threshold).select("_row.*")


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest of query op1: learns from rows that are not held out, scores all."""
    model = train(docs, labels.filter(~held_out()))
    out = scores(docs, model)
    return out.select(F.col("doc").alias("doc_id"), F.coalesce(F.crc32(F.col("doc").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
