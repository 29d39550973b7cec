"""Operator 5, language ID: a byte convolutional network trained in numpy.

Bytes are embedded, convolved with filters of several widths, max-pooled over a
window of fixed length, and mapped by softmax to languages. A text is cut into
such windows from end to end (the last one padded); its prediction is the mean of
the windows' log probabilities, weighted by their bytes.

Training, on the driver: at most ``TRAIN_DOCS`` documents (smallest hashes first) with
up to ``TRAIN_WINDOWS`` evenly spaced windows each. The network has a fixed size and is
broadcast.

Defined cases. Null text or text without a letter: ``und`` with score 1. Null labels are not
learned from. Without any label all are ``und``, with score 0 where the text has letters. Repeated
rows are alike. Extra input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample

WINDOW = 192
EMBED = 6
WIDTHS = (2, 3, 4)
FILTERS = 16
TRAIN_DOCS = 3000
TRAIN_WINDOWS = 5
EPOCHS = 4
BATCH = 128
UNKNOWN = "und"
_WIDEST = max(WIDTHS)


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray  # 257 x EMBED; 256 pads
    conv: np.ndarray  # widest * EMBED x filters, zero beyond a filter's width
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def _patches(self, x: np.ndarray) -> np.ndarray:
        e = self.embed[x]  # n x window x EMBED
        n, length, k = e.shape
        s = e.strides
        shape = (n, length - _WIDEST + 1, _WIDEST * k)
        return np.lib.stride_tricks.as_strided(e, shape, (s[0], s[1], s[2])).reshape(-1, shape[2])

    def pooled(self, x: np.ndarray, where: bool = False):
        p = self._patches(x)
        h = (p @ self.conv).reshape(len(x), -1, self.conv.shape[1])
        top = np.maximum(h.max(axis=1) + self.bias, 0)
        return (top, h.argmax(axis=1), p) if where else top

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        z = self.pooled(x) @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def windows(data: bytes) -> np.ndarray:
    """All windows of a text, the last padded with 256; one row at least."""
    n = max(1, -(-len(data) // WINDOW))
    x = np.full(n * WINDOW, 256, np.int16)
    x[: len(data)] = np.frombuffer(data, np.uint8)
    return x.reshape(n, WINDOW)


def fit(texts: list[bytes], langs: list[str], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Trains by Adam on cross entropy."""
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    xs, ys = [], []
    for t, lang in zip(texts, langs, strict=True):
        w = windows(t)
        some = w[np.unique(np.linspace(0, len(w) - 1, TRAIN_WINDOWS).astype(int))]
        xs.append(some)
        ys += [names.index(lang)] * len(some)
    x, y = (np.concatenate(xs) if xs else np.zeros((0, WINDOW), np.int16)), np.array(ys, int)
    f = FILTERS * len(WIDTHS)
    mask = np.zeros((_WIDEST, EMBED, f), np.float32)
    for i, w in enumerate(WIDTHS):
        mask[:w, :, i * FILTERS : (i + 1) * FILTERS] = 1
    mask = mask.reshape(-1, f)
    draw = lambda *s, by: (rng.normal(size=s) * by).astype(np.float32)
    net = Network(names, draw(257, EMBED, by=0.5), draw(_WIDEST * EMBED, f, by=0.25) * mask, np.zeros(f, np.float32),
                  draw(f, max(len(names), 1), by=0.2), np.zeros(max(len(names), 1), np.float32))
    params = [net.embed, net.conv, net.bias, net.out, net.out_bias]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        rate = 0.01 * (1 - epoch / (epochs + 1))
        for lo in range(0, len(x), BATCH):
            at = order[lo : lo + BATCH]
            xb, yb = x[at], y[at]
            top, arg, patch = net.pooled(xb, where=True)
            z = top @ net.out + net.out_bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(at)), yb] -= 1
            p /= len(at)
            d_top = (p @ net.out.T) * (top > 0)  # n x f
            rows = np.arange(len(at))[:, None] * (WINDOW - _WIDEST + 1) + arg  # the patch each filter took
            taken = patch[rows]  # n x f x widest * EMBED
            d_conv = np.einsum("nfk,nf->kf", taken, d_top) * mask
            d_patch = d_top[:, :, None] * net.conv.T[None]  # n x f x widest * EMBED
            d_embed = np.zeros_like(net.embed)
            for j in range(_WIDEST):
                byte = np.take_along_axis(xb, arg + j, axis=1)
                np.add.at(d_embed, byte.ravel(), d_patch[:, :, j * EMBED : (j + 1) * EMBED].reshape(-1, EMBED))
            t += 1
            for i, g in enumerate((d_embed, d_conv, d_top.sum(axis=0), top.T @ p, p.sum(axis=0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                params[i] -= (rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = TRAIN_DOCS) -> Network:
    """Fits on at most ``most`` labelled documents."""
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("t"), F.col(lang_col).alias("y")).dropna()
    some = bounded_sample(rows, "doc", most)
    step = F.greatest(F.lit(1), F.floor((F.octet_length("t") - WINDOW) / (TRAIN_WINDOWS - 1)))
    parts = F.array(*[F.substring(F.encode("t", "UTF-8"), (step * i + 1).cast("int"), F.lit(WINDOW)) for i in range(TRAIN_WINDOWS)])
    got = rows.join(F.broadcast(some), "doc").select("doc", "y", F.array_distinct(parts).alias("parts"))
    got = got.orderBy("doc", "y", F.xxhash64("parts")).toPandas()
    pairs = [(p, y) for ps, y in zip(got["parts"], got["y"], strict=True) for p in ps if len(p)]
    return fit([bytes(p) for p, _ in pairs], [y for _, y in pairs])


def predictions(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, lang_pred and score of every row."""
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kind = rows.schema["doc"].dataType.simpleString()

    def judged(net: Network, texts: list[str]) -> list[tuple[str, float]]:
        out: list = [None] * len(texts)
        todo, group, held = [], [], 0
        for i, t in enumerate(texts):
            if not any(ch.isalpha() for ch in t):
                out[i] = (UNKNOWN, 1.0)
            elif not net.langs:
                out[i] = (UNKNOWN, 0.0)
            else:
                todo.append(i)
        sums = {i: np.zeros(len(net.langs)) for i in todo}
        sizes = {i: len(texts[i].encode()) for i in todo}

        def flush() -> None:
            if not group:
                return
            x = np.concatenate([w for _, w in group])
            logs = net.log_probs(x) * ((x < 256).sum(axis=1, keepdims=True))
            lo = 0
            for i, w in group:
                sums[i] += logs[lo : lo + len(w)].sum(axis=0)
                lo += len(w)
            group.clear()

        for i in todo:
            w = windows(texts[i].encode())
            for lo in range(0, len(w), 64):  # bounded batches, whatever a text's length
                group.append((i, w[lo : lo + 64]))
                held += len(group[-1][1])
                if held >= 64:
                    flush()
                    held = 0
        flush()
        for i in todo:
            mean = sums[i] / sizes[i]
            p = np.exp(mean - mean.max())
            k = int(p.argmax())
            out[i] = (net.langs[k], float(p[k] / p.sum()))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                langs, score = zip(*judged(net, part.column("t").to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                                                 names=["doc", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc {kind}, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def report(docs: DataFrame) -> DataFrame:
    """The digest of query op5: learns from rows that are not held out, predicts all."""
    net = train(docs.filter(~held_out()))
    return predictions(docs, net).select(F.col("doc").alias("doc_id"), held_out("doc").alias("held_out"), "lang_pred", "score")
