"""Operator 4, best-two-fit packing of tokenized documents.

Tokenizing makes one narrow row per piece (ids stay in the task). The pieces are
dealt by hash to groups of about ``GROUP_PIECES`` rows, so a packing task is
bounded whatever the input, and each group is packed by itself: a bin is filled
greedily from the longest piece that still fits; then, if room is left, its
shortest piece is replaced by the two unpacked pieces that fit the widened gap
more tightly, if there are such. At most a few bins per group are not full, a
share of sequences that does not grow with the input.

Token ids come from the ranks file of the same vocabulary as the JSON tokenizer,
which gives the same ids several times faster (tested); the special token's text
is its id, as there.

Defined cases. Null text: an empty text, one piece of the end id alone. Repeated
rows are packed each. Very long texts are cut into pieces of the whole length,
the first being the shorter one. An empty table gives an empty result. Extra
input columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, stored

SEQUENCE = 2048
GROUP_PIECES = 20_000
RANKS_FILE = "byte_bpe_50k.tiktoken"
END_TEXT, END_TEXT_ID = "<|endoftext|>", 50256
SEPARATOR_ID = 0
_encoders: dict = {}


def encoder(ranks_path: str):
    """The encoder of a ranks file, one per process."""
    if ranks_path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[ranks_path] = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_TEXT: END_TEXT_ID})
    return _encoders[ranks_path]


def token_ids(enc, text: str) -> list[int]:
    return enc.encode(text, allowed_special="all") if END_TEXT in text else enc.encode_ordinary(text)


def cuts(n: int, most: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n > 0 ids; the first may be shorter."""
    first = n % most or most
    return [(0, first), *((s, most) for s in range(first, n, most))]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
           most: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc, rk, piece, start, length, ids_crc32."""
    if ranks_path is None:
        import public_tokenizers

        ranks_path = public_tokenizers.path(RANKS_FILE)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc"), row_key(text).alias("rk"), text.alias("t"))
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                at, out = [], defaultdict(list)
                for i, t in enumerate(part.column("t")):
                    ids = np.array([*token_ids(enc, t.as_py()), SEPARATOR_ID], "<u4")
                    for k, (s, n) in enumerate(cuts(len(ids), most)):
                        at.append(i)
                        for name, x in (("piece", k), ("start", s), ("length", n), ("ids_crc32", zlib.crc32(ids[s : s + n].tobytes()))):
                            out[name].append(x)
                own = part.select(["doc", "rk"]).take(pa.array(at, pa.int64()))
                cols = [pa.array(out["piece"], pa.int32()), *(pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32"))]
                yield pa.RecordBatch.from_arrays([*own.columns, *cols], names=["doc", "rk", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(run, f"doc {kind}, rk long, piece int, start long, length long, ids_crc32 long")


class _Pool:
    """Unpacked pieces by length; which lengths are there is kept as the bits of an int."""

    def __init__(self, lengths: Iterable[int]):
        self.at: dict[int, list[int]] = defaultdict(list)
        for i, n in enumerate(lengths):
            self.at[int(n)].append(i)
        self.bits = sum(1 << n for n in self.at)

    def longest(self, most: int) -> int:
        """The greatest length there is up to ``most``, or -1."""
        return (self.bits & ((1 << (most + 1)) - 1)).bit_length() - 1 if most >= 0 else -1

    def take(self, n: int) -> int:
        i = self.at[n].pop()
        if not self.at[n]:
            self.bits ^= 1 << n
        return i

    def give(self, n: int, i: int) -> None:
        self.at[n].append(i)
        self.bits |= 1 << n

    def best_two(self, room: int) -> tuple[int, int] | None:
        """The two lengths with the greatest sum up to ``room``."""
        best, found, a = 0, None, self.longest(room - 1)
        while a > 0 and 2 * a > best:  # a is the longer one
            b = self.longest(min(a, room - a))
            if b == a and len(self.at[a]) < 2:
                b = self.longest(a - 1)
            if b > 0 and a + b > best:
                best, found = a + b, (a, b)
                if best == room:
                    break
            a = self.longest(a - 1)
        return found


def best_two_fit(lengths: list[int], most: int = SEQUENCE) -> list[list[int]]:
    """Bins of indexes of ``lengths``, each summing up to ``most`` at most."""
    pool, bins = _Pool(lengths), []
    while pool.bits:
        own, room = [], most
        while (n := pool.longest(room)) > 0:
            own.append((n, pool.take(n)))
            room -= n
        if room and len(own) > 1:
            n, i = own[-1]  # filled from the longest down: the last is the shortest
            two = pool.best_two(room + n)
            if two and sum(two) > n:
                own[-1:] = [(x, pool.take(x)) for x in two]
                pool.give(n, i)
        bins.append([i for _, i in own])
    return bins


def pack(parts: DataFrame, most: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``parts`` (rows of :func:`pieces`, stored) with sequence_id and offset."""
    groups = -(-max(parts.count(), 1) // group_pieces)
    rows = parts.withColumn("g", F.pmod(F.xxhash64("doc", "rk", "piece", "start"), F.lit(groups)))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc", "rk", "piece"], kind="stable", na_position="first").reset_index(drop=True)
        seq, off = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        lengths = pdf["length"].to_numpy()
        for b, own in enumerate(best_two_fit(lengths.tolist(), most)):
            seq[own] = (int(key[0]) << 32) + b
            off[own] = np.cumsum(lengths[own]) - lengths[own]
        return pdf.drop(columns="g").assign(sequence_id=seq, offset=off)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema) + ", sequence_id long, offset long"
    return rows.groupBy("g").applyInPandas(run, schema)


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
           most: int = SEQUENCE) -> DataFrame:
    return pack(stored(pieces(docs, id_col, text_col, ranks_path, most), "pack-pieces"), most)


def report(docs: DataFrame) -> DataFrame:
    """The digest of query op4."""
    out = packed(docs)
    return out.select(F.col("doc").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
