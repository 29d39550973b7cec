"""Vectorised hashes of the words of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_PLACE = _rng.integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TURN = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffer(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end (nulls: empty), and where each begins (and the last ends)."""
    wide = isinstance(texts, pa.LargeStringArray)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return every[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.StringArray, most_bytes: int = 1 << 20) -> Iterator[tuple[int, pa.StringArray]]:
    """(first row, slice) of a column in slices of at most ``most_bytes``, a longer text being one of its own."""
    sizes = np.r_[0, np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy())] if len(column) else np.zeros(1)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + most_bytes, side="right")) - 1)
        yield lo, column.slice(lo, hi - lo)
        lo = hi


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word (run of non-white-space, A-Z as a-z) and the text it is in."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    black = ~_IS_SPACE[data]
    opens = black.copy()
    opens[1:] &= ~black[:-1]
    heads = starts[:-1][starts[:-1] < n]
    opens[heads] = black[heads]
    at = np.flatnonzero(opens)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = np.flatnonzero(black)
    word = np.cumsum(opens)[inside] - 1
    place = inside - at[word]
    weight = _PLACE[place & 4095]
    if len(place) and place.max() > 4095:
        weight = weight + (place >> 12).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    total = np.add.reduceat(_BYTE[data[inside]] * weight, np.searchsorted(inside, at))
    return mixed(total), np.searchsorted(starts, at, side="right") - 1


def shingles(words: np.ndarray, text: np.ndarray, width: int, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of every ``width`` words in a row of a text, the text, and the sum of the
    words' weights; a text with fewer words has its whole sequence as one shingle."""
    n = len(words)
    weight = np.zeros(n, np.int64) if weight is None else weight
    if not n:
        return words, text, weight
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    count = np.diff(np.r_[first, n])
    m = max(n - width + 1, 0)
    total, sums = np.zeros(m, np.uint64), np.zeros(m, np.int64)
    for j in range(width):
        total += words[j : m + j] * _TURN[j]
        sums += weight[j : m + j]
    whole = text[width - 1 :] == text[:m]
    out, own, heavy = [mixed(total[whole])], [text[:m][whole]], [sums[whole]]
    for f, c in zip(first[count < width], count[count < width], strict=True):
        out.append(mixed((words[f : f + c] * _TURN[32 : 32 + c]).sum(keepdims=True) + _TURN[63 - c]))
        own.append(text[f : f + 1])
        heavy.append(weight[f : f + c].sum(keepdims=True))
    return np.concatenate(out), np.concatenate(own), np.concatenate(heavy)
