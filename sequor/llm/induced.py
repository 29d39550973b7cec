"""External induced sorting of the suffixes of one shard, with common prefixes.

The order of the suffixes comes from induced sorting: the leftmost S-type (LMS)
suffixes are ordered, then one scan upwards induces all L-type and one scan downwards all
S-type suffixes. The scans' priority queues are keyed by the first symbol; as a scan only
ever inserts at or beyond the symbol it is at, a queue is a first-in-first-out
spool per symbol. Spools hold tuples (position, length of the prefix shared with
the tuple before), keep ``MEMORY`` tuples and put the rest on disk; the text is a
file that is mapped. The common prefix of an induced tuple is one more than the least of those
between the two tuples that induce it and its neighbour, as far as ``CLAMP``.

LMS suffixes are ordered by recursion: LMS substrings are sorted by the same two
scans and named; the string of names, at most half as long, is sorted by the same
routine while it has few symbols (``MOST_SYMBOLS``), and by doubling of ranks
otherwise, up to names that cover CLAMP symbols.

The spools are scratch of the running task, as a sort's spill is: nobody else reads
them, and they end with it.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

CLAMP = 200
MEMORY = 1 << 18
STEP = 1 << 16
MOST_SYMBOLS = 1024
_FAR = 255  # no bound yet


class Spool:
    """A growing list of (position, common prefix); old entries go to an unnamed file."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.kept = self.n = self.filed = 0
        self.files = None

    def append(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.parts.append((pos, lcp))
        self.kept += len(pos)
        self.n += len(pos)
        if self.kept > MEMORY:
            self._settle()
            self.files = self.files or (tempfile.TemporaryFile(), tempfile.TemporaryFile())
            for f, x in zip(self.files, self.parts[0], strict=True):
                f.seek(0, 2)
                f.write(x.tobytes())
            self.filed, self.parts, self.kept = self.n, [], 0

    def _settle(self) -> None:
        if len(self.parts) > 1:
            self.parts = [tuple(np.concatenate(x) for x in zip(*self.parts, strict=True))]

    def read(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        got = []
        if lo < self.filed:
            end = min(hi, self.filed)
            part = []
            for f, kind in zip(self.files, (np.int64, np.uint8), strict=True):
                f.seek(lo * np.dtype(kind).itemsize)
                part.append(np.frombuffer(f.read((end - lo) * np.dtype(kind).itemsize), kind))
            got.append(tuple(part))
        if hi > self.filed:
            self._settle()
            a, b = max(lo - self.filed, 0), hi - self.filed
            got.append((self.parts[0][0][a:b], self.parts[0][1][a:b]))
        return got[0] if len(got) == 1 else tuple(np.concatenate(x) for x in zip(*got, strict=True))


def _range_least(v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(v[lo:hi]) of each pair; _FAR where it is empty."""
    table = [v]
    width = 1
    most = int((hi - lo).max()) if len(lo) else 0
    while 2 * width <= most:
        t = table[-1]
        table.append(np.minimum(t[:-width], t[width:]))
        width *= 2
    out = np.full(len(lo), _FAR, np.uint8)
    size = hi - lo
    level = np.zeros(len(lo), np.int64)
    some = size > 0
    level[some] = np.log2(size[some]).astype(np.int64)
    for k, t in enumerate(table):
        at = some & (level == k)
        if at.any():
            out[at] = np.minimum(t[lo[at]], t[hi[at] - (1 << k)])
    return out


class _Scan:
    """One scan: takes tuples in scan order and induces those before them."""

    def __init__(self, text: np.ndarray, is_s: np.ndarray, symbols: int, want_s: bool):
        self.text, self.is_s, self.want_s = text, is_s, want_s
        self.queues: dict[int, Spool] = {}
        self.least = np.full(symbols, _FAR, np.uint8)  # of the tuples scanned since the last one induced into a queue

    def feed(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        prev = pos - 1
        ok = np.flatnonzero(pos > 0)
        ok = ok[self.is_s[prev[ok]] == self.want_s]
        symbol = self.text[prev[ok]]
        order = np.argsort(symbol, kind="stable")
        at, symbol = ok[order], symbol[order].astype(np.int64)
        all_least = lcp.min() if len(lcp) else _FAR
        if not len(at):
            np.minimum(self.least, all_least, out=self.least)
            return
        heads = np.flatnonzero(np.r_[True, symbol[1:] != symbol[:-1]])
        lo = np.r_[0, at[:-1] + 1]
        lo[heads] = 0
        own = symbol[heads]
        span = _range_least(lcp, lo, at + 1)
        span[heads] = np.minimum(span[heads], self.least[own])
        ends = np.r_[heads[1:], len(at)]
        rest = _range_least(lcp, at[ends - 1] + 1, np.full(len(ends), len(lcp)))
        np.minimum(self.least, all_least, out=self.least)
        self.least[own] = rest
        span = np.minimum(span.astype(np.int64) + 1, CLAMP).astype(np.uint8)
        for s, a, b in zip(own.tolist(), heads.tolist(), ends.tolist(), strict=True):
            q = self.queues.get(s)
            if q is None:
                q = self.queues[s] = Spool()
            if not q.n:
                span[a] = 0  # the first of its symbol
            q.append(prev[at[a:b]], span[a:b])


def types(text: np.ndarray) -> np.ndarray:
    """True for S-type positions (the suffix is less than the next one); the last is S-type."""
    n = len(text)
    up = np.empty(n, bool)
    up[:-1] = text[:-1] < text[1:]
    up[-1] = True
    differ = np.ones(n, bool)
    differ[:-1] = text[:-1] != text[1:]
    at = np.flatnonzero(differ)  # a run of a symbol has the type of its last position
    return np.repeat(up[at], np.diff(np.r_[-1, at]))


def _words(text: np.ndarray) -> np.ndarray:
    """At each position the next 8 bytes as one number (the text is padded by CLAMP + 8)."""
    return np.ndarray((len(text) - 7,), "<u8", buffer=text, strides=(1,))


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of pairs of suffixes of a padded byte text, up to CLAMP."""
    w = _words(text)
    out = np.full(len(a), CLAMP, np.uint8)
    todo = np.arange(len(a))
    for k in range(0, CLAMP, 8):
        x = w[a[todo] + k] ^ w[b[todo] + k]
        off = x != 0
        if off.any():
            low = x[off] & (~x[off] + np.uint64(1))  # its lowest bit
            out[todo[off]] = np.minimum(k + np.log2(low.astype(float)).astype(np.int64) // 8, CLAMP)
            todo = todo[~off]
            if not len(todo):
                break
    return out


def _pieces(spool: Spool, down: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    cuts = range(0, spool.n, STEP)
    for lo in reversed(cuts) if down else cuts:
        yield spool.read(lo, min(lo + STEP, spool.n))


def induce(text: np.ndarray, is_s: np.ndarray, symbols: int, seeds: np.ndarray, seed_lcp: np.ndarray | None,
           n: int) -> tuple[dict[int, Spool], dict[int, Spool]]:
    """The L-type tuples of each symbol in ascending and the S-type ones in descending order,
    from LMS positions in order (by symbol at least) and the common prefixes between them
    (None: not asked for, and those returned mean nothing)."""
    exact = seed_lcp is not None
    seed_lcp = seed_lcp if exact else np.zeros(len(seeds), np.uint8)
    head = text[seeds].astype(np.int64)
    bounds = np.searchsorted(head, np.arange(symbols + 1))
    at = lambda a, b: common_prefix(text, np.array([a]), np.array([b])) if exact else np.zeros(1, np.uint8)
    lows = _Scan(text, is_s, symbols, want_s=False)
    for s in range(symbols):
        queue, lo, hi = lows.queues.get(s), bounds[s], bounds[s + 1]
        last = None
        if queue is not None:
            done = 0
            while done < queue.n:  # grows by its own runs
                stop = min(done + STEP, queue.n)
                pos, lcp = queue.read(done, stop)
                lows.feed(pos, lcp)
                done, last = stop, pos[-1]
        for k in range(lo, hi, STEP):
            pos, lcp = seeds[k : min(k + STEP, hi)], seed_lcp[k : min(k + STEP, hi)].copy()
            if k == lo:
                lcp[0] = 0 if last is None else at(last, pos[0])[0]
            lows.feed(pos, lcp)
    highs = _Scan(text, is_s, symbols, want_s=True)
    for s in range(symbols - 1, -1, -1):
        queue, last = highs.queues.get(s), None
        if queue is not None:
            done = 0
            while done < queue.n:
                stop = min(done + STEP, queue.n)
                pos, lcp = queue.read(done, stop)
                highs.feed(pos, lcp)
                done, last = stop, pos[-1]
        lower = lows.queues.get(s)
        if lower is not None:
            after = 0 if last is None else None  # common prefix with the tuple scanned before
            for pos, lcp in _pieces(lower, down=True):
                down = np.empty(len(pos), np.uint8)
                down[0] = at(last, pos[-1])[0] if after is None else after
                down[1:] = lcp[:0:-1]
                highs.feed(pos[::-1], down)
                after = int(lcp[0])
        if s == text[n - 1]:  # the end of the text is S-type and induced by nothing
            if highs.queues.get(s) is None:
                highs.queues[s] = Spool()
            highs.queues[s].append(np.array([n - 1]), np.zeros(1, np.uint8))
            highs.feed(np.array([n - 1]), np.zeros(1, np.uint8))
    return lows.queues, highs.queues


def _lms(is_s: np.ndarray) -> np.ndarray:
    return np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1


def _names(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The rank of the LMS substring at each LMS position, equal ones alike."""
    n = len(text)
    ends = np.r_[lms[1:] + 1, n]
    size = ends - lms
    hashes = np.zeros((2, len(lms)), np.uint64)
    rng = np.random.default_rng(5)
    weight = rng.integers(0, 2**63, (2, 4096), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for lo in range(0, len(lms), STEP):  # substrings share their ends: gather each
        s, z = lms[lo : lo + STEP], size[lo : lo + STEP]
        first = np.cumsum(z) - z
        inside = np.arange(z.sum()) - np.repeat(first, z)
        value = text[np.repeat(s, z) + inside].astype(np.uint64) + np.uint64(1)
        turn = (inside >> 12).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in (0, 1):
            hashes[k, lo : lo + STEP] = np.add.reduceat(value * (weight[k][inside & 4095] + turn), first)
    index = np.empty(n, np.int64)
    index[lms] = np.arange(len(lms))
    i = index[order]
    new = (hashes[0][i[1:]] != hashes[0][i[:-1]]) | (hashes[1][i[1:]] != hashes[1][i[:-1]]) | (size[i[1:]] != size[i[:-1]])
    rank = np.r_[0, np.cumsum(new)]
    out = np.empty(len(lms), np.int64)
    out[i] = rank
    return out


def _doubled(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a string of names, by its first CLAMP names at least."""
    rank, n, width = names.astype(np.int64), len(names), 1
    while True:
        key = rank * (n + 1)
        key[:-width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        k = key[order]
        fresh = np.r_[0, np.cumsum(k[1:] != k[:-1])]
        width *= 2
        if width >= CLAMP or fresh[-1] == n - 1 or width >= n:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = fresh


def _s_order(queues: dict[int, Spool], keep: np.ndarray, symbols: int) -> np.ndarray:
    """The positions marked in ``keep`` of the S-type tuples, ascending."""
    out = []
    for s in range(symbols):
        if s in queues:
            for pos, _ in _pieces(queues[s], down=True):
                pos = pos[::-1]
                out.append(pos[keep[pos]])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def lms_order(text: np.ndarray, is_s: np.ndarray, symbols: int, n: int) -> np.ndarray:
    """LMS positions in the order of their suffixes (by CLAMP symbols at least). The last
    symbol of the text must be its unique least."""
    lms = _lms(is_s[:n])
    if len(lms) < 2:
        return lms
    rough = lms[np.argsort(text[lms], kind="stable")]
    _, highs = induce(text, is_s, symbols, rough, None, n)
    mark = np.zeros(n, bool)
    mark[lms] = True
    names = _names(text[:n], lms, _s_order(highs, mark, symbols))
    several = int(names.max()) + 1
    if several == len(lms):
        order = np.argsort(names, kind="stable")
    elif several <= MOST_SYMBOLS:
        order = suffix_order(names, several)
    else:
        order = _doubled(names)
    return lms[order]


def suffix_order(text: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes of a text whose last symbol is its unique least, in order."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    is_s = types(text)
    lows, highs = induce(text, is_s, symbols, lms_order(text, is_s, symbols, n), None, n)
    out = []
    for s in range(symbols):
        if s in lows:
            out += [pos for pos, _ in _pieces(lows[s])]
        if s in highs:
            out += [pos[::-1] for pos, _ in _pieces(highs[s], down=True)]
    return np.concatenate(out)


def suffixes(text: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, common prefix with the suffix before, up to CLAMP) in order, by chunks, of a byte
    text of n symbols, the last being its unique least, padded to n + CLAMP + 8."""
    is_s = types(text[:n])
    seeds = lms_order(text, is_s, 256, n)
    lcp = np.zeros(len(seeds), np.uint8)
    for lo in range(1, len(seeds), STEP):
        hi = min(lo + STEP, len(seeds))
        lcp[lo:hi] = common_prefix(text, seeds[lo - 1 : hi - 1], seeds[lo:hi])
    lows, highs = induce(text, is_s, 256, seeds, lcp, n)
    for s in range(256):
        last = None
        if s in lows:
            for pos, lcp in _pieces(lows[s]):
                yield pos, lcp
                last = pos[-1]
        if s in highs:
            # descending tuples hold the common prefix with the one above: shift it by one
            spool = highs[s]
            for hi in range(spool.n, 0, -STEP):
                lo = max(hi - STEP, 0)
                pos, _ = spool.read(lo, hi)
                above = spool.read(lo + 1, min(hi + 1, spool.n))[1] if lo + 1 < spool.n else np.zeros(0, np.uint8)
                lcp = np.zeros(len(pos), np.uint8)
                lcp[: len(above)] = above[: len(pos)]
                if hi == spool.n:
                    lcp[-1] = 0 if last is None else common_prefix(text, np.array([last]), pos[-1:])[0]
                yield pos[::-1], lcp[::-1]
