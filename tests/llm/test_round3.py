"""Operators 11 to 13 against brute force, on small awkward tables."""

import collections
import hashlib
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from sequor.llm import audit, odd_sketch, vector_codes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n int, c long, comp long, key string, t string"


def _same(got, expected):
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, expected))


# --- odd sketches ---------------------------------------------------------------


def _near_texts():
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefghijklm"), 5)) for _ in range(900)]
    say = lambda n: list(rng.choice(words, n))
    texts = [None, "", " \n\t", "one", "ONE", "one two three", "x" * 5000, "é " * 900]
    for size in (12, 40, 150, 600):  # chains and clusters about the threshold
        base = say(size)
        texts += [" ".join(base), " ".join(base).upper()]
        for _ in range(12):
            w = list(base)
            for _ in range(int(rng.integers(1, 3 + size // 40))):
                w[int(rng.integers(0, len(w)))] = str(rng.choice(words))
            texts.append(" ".join(w))
    texts += [" ".join(say(30)) for _ in range(10)]
    texts.append(" ".join(say(60_000)))
    return texts


def _shingles(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set()


def _components(rows, width, percent):
    """Per row (id, set size, least linked id) by comparing all pairs."""
    sets = [(d, _shingles(t, width)) for d, t in rows]
    up = {d: d for d, _ in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    for i, (a, s) in enumerate(sets):
        for b, u in sets[:i]:
            if None not in (a, b) and s and u and 100 * len(s & u) >= percent * len(s | u):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return [(d, len(s), root(d) if d is not None else None) for d, s in sets]


@pytest.fixture(scope="module")
def near_docs(spark):
    rows = [(i * 3 % 101, t, "en", "s", 1, 2, 3, "k", "t") for i, t in enumerate(_near_texts())]
    rows += [rows[9], rows[9], (None, rows[9][1], "en", "s", 1, 2, 3, "k", "t")]  # a row three times, and without an id
    rows += [(500, rows[8][1], *rows[8][2:]), (500, rows[24][1], *rows[24][2:])]  # an id with two texts joins their groups
    return spark.createDataFrame(rows, DOCS).repartition(4)


def test_odd_sketch_equals_brute_force(spark, near_docs):
    rows = [(r["doc_id"], r["text"]) for r in near_docs.collect()]
    expected = [(d, n, c, d is None or c == d) for d, n, c in _components(rows, 4, 80)]
    assert sum(1 for e in expected if not e[3]) > 20
    _same(odd_sketch.report(near_docs).collect(), expected)
    out = odd_sketch.deduplicated(near_docs, width=4)
    assert out.columns == near_docs.columns
    assert sorted(r["doc_id"] for r in out.filter("doc_id is not null").collect()) == sorted(e[0] for e in expected if e[3] and e[0] is not None)
    assert odd_sketch.report(near_docs.limit(0)).count() == 0


def test_odd_sketch_in_blocks(monkeypatch, near_docs):
    """Buckets above the bound of a task are cut into blocks; nothing changes."""
    expected = sorted(map(str, odd_sketch.report(near_docs).collect()))
    monkeypatch.setattr(odd_sketch, "BLOCK_SHINGLES", 400)
    monkeypatch.setattr(odd_sketch, "MOST_BROADCAST", 0)
    assert sorted(map(str, odd_sketch.report(near_docs).collect())) == expected


def test_odd_sketch_leaderless_links(spark):
    """A chain: each text links with the next one only, so most links have no leader in them."""
    rng = np.random.default_rng(2)
    words = [str(x) for x in rng.permutation(4000)]
    rows = [(i, " ".join(words[i * 15:i * 15 + 200])) for i in range(40)]
    got = odd_sketch.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = _components(rows, 4, 80)
    assert {e[2] for e in expected} == {0}
    _same([r[:3] for r in got], expected)


def test_odd_sketch_counts_tell_similarity():
    """The XOR counts of sets at the threshold stay below the limit, those of unlike sets don't."""
    sampling, rng = odd_sketch.Sampling(80), np.random.default_rng(1)
    assert (1 - 0.8**odd_sketch.ROWS) ** sampling.bands < odd_sketch.MISS
    counts, far, no_band = [], [], 0
    for _ in range(300):
        u = rng.integers(0, 2**63, 500, dtype=np.uint64) * np.uint64(2)
        sets = [np.sort(x) for x in (u[:450], np.r_[u[:400], u[450:]], u[225:])]  # 400 / 500, and 225 / 500
        m = odd_sketch.samples_of(sets, sampling)
        k, bands = odd_sketch.sketch(m), odd_sketch.band_hashes(m)
        assert k.shape == (3, odd_sketch.BITS // 64)
        counts.append(int(np.bitwise_count(k[0] ^ k[1]).sum()))
        far.append(int(np.bitwise_count(k[0] ^ k[2]).sum()))
        no_band += not (bands[0] == bands[1]).any()
    assert max(counts) <= sampling.limit() and no_band == 0
    assert 40 < np.mean(counts) < 70 and np.mean(far) > sampling.limit()


# --- vector codes ----------------------------------------------------------------


def _vectors():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(700, 12)) * 0.2
    x[100:300] = x[100]  # a third or so alike
    rows = [(int(i) * 7, v.tolist(), int(i) % 5 if i % 11 else None, "clash") for i, v in enumerate(x)]
    rows += [rows[5], rows[5], (rows[6][0], rows[7][1], 9, "clash")]  # a row three times, an id with two vectors
    rows += [(90000, None, 1, "c"), (90001, [float("nan")] * 12, 1, "c"), (90002, [None] + [0.0] * 11, 1, "c"), (90003, [float("inf")] + [0.0] * 11, 1, "c")]
    return rows


VECTORS = "vec_id long, embedding array<double>, label int, code string"


def _lloyd(rows):
    """Plain Lloyd rounds in Python integers."""
    kept = [(i, v, lab) for i, v, lab, _ in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[int(np.floor(c * 1024)) for c in v] for _, v, _ in kept]
    width = len(whole[0]) // 4
    parts = [[tuple(v[p * width:(p + 1) * width]) for v in whole] for p in range(4)]
    codes, errors, books = [""] * len(kept), [0] * len(kept), []
    for part in parts:
        book = [list(x) for x in part[:256]]
        for step in range(5):
            each = {x: min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book)) for x in set(part)}
            if step == 4:
                break
            members = collections.defaultdict(list)
            for x in part:
                members[each[x][1]].append(x)
            for e, xs in members.items():
                book[e] = [sum(c) // len(xs) for c in zip(*xs)]
        for i, x in enumerate(part):
            codes[i] += f"{each[x][1]:02x}"
            errors[i] += each[x][0]
        books.append(book)
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    total = collections.Counter()
    for (_, _, lab), e in zip(kept, errors):
        total[lab] += e
    return [(i, c, e, total[lab], sha) for (i, _, lab), c, e in zip(kept, codes, errors)]


def test_vector_codes_equal_plain_rounds(spark):
    rows = _vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    expected = _lloyd(rows)
    _same(vector_codes.report(df).collect(), expected)
    few = spark.createDataFrame(rows[:40], VECTORS)  # fewer rows than entries
    _same(vector_codes.report(few).collect(), _lloyd(rows[:40]))
    assert vector_codes.report(df.limit(0)).count() == 0


def test_vector_codes_odd_dimensions(spark):
    rows = [(1, [], 0, "c"), (2, [0.5], 0, "c"), (3, [0.25], None, "c"), (None, [0.5, 1.0, 2.0, 1e300, -1e300], None, "c"), (4, [float(i) for i in range(5)], 1, "c")]
    got = {r["vec_id"]: r for r in vector_codes.report(spark.createDataFrame(rows, VECTORS)).collect()}
    assert set(got) == {None, 1, 2, 3, 4}
    assert got[1]["code"] == "00000000" and all(r["error"] == 0 for r in got.values())
    assert got[2]["code"] == "00000000" and got[3]["code"] == "01000000"
    assert vector_codes.cuts(5) == [0, 2, 3, 4, 5]


def test_vector_codes_sql(spark):
    rows = _vectors()
    table = pa.table({"vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float64())), "label": pa.array([r[2] for r in rows], pa.int32())})
    con = duckdb.connect()
    con.register("embeddings", table)
    _same(con.sql(vector_codes.SQL).fetchall(), _lloyd(rows))


def test_hilbert_places_are_a_walk():
    """All cells of a small cube have places 0..n-1, and neighbours on the curve are neighbours in space."""
    for dim, bits in ((2, 3), (3, 2), (4, 1)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij"), -1).reshape(-1, dim)
        place = vector_codes.hilbert_place(grid, bits)
        assert sorted(place) == list(range(len(grid)))
        walk = grid[np.argsort(place)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_shortlist_holds_the_nearest_entry():
    rng = np.random.default_rng(3)
    short = []
    for _ in range(60):
        book = rng.integers(-300, 300, (64, 4))
        x = rng.integers(-300, 300, 4) + rng.integers(-25, 25, (20, 4))
        entries = vector_codes.shortlist(x.min(0), x.max(0), book)
        d = ((x[:, None] - book[None]) ** 2).sum(2)
        assert set(d.argmin(1)) <= set(entries)
        at, dist = vector_codes.nearest(x, entries, book)
        assert (at == d.argmin(1)).all() and (dist == d.min(1)).all()
        short.append(len(entries))
    assert np.mean(short) < 32


# --- source audit -----------------------------------------------------------------


def _audit_rows():
    rng = np.random.default_rng(9)
    words = ["alpha", "Beta", "gamma", "ÉCLAIR", "éclair", "naïve", "delta2x", "日本", "o'neil", "zeta"] + ["w" + "abcdefghij"[i % 10] * (1 + i // 10) for i in range(90)]
    rows = []
    for i in range(260):
        lang, source = ["de", "en", None, ""][i % 4], ["a", "b", "é", None, "Z"][i % 5]
        p = 1 / np.arange(1, len(words) + 1)
        text = ". ".join(rng.choice(np.roll(words, i % 5), int(rng.integers(0, 60)), p=p / p.sum()))
        rows.append((i % 200, text, lang, source, 1, 2, 3, "k", "t"))
    rows += [(900, None, "de", "empty", 1, 2, 3, "k", "t"), (None, "", "fr", "x", 1, 2, 3, "k", "t"), (901, "rare words only", "fr", "y", 1, 2, 3, "k", "t"),
             (902, "solo " * 20_000, "it", "one", 1, 2, 3, "k", "t"), (903, "\x00\x7f 123 _", "de", "a", 1, 2, 3, "k", "t")]
    return rows + [rows[0], rows[0]]


def _audit(rows, least=10):
    """The contract in plain Python."""
    counts, df = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    groups = set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        counts[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in df[lang].items() if n >= least]
        sources = [s for g, s in groups if g == lang]
        n = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        n[None] = {t: sum(n[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (c + 2) // (sum(x.values()) + 2 * len(kept)) for t, c in x.items()} for s, x in n.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = [(sum(f(p[source][t], p[s][t]) for t in kept), s) for s in sources if s != source]
        terms = [(f(p[source][t], p[None][t]), t) for t in kept if n[source][t] > 0 and p[source][t] > p[None][t]]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, r) for r, (value, item) in enumerate(items, 1) if part == "pair" or r <= 10]
    return out


def test_audit_equals_the_plain_sums(spark, monkeypatch):
    rows = _audit_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(6)
    expected = _audit(rows)
    assert len([e for e in expected if e[2] == "term"]) > 50 and any(e[0] == "fr" and e[4] == 0 for e in expected)
    _same(audit.audit(docs).collect(), expected)
    # small dictionaries, small buckets, no broadcast: nothing changes
    monkeypatch.setattr(audit, "MOST_ENTRIES", 7)
    monkeypatch.setattr(audit, "BUCKET_TERMS", 20)
    monkeypatch.setattr(audit, "MOST_BROADCAST", 0)
    _same(audit.audit(docs.repartition(3)).collect(), expected)
    assert audit.audit(docs.limit(0)).count() == 0


def test_audit_sql(spark):
    rows = _audit_rows()
    con = duckdb.connect()
    con.register("documents", pa.table({"text": [r[1] for r in rows], "lang": [r[2] for r in rows], "source": [r[3] for r in rows]}))
    _same(con.sql(audit.SQL).fetchall(), _audit(rows))


def test_level_bitmaps_hold_every_term_once(spark):
    rows = [("x", s, n, 10 + n, 1, 0, t // 64, t % 64) for s, of in (("a", lambda t: t % 3), ("b", lambda t: t % 2)) for t in range(130) if (n := of(t))]
    levels = audit.level_bitmaps(spark.createDataFrame(rows, "lang string, source string, n long, p long, p0 long, bucket int, chunk int, bit int")).collect()
    found = collections.defaultdict(set)
    for r in levels:
        bits = r["bits"] & (2**64 - 1)
        found[r["source"], r["n"]] |= {r["chunk"] * 64 + b for b in range(64) if bits >> b & 1}
    assert found["a", 1] == set(range(1, 130, 3)) and found["a", 2] == set(range(2, 130, 3)) and found["b", 1] == set(range(1, 130, 2))
