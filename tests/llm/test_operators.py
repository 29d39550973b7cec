"""The operators of the training-data list against brute force, on small awkward tables."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sequor.llm import ann, divergence, hashing, induced, jaccard, language, line_dedup, mixing, packing, repeats, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, doc string, n int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _texts():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklm"), 5)) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(words, n))
    passage, line = say(70), "  This LINE is held by many documents, Éclair of 40 "
    texts = [None, "", " \t\n", "one", "one two", "ONE two", "\n\n"]
    texts += [say(60) + "\n" + line + "\n" + say(30) for _ in range(8)]
    texts += [say(40) + " " + passage + " " + say(40) for _ in range(4)]
    base = say(300)
    near = base.split()
    near[5] = "edited"
    texts += [base, base, " ".join(near), base.upper(), say(3000), "x" * 900, "ñandú " * 300, "é" * 500]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "fr", None][i % 3], ["a", "b", None][i % 3], 1, 7, "clash", 9) for i, t in enumerate(_texts())]
    rows.append(rows[8])  # a row twice
    rows.append((None, "text of a row without an id " * 20, "en", "a", 1, 7, "clash", 9))
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _rows(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.collect()]


def _same(got, expected):
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, expected))


def test_line_dedup(docs, empty):
    rows = _rows(docs)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = collections.defaultdict(set)
    for d, t in rows:
        for x in t.split("\n"):
            if len(key(x)) >= 40:
                holders[key(x)].add(d)
    low = lambda d: -1 if d is None else d
    keeper = {k: max(v, key=low) for k, v in holders.items() if len(v) >= 5}
    expected = []
    for d, t in rows:
        ls = t.split("\n")
        kept = [x for x in ls if key(x) not in keeper or keeper[key(x)] == d]
        expected.append((d, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    _same(line_dedup.report(docs).collect(), expected)
    assert sum(e[2] for e in expected) > 5
    assert line_dedup.report(empty).count() == 0
    assert line_dedup.line_dedup(docs).columns == docs.columns


def test_line_dedup_sorts_once_and_streams_first_occurrences(spark):
    rows = [(h, 0, d, p) for h in range(3) for d in (1, 2, None) for p in (9, 4, 4, 7)]
    first = line_dedup.first_occurrences(spark.createDataFrame(rows, "h1 long, h2 long, doc long, pos int"))
    _same(first.collect(), [(h, 0, d, 4) for h in range(3) for d in (1, 2, None)])
    plan = first.groupBy("h1").agg(F.count("*"), F.max("doc"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning(") == 1 and plan.count("hashpartitioning(") == 1  # the latter: of the counts
    # pos is used by nothing but the sort, which stays, and by the window that asks for it
    assert len(re.findall(r"Sort \[h1#\d+L ASC.*pos#\d+ ASC", plan)) == 1 and "row_number() windowspecdefinition(h1" in plan


def test_line_dedup_clashing_names(spark):
    line = "a line of forty code points and more, in six documents"
    rows = [(i, f"{line}\nown {i}", 5, "x", i, "r") for i in range(6)]
    names = "doc_id long, text string, _n_dropped int, _keep_runs string, keep_runs int, row string"
    df = spark.createDataFrame(rows, names).withColumns({"n_dropped": F.lit(1), "id": F.lit(2), "rk": F.lit("k"), "doc": F.lit(0)})
    got = line_dedup.line_dedup(df)
    assert got.columns == df.columns
    _same(got.collect(), [(i, f"{line}\nown {i}" if i == 5 else f"own {i}", 5, "x", i, "r", 1, 2, "k", 0) for i in range(6)])


def test_line_dedup_bitmaps_are_runs(docs):
    for r in line_dedup.keep_bitmaps(docs).collect():
        runs = [(x["start"], x["len"]) for x in r["keep_runs"]]
        assert sum(n for _, n in runs) == r["n_lines"] - r["n_dropped"]
        assert all(a + n < b for (a, n), (b, _) in zip(runs, runs[1:], strict=False))


def test_divergence_base_counts(docs, empty):
    expected = []
    for d, t in _rows(docs):
        w = WORD.findall(t)
        grams = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        inside = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
        expected.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside), failed))
    got = divergence.report(docs)
    _same(got.drop("kept").collect(), expected)
    assert got.filter("base_failed and kept").count() == 0
    assert divergence.report(empty).count() == 0


def test_divergence_formula(spark):
    p, q = [600_000, 400_000, 0], [100_000, 400_000, 500_000]
    got = spark.range(1).select(divergence.js_divergence(F.array(*map(F.lit, p)), F.array(*map(F.lit, q)))).first()[0]
    a, b = np.array(p) / 1e6, np.array(q) / 1e6
    m = (a + b) / 2
    kl = lambda x: sum(v * np.log2(v / w) for v, w in zip(x, m, strict=True) if v > 0)
    assert got == pytest.approx((kl(a) + kl(b)) / 2)


def test_divergence_rejects_symbol_junk(spark):
    rows = [(i, " ".join(["the", "of", "and", f"word{i % 7}", "is", "that", f"other{i}"] * 3 + [f"w{i}x{j}" for j in range(60)]), "en") for i in range(60)]
    rows.append((99, " ".join(f"a{j}%%%***&&&" for j in range(80)), "en"))
    got = {r["doc_id"]: r["kept"] for r in divergence.report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got.pop(99) and all(got.values())


def _divergence_verdicts(rows, least):
    """kept of (id, text, lang) rows in plain Python."""
    words = {i: WORD.findall(t or "") for i, t, _ in rows}
    held = collections.defaultdict(collections.Counter)
    for i, _, lang in rows:
        held[lang].update({w.lower() for w in words[i]})
    common = {lang: sorted(c, key=lambda w: (-c[w], w))[: divergence.COMMON_WORDS] for lang, c in held.items()}
    shares = lambda c: [x * 1_000_000 // sum(c) for x in c]
    hists, refs = {}, collections.defaultdict(list)
    for i, t, lang in rows:
        t, w = t or "", words[i]
        joined = "".join(w)
        found = [len(re.findall(p, t)) for p in (r"[A-Z]", r"[0-9]", r"[.,;:!?'\"()-]", r"[#*$%&|<>]")] + [len(t.encode()) - len(t)]
        classes = [len(t) - len(joined), max(0, len(joined) - sum(found)), *found]
        low = [x.lower() for x in w]
        hits = [low.count(x) for x in common.get(lang, [])]
        hists[i] = (classes, [*hits, len(w) - sum(hits)])
        for kind, ok in ((0, len(t) >= divergence.MIN_CHARS), (1, len(w) >= divergence.MIN_WORDS)):
            if ok:
                refs[lang, kind].append(shares(hists[i][kind]))

    def far(i, lang, kind, ok):
        if not ok or len(refs[lang, kind]) < least:
            return 0.0
        p = np.array(shares(hists[i][kind])) / 1e6
        q = np.array([sum(x) // len(x) for x in zip(*refs[lang, kind], strict=True)]) / 1e6
        bits = lambda x: sum(a * np.log2(2 * a / (a + b)) for a, b in x if a > 0)
        return (bits(zip(p, q, strict=True)) + bits(zip(q, p, strict=True))) / 2

    out = {}
    for i, t, lang in rows:
        w = words[i]
        grams = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        inside = {j for k in range(len(w) - 7) if grams[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        a = far(i, lang, 0, len(t or "") >= divergence.MIN_CHARS)
        b = far(i, lang, 1, len(w) >= divergence.MIN_WORDS)
        out[i] = len(w) >= 20 and 100 * len(inside) <= 30 * len(w) and a <= divergence.MAX_CLASS_DIVERGENCE \
            and b <= divergence.MAX_WORD_DIVERGENCE and a + b <= divergence.MAX_SUM_DIVERGENCE
    return out


def test_divergence_verdicts_in_any_language(spark):
    rng = np.random.default_rng(6)
    rows, names = [], ["en", None, ""]
    common = {lang: [f"{c}{j}" for j in range(40)] for lang, c in zip(names, "kqz", strict=True)}
    for i in range(150):
        lang = names[i % 3]
        junk = i % 10 == 9
        pool = [f"x{j}" for j in range(500)] if junk else common[lang] + [f"r{j}" for j in range(40)]
        rows.append((i, " ".join(rng.choice(pool, 90 + i)) + ("É" if i % 7 else " #%& Q."), lang))
    rows += [(900, "k1 " * 15, "en"), (901, None, None), (902, " ".join(f"K{j}" for j in range(60)), "rare"), (903, "", "")]
    schema = "doc_id long, text string, lang string"
    got = {r["doc_id"]: r["kept"] for r in divergence.report(spark.createDataFrame(rows, schema)).collect()}
    assert got == _divergence_verdicts(rows, divergence.MIN_REFERENCE_DOCS)
    assert 10 < sum(not v for v in got.values()) < 100
    assert got[902] and not any(got[i] for i in range(9, 150, 10))
    renamed = [(i, t, {"en": "tlh", None: "x-1", "": None}.get(lang, lang)) for i, t, lang in rows]
    assert got == {r["doc_id"]: r["kept"] for r in divergence.report(spark.createDataFrame(renamed, schema)).collect()}


def test_divergence_common_words(spark):
    rows = [("b A c", "en"), ("a c c c", "en"), ("q", "en"), ("z y", None), (None, None), ("w", "")]
    got = divergence.common_words(spark.createDataFrame(rows, "text string, lang string"), most=2).collect()
    assert {r["lang"]: r["list"] for r in got} == {"=en": ["a", "c"], "": ["y", "z"], "=": ["w"]}


def test_jaccard(docs, empty):
    rows = [(d, t) for d, t in _rows(docs) if d is not None]
    sets = collections.defaultdict(list)
    for d, t in rows:
        w = WORD.findall(t.translate(LOWER))
        sets[d].append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set()))
    root = {d: d for d in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in sets:
        for b in sets:
            if a < b and any(s and t and 100 * len(s & t) >= 85 * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = jaccard.report(docs)
    _same([(r[0], r[2]) for r in got.filter("doc_id is not null").collect()], [(d, find(d)) for d, _ in rows])
    assert {r[0]: r[1] for r in got.filter("doc_id is not null").collect()} == {d: len(s[0]) for d, s in sets.items()}
    assert got.filter("doc_id is null").first()["component_id"] is None
    assert jaccard.report(empty).count() == 0
    assert jaccard.one_per_group(docs).columns == docs.columns


def test_jaccard_blocks_and_tree(monkeypatch, docs):
    whole = sorted(map(str, jaccard.report(docs).collect()))
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 50)  # every group is cut into blocks
    assert sorted(map(str, jaccard.report(docs).collect())) == whole
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.choice(30, rng.integers(5, 25)).astype(np.uint64))[::-1] for _ in range(60)]
    sets = [np.frombuffer(x, np.uint64) for x in dict.fromkeys(s.tobytes() for s in sets)]
    tree = jaccard.Tree(sets)
    for s in sets:
        found = {tree.order[j] for j in tree.links(s, 60, lambda lo, hi: False)}
        assert found == {i for i, t in enumerate(sets) if 100 * len(np.intersect1d(s, t)) >= 60 * len(np.union1d(s, t))}


def test_jaccard_linked_sets_share_a_run():
    rng = np.random.default_rng(3)
    for percent in (50, 74, 75, 80, 85, 90):
        links = 0
        for _ in range(200):
            base = rng.choice(400, rng.integers(1, 30), replace=False)
            sets = [np.unique(np.r_[rng.permutation(base)[rng.integers(0, 3) :], rng.integers(0, 400, rng.integers(0, 3))]).astype(np.uint64) for _ in range(6)]
            for s in sets:
                for t in sets:
                    both, either = len(np.intersect1d(s, t)), len(np.union1d(s, t))
                    if both < either and 100 * both >= percent * either:
                        links += 1
                        assert len(np.intersect1d(jaccard.prefix_runs(s, percent), jaccard.prefix_runs(t, percent)))
        assert links


def test_repeats(docs, empty):
    rows = [(d, t.encode()) for d, t in _rows(docs)]
    seen = collections.Counter(b[i : i + 200] for _, b in rows for i in range(len(b) - 199))
    expected = []
    for d, b in rows:
        cover = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                cover[i : i + 200] = True
        spans = int((cover[1:] & ~cover[:-1]).sum() + cover[0])
        kept = bytes(x for x, c in zip(b, cover, strict=False) if not c)
        expected.append((d, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    _same(repeats.report(docs).collect(), expected)
    assert repeats.report(empty).count() == 0


def test_repeats_shared_on_one_side_only(spark):
    rng = np.random.default_rng(12)
    say = lambda n: "".join(rng.choice(list("abcdefghijklmnop"), n))
    core, rows = say(1200), []
    for i in range(40):  # one stretch of 190 to 320 bytes of the core each, so that contexts share anything from none to all
        lo, size = int(rng.integers(0, 860)), int(rng.integers(190, 330))
        rows.append((i, say(int(rng.integers(0, 400))) + core[lo : lo + size] + say(int(rng.integers(0, 400)))))
    rows += [(100, core[:199]), (101, core[300:500]), (102, "ab" * 300), (103, core[600:900] + core[600:900])]
    seen = collections.Counter(t[i : i + 200] for _, t in rows for i in range(len(t) - 199))
    expected = {}
    for d, t in rows:
        cover = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                cover[i : i + 200] = True
        expected[d] = "".join(x for x, c in zip(t, cover, strict=True) if not c).encode()
    got = {r["doc"]: bytes(r["kept"]) for r in repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected and sum(expected[d] != t.encode() for d, t in rows) > 10


def test_repeats_each_window_lies_in_one_context(monkeypatch):
    rng = np.random.default_rng(21)
    say = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    texts = [say(5000), "", say(199), say(200), None, "é" * 150, "ab" * 400, say(31), say(700), "z" * 260]
    size = [len((t or "").encode()) for t in texts]
    for piece in (1 << 20, 600):  # the second: long texts piece by piece
        monkeypatch.setattr(repeats, "_PIECE", piece)
        begun = collections.Counter()
        for row, place, _, _, before, after, *_ in repeats._of_batch(pa.record_batch({"t": pa.array(texts)})):
            for r, p, b, a in zip(row.tolist(), place.tolist(), before.tolist(), after.tolist(), strict=True):
                begun.update((r, i) for i in range(p - b, p + a - repeats.LENGTH + 1))
        assert begun == collections.Counter((r, i) for r, n in enumerate(size) for i in range(n - repeats.LENGTH + 1))


def test_repeats_deals_a_frequent_string_apart(spark):
    rng = np.random.default_rng(23)
    say = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    often, twin = say(600), say(500)
    rows = [(i, say(60) + often + say(60) + often) for i in range(300)] + [(i, twin) for i in range(300)] + [(999, say(2000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = repeats.find_anchors(docs.select(docs.doc_id.alias("doc"), F.xxhash64("text").alias("rk"), docs.text.alias("t")))
    # in each task: one of every context that is equal as a whole
    assert found.groupBy("fp", "ctx").count().agg(F.max("count")).first()[0] <= 2
    got = {(r["doc_id"], r["n_bytes"]): r["n_removed"] for r in repeats.report(docs).collect()}
    assert got[999, 2000] == 0
    assert all(got[i, 500] == 500 and 1200 <= got[i, 1320] <= 1220 for i in range(300))


def test_repeats_of_alike_rows_and_null_ids(spark):
    rng = np.random.default_rng(22)
    say = lambda n: "".join(rng.choice(list("abcdefghijklmnop"), n))
    core, alone = say(900), say(900)
    # whole contexts of a twice, one side of them in c and d; rows alike in id and text; ids null or used twice
    rows = [("a", core), ("b", core), ("c", say(300) + core[:450]), ("d", core[430:] + say(300)), ("e", alone), ("e", alone), ("e", say(500)),
            (None, say(100) + core[200:420]), (None, None), (None, say(400))]
    seen = collections.Counter(t[i : i + 200] for _, t in rows if t for i in range(len(t) - 199))
    expected = []
    for d, t in rows:
        cover = np.zeros(len(t or ""), bool)
        for i in range(len(cover) - 199):
            if seen[t[i : i + 200]] > 1:
                cover[i : i + 200] = True
        kept = bytes(x for x, c in zip((t or "").encode(), cover, strict=True) if not c)
        expected.append((d, len(cover), len(cover) - len(kept), int(np.diff(np.r_[0, cover.astype(int)]).clip(0).sum()), hashlib.sha256(kept).hexdigest()))
    got = repeats.report(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(expected)
    assert sum(x[2] > 0 for x in expected) == 7


def test_repeats_long_text_in_pieces(monkeypatch, spark):
    rng = np.random.default_rng(9)
    parts = ["".join(rng.choice(list("abcdefgh"), 3000)) for _ in range(4)]
    df = spark.createDataFrame([(1, parts[0] + parts[1] + parts[2] + parts[1]), (2, parts[3] + "z" + parts[0][100:900] + "z")], "doc_id long, text string")
    whole = sorted(repeats.report(df).collect())
    batch = df.selectExpr("text as t").toArrow().to_batches()[0]
    once = [set(zip(r.tolist(), p.tolist(), c.tolist(), strict=True)) for r, p, g, c, *_ in repeats._of_batch(batch)]
    monkeypatch.setattr(repeats, "_PIECE", 1000)
    cut = [set(zip(r.tolist(), p.tolist(), c.tolist(), strict=True)) for r, p, g, c, *_ in repeats._of_batch(batch)]
    assert set().union(*once) <= set().union(*cut)
    assert sum(map(len, cut)) == len(set().union(*cut))
    assert [r["n_removed"] for r in whole] == [6000 + 800, 800]


@pytest.mark.parametrize("small", [False, True])
def test_induced_sorting(monkeypatch, small):
    if small:  # many chunks, spooled tuples, doubling at the first recursion
        for name, value in (("STEP", 7), ("MEMORY", 20), ("MOST_SYMBOLS", 3)):
            monkeypatch.setattr(induced, name, value)
    rng = np.random.default_rng(2)
    for n, symbols in ((1, 2), (2, 1), (60, 2), (400, 3), (300, 90), (500, 1)):
        text = np.r_[rng.integers(0, symbols, n) + 2, 0].astype(np.uint8)
        padded = np.r_[text, np.zeros(induced.CLAMP + 8, np.uint8)]
        pos, lcp = (np.concatenate(x) for x in zip(*induced.suffixes(padded, len(text)), strict=True))
        s = text.tobytes()
        assert sorted(pos.tolist()) == list(range(len(s)))
        for k in range(1, len(s)):
            a, b = s[pos[k - 1] :], s[pos[k] :]
            same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert a[:200] <= b[:200] and lcp[k] == min(same, 200)


def test_packing(docs, empty):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path("byte_bpe_50k.json"))
    expected = collections.Counter()
    special = docs.limit(1).select(F.lit(500).cast("long").alias("doc_id"), F.lit("a <|endoftext|> b  \n c　d").alias("text"))
    both = docs.select("doc_id", "text").unionByName(special)
    for d, t in _rows(both):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        for k, (s, e) in enumerate(zip([0, *range(first, len(ids), 2048)], [*range(first, len(ids) + 1, 2048)], strict=True)):
            expected[(d, k, s, e - s, zlib.crc32(ids[s:e].tobytes()))] += 1
    got = packing.report(both).collect()
    assert collections.Counter(tuple(r)[:5] for r in got) == expected
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(by) <= -(-total // 2048) + 2
    assert packing.report(empty).count() == 0


def test_best_two_fit_replaces_the_smallest():
    # greedy takes 60 and 30 and leaves a gap of 10; 25 and 15 fit the widened gap exactly
    bins = packing.best_two_fit([60, 30, 25, 15], most=100)
    assert sorted(map(sorted, bins)) == [[0, 2, 3], [1]]


def test_mixing(docs, empty):
    rows = [(r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in docs.collect()]
    sizes = collections.Counter()
    for _, s, n in rows:
        sizes[s] += n
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while True:  # share, cut, share the excess anew
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    target |= {s: level * weight[s] for s in free}
    got = mixing.report(docs).collect()
    _same([(r["doc_id"], r["size"]) for r in got], [(d, n) for d, _, n in rows])
    assert sorted({(r["source_size"], round(r["target"], 6)) for r in got}) == sorted((sizes[s], round(target[s], 6)) for s in names)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    by = collections.Counter()
    for r in got:
        by[(r["source_size"], r["target"])] += r["taken"]
    assert all(abs(n - t) <= mixing.BLOCK_WORDS for (_, t), n in by.items())
    assert sorted(map(str, mixing.report(docs.repartition(3)).collect())) == sorted(map(str, got))
    assert mixing.report(empty).count() == 0


def test_mixing_permutation_is_one_to_one_and_text_matches(spark, docs):
    n = 1000
    got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long")).alias("x")).collect()
    values = [r["x"] for r in got]
    assert sorted(values) == list(range(n)) and values != list(range(n))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(WORD.findall(r["text"])) for r in mixed.collect()) == mixing.report(docs).agg(F.sum("taken")).first()[0]


def test_mixing_draws_source_counts_per_shard_and_maps_slots_from_them(spark, docs, empty):
    targets = spark.createDataFrame([("0a", 4000, 6000.0), ("0b", 3000, 3000.0), ("1", 5000, 1000.0)], "sk string, source_size long, target double")
    drawn = {(r["shard"], r["sk"]): (r["count"], r["shard_n"]) for r in mixing.shard_counts(targets, 4, 100).collect()}
    slots = mixing.slots(targets, 4, 100).collect()
    totals, in_shard = collections.Counter(), collections.Counter()
    for (shard, sk), (n, _) in drawn.items():
        totals[sk] += n
        in_shard[shard] += n
    assert totals == {"0a": 1500, "0b": 750, "1": 250}
    assert in_shard == dict.fromkeys(range(25), 100) and {n for _, n in drawn.values()} == {100}
    assert collections.Counter((r["shard"], r["sk"]) for r in slots) == {k: n for k, (n, _) in drawn.items()}
    assert {(r["shard"], r["slot"]) for r in slots} == {(s, i) for s in range(25) for i in range(100)}
    # without replacement the variance is 100 p (1 - p) 2400 / 2499; equal counts would have none
    for sk, p in (("0a", 0.6), ("0b", 0.3), ("1", 0.1)):
        spread = np.mean([(drawn.get((s, sk), (0,))[0] - 100 * p) ** 2 for s in range(25)]) / (100 * p * (1 - p))
        assert 0.35 < spread < 2.2, (sk, spread)
    passes = collections.Counter((r["sk"], r["pass"], r["block"]) for r in slots)
    assert set(passes.values()) == {1} and len({b for k, p, b in passes if (k, p) == ("0a", 0)}) == 1000

    words = {}
    got = mixing.mixed(docs, block_words=16, shard_slots=50).collect()
    for r in got:
        words.setdefault((r["shard"], r["slot"]), []).append((r["part"], r["text"], r["source"]))
    shards = collections.Counter(s for s, _ in words)
    assert len(shards) > 3 and all(shards[s] == 50 for s in range(len(shards) - 1))
    assert set(words) == {(s, i) for s in shards for i in range(shards[s])}
    for own in words.values():
        at = 0
        for part, text, _ in sorted(own, key=lambda x: x[0]):
            assert part == at
            at += len(WORD.findall(text))
        assert at <= 16 and len({s for _, _, s in own}) == 1
    taken = collections.Counter()
    for r in got:
        taken[r["doc"]] += len(WORD.findall(r["text"]))
    expected = collections.Counter()
    for r in mixing.taken(docs, block_words=16).collect():
        expected[r["doc"]] += r["taken"]
    assert {d: n for d, n in expected.items() if n} == taken
    source = {r["doc_id"]: " ".join(WORD.findall(r["text"] or "")) for r in docs.collect()}
    assert all(f" {r['text']} " in f" {source[r['doc']]} " for r in got)
    assert len({r["source"] for r in got if r["shard"] == 0}) == 3
    assert sorted(map(str, mixing.mixed(docs.repartition(3), block_words=16, shard_slots=50).collect())) == sorted(map(str, got))
    assert mixing.mixed(empty).count() == 0


def test_warc_round_trip(spark):
    big, rows = "<p>é" + "x" * 1500, []
    rows += [(i, f"http://www.Example.org:80/a?{i}", big) for i in range(5)]
    rows += [(10, "http://b.example.org/", "small"), (11, "http://b.example.org/", "small"), (12, None, None), (13, "not a url", ""), (13, "not a url", "")]
    rows.append((None, "http://c.example.org/\r\nX: y", big))
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, file string")
    expected = []
    for p, _, h in rows:
        b = (h or "").encode()
        revisit = len(b) >= 1000 and p != 4
        expected.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", 4 if revisit else None))
    _same(warc.round_trip(df).collect(), expected)
    assert warc.round_trip(df.limit(0)).count() == 0
    assert warc.surt("http://www.Example.org:80/a?b#c") == "org,example,www):80/a?b".replace("):80", ":80)")


@pytest.mark.parametrize("url", ["http://c.example.org/a\r\nX: y", "http://c.example.org/a\nb?c", "  no host ", "\n\ttwo\r\nlines\u00a0", "", None])
def test_warc_revisit_finds_a_response_with_an_odd_url(spark, url):
    big = "<p>" + "x" * 1500
    fields, body = warc.parse(warc.record(9, url, big.encode(), "d", None))
    assert warc.surt(fields.get("warc-target-uri")) == warc.surt(url) and body == big.encode()
    df = spark.createDataFrame([(1, "http://a.example.org/", big), (9, url, big)], "page_id long, url string, html string")
    sha = hashlib.sha1(big.encode()).hexdigest()
    _same(warc.round_trip(df).collect(), [(1, 1503, sha, "revisit", 9), (9, 1503, sha, "response", None)])


def test_ann_recall_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 24))
    x[300:600] = x[300]  # a hot vector
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(5000, None, 1), (5050, [0.0] * 24, 1), (5100, [float("nan")] * 24, 1), (5150, [1.0, None] + [0.0] * 22, 1), (None, [1.0] * 24, 1)]
    got = ann.report(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert max(r["vec_id"] for r in got) < 1500 and {r["query_id"] for r in got} == set(range(0, 1500, 50))
    found = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = 0
    for q, near in found.items():
        s = ann.exact_cosine(x, x[q])
        s[q] = -9
        best = np.lexsort((np.arange(1500), -s))[:5]
        hits += len(set(best) & {i for i, _ in near})
        assert [i for i, _ in near] == sorted((i for i, _ in near), key=lambda i: (-s[i], i))
        assert all(v == pytest.approx(s[i], abs=1e-12) for i, v in near)
    assert hits / (5 * len(found)) >= 0.9
    assert [i for i, _ in found[350]] == [300, 301, 302, 303, 304]
    assert ann.report(spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>, label int")).count() == 2


def test_ann_searches_each_dimension_and_an_empty_table(monkeypatch, spark):
    rng = np.random.default_rng(14)
    rows = [(i, rng.normal(size=8 if i % 3 else 4).tolist(), i, "clash") for i in range(400)]
    rows += [(500, [3.0, 4.0], 1, "clash"), (501, [4.0, 3.0], 1, "clash"), (550, [2.0], 1, "clash"), (350, [9.0] * 8, 1, "clash")]
    schema = "vec_id long, embedding array<double>, id int, list string"
    best = {}
    for i, v, *_ in rows:
        best[i] = min(best.get(i, v), v)  # of a repeated id the smallest vector

    def exact(q):
        near = [(-sum(a * b for a, b in zip(best[q], v, strict=True)) / (np.linalg.norm(v) * np.linalg.norm(best[q])), i)
                for i, v in best.items() if i != q and len(v) == len(best[q])]
        return [i for _, i in sorted(near)[:5]]

    for most in (ann.FIT_ROWS, 30):  # with 30 the rare dimensions are not fitted
        monkeypatch.setattr(ann, "FIT_ROWS", most)
        df = spark.createDataFrame(rows, schema)
        monkeypatch.setattr(ann.fit, "__defaults__", (most, 11))
        got = collections.defaultdict(list)
        for r in sorted(ann.report(df).collect(), key=lambda r: (r["query_id"], r["rank"])):
            got[r["query_id"]].append(r["vec_id"])
        asked = [q for q in best if q % 50 == 0 and exact(q)]
        assert sorted(got) == sorted(asked)
        assert got[500] == [501] and 550 not in got
        hits = sum(len(set(got[q]) & set(exact(q))) for q in asked)
        assert hits >= 0.9 * sum(len(exact(q)) for q in asked)
    assert ann.report(spark.createDataFrame([], schema)).count() == 0


def _toxic_docs(spark):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefghij"), rng.integers(3, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        w = list(rng.choice(words, 40))
        bad = i % 5 == 0
        if bad:
            w[int(rng.integers(0, 40))] = ["wrozzle", "wro-zz-le", "kwumpt", "kw.umpt"][i // 5 % 4]
        rows.append((i, " ".join(w), "clash"))
        labels.append((i, int(bad)))
    rows += [(900, None, "clash"), (901, "", "clash"), (902, "nice w r o z z l e day", "clash"), (903, "wrozxzle", "clash")]
    labels += [(0, 1), (5000, 1), (None, 1), (7, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(spark, empty):
    docs, labels = _toxic_docs(spark)
    got = {r["doc_id"]: r for r in toxicity.report(docs, labels).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    held = [d for d, r in got.items() if r["held_out"] and d < 600]
    assert np.mean([got[d]["predicted"] == (d % 5 == 0) for d in held]) > 0.97
    assert got[902]["predicted"] == 1 and got[900]["predicted"] == 0 and 0 <= got[901]["score"] < 0.7
    model = toxicity.train(docs, labels)
    left = toxicity.clean(docs, model)
    assert left.columns == docs.columns and left.filter("doc_id = 900").count() == 1
    none = toxicity.report(empty, labels.limit(0))
    assert none.count() == 0 and toxicity.report(docs, labels.limit(0)).filter("score > 0.001").count() == 0


def test_collapsed_weights_are_the_kernel_expansion():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdef"), 6)) for _ in range(50)]
    model = toxicity.fit([(1, ["wrozzle", *words[:5]]), (0, words[5:40])] * 6, landmarks=12)
    for w in ("wrozzle", "wrxozzle", words[0]):
        u, code, weight = toxicity._features([w])
        assert model.margins(w.encode()).max() == pytest.approx(float((model.weight[code] * weight).sum()) + model.bias, abs=1e-4)


def test_language(spark, empty):
    rng = np.random.default_rng(6)
    kinds = {"xx": list("abcde "), "yy": list("vwxyz "), "zz": list("éèàçù ")}
    rows = [(i, "".join(rng.choice(kinds[k], 400)), k) for i in range(240) for k in [list(kinds)[i % 3]]]
    rows += [(900, None, "xx"), (901, "12 34 !", "yy"), (902, "", None), (903, "abc", None), (904, "vwxyz " * 5000, None)]
    got = {r["doc_id"]: r for r in language.report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert np.mean([got[i]["lang_pred"] == rows[i][2] for i in range(240) if got[i]["held_out"]]) > 0.97
    assert [got[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3 and got[904]["lang_pred"] == "yy"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language.report(empty).count() == 0


def test_chunks_keep_a_long_text_apart(monkeypatch):
    texts = ["a" * 3, None, "b" * 4, "c" * 50, "d", "e" * 10, "", None, "f" * 11]
    got = [(lo, part.to_pylist()) for lo, part in hashing.chunks(pa.array(texts), 10)]
    assert got == [(0, texts[:3]), (3, texts[3:4]), (4, texts[4:5]), (5, texts[5:8]), (8, texts[8:])]
    assert list(hashing.chunks(pa.array([], pa.string()))) == []
    # op10: a long text behind a short one goes piece by piece, with the anchors it has alone
    monkeypatch.setattr(repeats, "_PIECE", 5000)
    text = "".join(np.random.default_rng(6).choice(list("abcdefgh "), 30_000))
    sizes, inner = [], repeats.anchors
    monkeypatch.setattr(repeats, "anchors", lambda data, ends: (sizes.append(len(data)), inner(data, ends))[1])
    of = lambda *t: sorted(tuple(map(int, r[1:])) for x in repeats._of_batch(pa.record_batch({"t": pa.array(t)})) for r in zip(*x, strict=True) if r[0] == len(t) - 1)
    assert of("short", text) == of(text) and len(of(text)) > 20
    assert max(sizes) < 2 * 5000
