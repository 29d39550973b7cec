"""Random tables: every plan equals a plain-Python brute force of the window semantics."""

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from sequor.operators import windows as W
from sequor.params import SequenceSpec


def brute(rows, spec):
    out = {}
    by = {}
    for s, t, v, u in rows:
        by.setdefault(s, []).append((t, v, u))
    for s, items in by.items():
        items.sort(key=lambda x: x[0])
        n = len(items)
        for rn in range(1, n + 1):
            if rn < spec.past or rn > n - spec.future - spec.shift + 1 or (rn - spec.past) % spec.step:
                continue
            past = items[rn - spec.past: rn]
            vs = [x[1] for x in past if x[1] is not None]
            us = [x[2] for x in past if x[2] is not None]
            lab = items[rn - 1 + spec.shift: rn - 1 + spec.shift + spec.future]
            ys = [x[1] for x in lab if x[1] is not None]
            if spec.on_null == "drop" and (len(vs) < spec.past or len(us) < spec.past or len(ys) < spec.future):
                continue
            out[(s, rn)] = (vs, us, ys)
    return out


series_rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(-50, 50)),
              st.one_of(st.none(), st.integers(-50, 50))),
    min_size=0, max_size=60,
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=series_rows, past=st.integers(1, 5), future=st.integers(1, 3), shift=st.integers(1, 2),
       step=st.integers(1, 3), mode=st.sampled_from(["keep", "drop"]), struct=st.booleans())
def test_plans_equal_brute_force(spark, rows, past, future, shift, step, mode, struct):
    data = [(s, i, None if v is None else float(v), None if u is None else float(u)) for i, (s, v, u) in enumerate(rows)]
    feats = ("v", "u", "v2", "u2") if struct else ("v", "u")
    df = spark.createDataFrame(data, "s string, t long, v double, u double")
    df = df.withColumn("v2", df.v * 2).withColumn("u2", df.u * 2)
    spec = SequenceSpec(series=("s",), order=("t",), features=feats, label="v", past=past, future=future,
                        shift=shift, step=step, on_null=mode)
    bspec = spec.with_(features=("v", "u"))
    expect = brute([(s, t, v, u) for s, t, v, u in data], bspec)
    plans = (("direct", {}), ("blocked", {"block_rows": 3, "bucket_rows": 4}),
             ("auto", {"hot_rows": 8, "block_rows": 2, "bucket_rows": 3}))
    for plan, kw in plans:
        got = {(r["s"], r["rn"]): (r["v"], r["u"], r["v_label"])
               for r in W.sequence_windows(df, spec, plan=plan, **kw).collect()}
        assert got == expect, (plan, kw)


tie_rows = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.one_of(st.none(), st.integers(0, 3))),
    min_size=1, max_size=120,
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=tie_rows, hot=st.integers(1, 40), bucket=st.integers(1, 10))
def test_numbering_with_ties_equals_sort(spark, rows, hot, bucket):
    from sequor.plans.numbering import number_rows

    data = [(s, t, k) for k, (s, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "s string, t long, k long")
    expect = {}
    for s in {r[0] for r in data}:
        ordered = sorted((r for r in data if r[0] == s), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for i, r in enumerate(ordered, 1):
            expect[r[2]] = (i, len(ordered))
    got = {r["k"]: (r["rn"], r["n"]) for r in number_rows(df, ["s"], ["t", "k"], hot_rows=hot, bucket_rows=bucket).collect()}
    assert got == expect
