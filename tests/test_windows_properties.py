"""Properties of the window kernel on driver data and plan shape (§5.6)."""

import pytest
from pyspark.sql import functions as F

from sequor.operators import windows as W
from sequor.plans import blocked
from sequor.plans.numbering import number_rows
from sequor.sources.tables import events_series, events_spec

from .conftest import SF001, SF01


def _set(df, spec):
    y = spec.label_col
    return {
        (r["symbol"], r["rn"]): (tuple(r["ohlc_close"]), tuple(r[y]), tuple(r["cmmc_max"]))
        for r in df.select("symbol", "rn", "ohlc_close", y, "cmmc_max").collect()
    }


def test_count_closed_form(spark):
    ev = events_series(spark, SF01)
    spec = events_spec(60, 3)
    sizes = [r["c"] for r in ev.groupBy("symbol").agg(F.count("*").alias("c")).collect()]
    expect = sum(max(0, n - 60 - 3 + 1) for n in sizes)
    assert expect == 924
    assert W.sequence_windows(ev, spec, plan="direct").count() == expect


def test_anchor_and_next_values(spark):
    ev = events_series(spark, SF001)
    spec = events_spec(8, 3)
    out = W.sequence_windows(ev, spec, plan="direct")
    vals = {(r["symbol"], r["rn"]): r["ohlc_close"] for r in W.row_numbers(ev, spec).collect()}
    for r in out.collect():
        assert r["ohlc_close"][-1] == vals[(r["symbol"], r["rn"])]
        assert r["ohlc_close_label"][0] == vals[(r["symbol"], r["rn"] + 1)]
        assert len(r["ohlc_close"]) == 8 and len(r["ohlc_close_label"]) == 3


@pytest.mark.parametrize("block_rows", [1, 8, 10_000])
def test_blocked_equals_direct(spark, block_rows):
    ev = events_series(spark, SF001)
    spec = events_spec(8, 3)
    direct = _set(W.sequence_windows(ev, spec, plan="direct"), spec)
    blk = _set(blocked.sequence_windows_blocked(ev, spec, block_rows=block_rows, bucket_rows=7), spec)
    assert direct == blk


def test_auto_with_hot_series_equals_direct(spark):
    ev = events_series(spark, SF001)
    spec = events_spec(8, 3)
    direct = _set(W.sequence_windows(ev, spec, plan="direct"), spec)
    auto = _set(W.sequence_windows(ev, spec, plan="auto", hot_rows=60, block_rows=5, bucket_rows=9), spec)
    assert direct == auto


def test_auto_over_broadcast_bound_uses_shuffle_join(spark):
    ev = events_series(spark, SF001)
    spec = events_spec(8, 3)
    direct = _set(W.sequence_windows(ev, spec, plan="direct"), spec)
    auto = _set(W.sequence_windows(ev, spec, plan="auto", hot_rows=10, block_rows=5, bucket_rows=9,
                                   max_hot_keys=2), spec)
    assert direct == auto


def test_independent_of_input_partitioning(spark):
    ev = events_series(spark, SF001)
    spec = events_spec(8, 3)
    a = _set(W.sequence_windows(ev.repartition(3), spec, plan="direct"), spec)
    b = _set(W.sequence_windows(ev.repartition(7, "event_id"), spec, plan="direct"), spec)
    assert a == b


def test_series_alone_equals_series_in_full_run(spark):
    ev = events_series(spark, SF001)
    spec = events_spec(8, 3)
    full = _set(W.sequence_windows(ev, spec, plan="direct"), spec)
    one = _set(W.sequence_windows(ev.filter(F.col("symbol") == 7), spec, plan="direct"), spec)
    assert one and one == {k: v for k, v in full.items() if k[0] == 7}


def test_number_rows_matches_row_number(spark):
    ev = events_series(spark, SF001)
    spec = events_spec()
    ref = {(r["symbol"], r["event_id"]): r["rn"] for r in W.row_numbers(ev, spec).collect()}
    got = number_rows(ev, ["symbol"], ["s_ts", "event_id"], hot_rows=30, bucket_rows=4)
    rows = got.collect()
    assert {(r["symbol"], r["event_id"]): r["rn"] for r in rows} == ref
    sizes = {r["symbol"]: r["c"] for r in ev.groupBy("symbol").agg(F.count("*").alias("c")).collect()}
    assert all(r["n"] == sizes[r["symbol"]] for r in rows)


def test_short_and_exact_series(spark):
    rows = [("s", i, float(i)) for i in range(5)] + [("t", i, float(i)) for i in range(3)]
    df = spark.createDataFrame(rows, "symbol string, i long, v double")
    from sequor.params import SequenceSpec

    spec = SequenceSpec(series=("symbol",), order=("i",), features=("v",), label="v", past=3, future=2)
    out = W.sequence_windows(df, spec, plan="direct").collect()
    assert [(r["symbol"], r["rn"]) for r in out] == [("s", 3)]  # n = P + F gives one window
    p1 = W.sequence_windows(df, spec.with_(past=1, future=1), plan="direct").count()
    assert p1 == 4 + 2
    assert W.sequence_windows(df.limit(0), spec, plan="auto").count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_direct_plan_one_window_one_exchange_no_python(spark):
    ev = events_series(spark, SF001)
    out = W.sequence_windows(ev, events_spec(60, 3), plan="direct")
    plan = _plan(out)
    assert plan.count("Window [") == 1, plan
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_auto_plan_without_hot_series_is_direct(spark):
    ev = events_series(spark, SF001)
    plan = _plan(W.sequence_windows(ev, events_spec(60, 3), plan="auto"))
    assert plan.count("Window [") == 1 and "Union" not in plan


def test_auto_plan_hot_rows_never_hashed_by_series_alone(spark):
    ev = events_series(spark, SF001)
    plan = _plan(W.sequence_windows(ev, events_spec(8, 3), plan="auto", hot_rows=60, block_rows=5, bucket_rows=9))
    # cold rows: anti join against the broadcast hot list *before* the series exchange
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "_sq_pid" in plan and plan.count("Window ") == 2 and "boundary" in plan  # hot rows come as blocks of arrays


def test_observed_run_metrics(spark):
    ev = events_series(spark, SF001)
    out, m_in, m_out = W.sequence_windows_observed(ev, events_spec(60, 3), plan="direct")
    out.write.format("noop").mode("overwrite").save()
    assert m_in.get["rows_in"] == 1000 and m_in.get["null_time"] == 0
    assert m_out.get["windows_out"] == 93
    sizes = [r["c"] for r in ev.groupBy("symbol").agg(F.count("*").alias("c")).collect()]
    assert m_in.get["series"] == 15 and m_in.get["short_series"] == sum(1 for n in sizes if n < 60 + 3) > 0
    assert m_in.get["anchors_in_range"] == 93 and m_in.get["anchors_with_null"] == 0
    nully = events_series(spark, SF001, error_value_missing=True)
    out, m_in, m_out = W.sequence_windows_observed(nully, events_spec(8, 3), plan="direct", name="nully")
    out.write.format("noop").mode("overwrite").save()
    assert m_in.get["anchors_in_range"] == 850
    assert m_in.get["anchors_with_null"] == 850 - m_out.get["windows_out"] > 0
    expected = {**m_in.get, **m_out.get}
    for plan, kw in (("auto", {"hot_rows": 66, "block_rows": 9, "bucket_rows": 44}), ("blocked", {"block_rows": 9, "bucket_rows": 44}), ("auto", {})):
        out, m_in, m_out = W.sequence_windows_observed(nully, events_spec(8, 3), plan=plan, name="routed", **kw)
        out.write.format("noop").mode("overwrite").save()
        assert {**m_in.get, **m_out.get} == expected, (plan, kw)


def test_building_blocks_skew_safe_equal_direct(spark):
    ev = events_series(spark, SF001)
    spec = events_spec(8, 3)
    hot = {"hot_rows": 50, "block_rows": 7, "bucket_rows": 11}
    for fn, col in ((W.feature_sequences, "ohlc_pcr"), (W.label_sequence, spec.label_col)):
        a = {(r["symbol"], r["event_id"]): r[col] for r in fn(ev, spec, plan="direct").collect()}
        b = {(r["symbol"], r["event_id"]): r[col] for r in fn(ev, spec, plan="auto", **hot).collect()}
        assert a == b and len(a) == 1000
    rn_a = {(r["symbol"], r["event_id"]): (r["rn"], r["n"]) for r in W.row_numbers(ev, spec, n_name="n").collect()}
    rn_b = {(r["symbol"], r["event_id"]): (r["rn"], r["n"])
            for r in W.row_numbers(ev, spec, n_name="n", hot_rows=50, bucket_rows=11).collect()}
    assert rn_a == rn_b


def test_string_and_nan_orders_are_split(spark):
    """Orders that begin with a string, or with a double that holds NaN and NULL, split like any other."""
    rows = [("s" if i % 3 else None, f"k{i * 7 % 100:02d}", float("nan") if i % 5 == 0 else None if i % 7 == 0 else float(i % 4), i, float(i))
            for i in range(300)]
    df = spark.createDataFrame(rows, "symbol string, key string, t double, id long, v double").repartition(4)
    from sequor.params import SequenceSpec
    from sequor.plans import ranges as RA

    for order in (("key", "id"), ("t", "key", "id"), ("t", "id")):
        spec = SequenceSpec(series=("symbol",), order=order, features=("v",), label="v", past=3, future=2)
        ref = {r["id"]: (r["rn"], r["n"]) for r in W.row_numbers(df, spec, n_name="n").collect()}
        got = {r["id"]: (r["rn"], r["n"]) for r in W.row_numbers(df, spec, n_name="n", hot_rows=20, bucket_rows=15).collect()}
        assert got == ref
        sizes = [r["c"] for r in RA.placed_rows(df, ["symbol"], order, 15).groupBy(F.shiftright(RA.PLACE, 33)).agg(F.count("*").alias("c")).collect()]
        assert max(sizes) <= 2 * 15 and sum(sizes) == 300
        direct = {(r["symbol"], r["rn"]): (r["v"], r["v_label"]) for r in W.sequence_windows(df, spec, plan="direct").collect()}
        auto = W.sequence_windows(df, spec, plan="auto", hot_rows=20, block_rows=7, bucket_rows=15)
        assert {(r["symbol"], r["rn"]): (r["v"], r["v_label"]) for r in auto.collect()} == direct


def test_rows_move_once(spark):
    """The block table takes one exchange of the rows; the windows of inner blocks take none."""
    from sequor.plans import ranges as RA

    spec = events_spec(8, 3).with_(series=("stream",))
    ev = events_series(spark, SF001).withColumn("stream", F.lit("all"))
    moved = RA.range_sorted(ev, spec.series, spec.order, 7)._jdf.queryExecution().executedPlan().toString()
    assert moved.count("Exchange rangepartitioning") == 1 and moved.count("Exchange") == 1
    blocks = RA.block_arrays(ev, spec, 7, 20)
    keys = ["_s0"]
    counted = blocks.groupBy(*keys, RA.PID).agg(F.sum("own").alias(RA.COUNT))
    pieces, known = RA.located(counted, keys)
    assert sum(r[RA.COUNT] for r in known) == 1000
    assert sorted(map(tuple, pieces.collect())) == sorted(map(tuple, RA.with_offsets(counted, keys).collect()))
    border = blocks.filter("first or last")
    assert border.count() <= 2 * pieces.count() < blocks.count()
    inner = RA.NB.join_on(blocks, pieces.drop(RA.COUNT), [*keys, RA.PID], "inner", broadcast=True)
    plan = RA._slices(inner, spec, True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and "Python" not in plan and "Window" not in plan


def test_block_cuts_leave_enough_rows():
    from sequor.plans.ranges import cut_blocks

    for past, ahead, block, n in ((5, 2, 4, 23), (1, 1, 3, 10), (3, 7, 8, 40), (60, 3, 100, 61)):
        found, a = cut_blocks((0, n, 0, True), block, past, ahead)
        assert a == n and [b[4] for b in found] == [False] * (len(found) - 1) + [True]
        at = 0
        for first, before, own, after, last in found:
            assert first + before == at and before == min(at, past - 1)
            assert after == (0 if last else ahead) and at + own + after <= n
            at += own
        assert at == n
        held, _ = cut_blocks((0, n, 0, False), block, past, ahead)  # the piece may go on: nothing is cut that rows to come change
        assert held == [b for b in found if not b[4]]


def test_series_count_skew_safe(spark):
    ev = events_series(spark, SF001)
    spec = events_spec()
    sizes = {r["symbol"]: r["c"] for r in ev.groupBy("symbol").agg(F.count("*").alias("c")).collect()}
    for kw in ({}, {"hot_rows": 40, "bucket_rows": 9}):
        rows = W.series_count(ev, spec, **kw).collect()
        assert len(rows) == 1000 and all(r["n"] == sizes[r["symbol"]] for r in rows)


def test_equal_timestamps_are_split(spark):
    """A hot series whose rows share few timestamps: buckets split on the tie-break."""
    from sequor.params import SequenceSpec

    rows = [("hot", f"2020-01-0{1 + i // 400} 00:00:00", i, float(i)) for i in range(1200)]
    rows += [("hot", None, 5000 + i, -1.0) for i in range(30)]
    rows += [("cold", f"2020-01-01 00:00:{i:02d}", i, float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "s string, t string, k long, v double").select(
        "s", F.col("t").cast("timestamp_ntz").alias("t"), "k", "v")
    from sequor.plans import ranges as RA

    out = number_rows(df, ["s"], ["t", "k"], hot_rows=100, bucket_rows=50)
    ref = {(r["s"], r["k"]): r["rn"] for r in W.row_numbers(df, SequenceSpec(series=("s",), order=("t", "k")),
                                                             hot_rows=10**9).collect()}
    got = out.collect()
    assert {(r["s"], r["k"]): r["rn"] for r in got} == ref
    placed = RA.placed_rows(df.filter("s = 'hot'"), ["s"], ["t", "k"], 50)
    sizes = [r["c"] for r in placed.groupBy(F.shiftright(RA.PLACE, 33)).agg(F.count("*").alias("c")).collect()]
    assert max(sizes) <= 2 * 50, max(sizes)  # 400-row same-time bursts were split
    spec = SequenceSpec(series=("s",), order=("t", "k"), features=("v",), label="v", past=5, future=2)
    a = {(r["s"], r["rn"]): r["v"] for r in W.sequence_windows(df, spec, plan="direct").collect()}
    b = {(r["s"], r["rn"]): r["v"] for r in W.sequence_windows(df, spec, plan="auto", hot_rows=100,
                                                                block_rows=64, bucket_rows=50).collect()}
    assert a == b


def test_number_rows_mixed_hot_and_cold_sizes(spark):
    """Series of 51-88 rows with hot_rows=60, bucket_rows=16: cold series larger
    than twice bucket_rows keep one bucket and their true size."""
    ev = events_series(spark, SF001)
    spec = events_spec()
    ref = {(r["symbol"], r["event_id"]): (r["rn"], r["n"])
           for r in W.row_numbers(ev, spec, n_name="n", hot_rows=10**9).collect()}
    got = number_rows(ev, ["symbol"], ["s_ts", "event_id"], hot_rows=60, bucket_rows=16).collect()
    assert {(r["symbol"], r["event_id"]): (r["rn"], r["n"]) for r in got} == ref


def test_null_series_key_kept_whole(spark):
    """A NULL series key never matches a join; its rows must still be windowed once."""
    ev = events_series(spark, SF001).withColumn(
        "symbol", F.when(F.col("symbol") < 3, F.lit(None).cast("long")).otherwise(F.col("symbol")))
    spec = events_spec(8, 3)
    direct = _set(W.sequence_windows(ev, spec, plan="direct"), spec)
    assert any(k[0] is None for k in direct)
    auto = _set(W.sequence_windows(ev, spec, plan="auto", hot_rows=60, block_rows=5, bucket_rows=9), spec)
    assert direct == auto
    rn = {(r["symbol"], r["event_id"]): (r["rn"], r["n"]) for r in W.row_numbers(ev, spec, n_name="n").collect()}
    rn_hot = {(r["symbol"], r["event_id"]): (r["rn"], r["n"])
              for r in W.row_numbers(ev, spec, n_name="n", hot_rows=60, bucket_rows=9).collect()}
    assert rn == rn_hot


def test_null_series_key_hot_path_and_fallback(spark):
    from sequor.plans import numbering as NB

    ev = events_series(spark, SF001).withColumn(
        "symbol", F.when(F.col("symbol") < 4, F.lit(None).cast("long")).otherwise(F.col("symbol")))
    out = NB.number_rows(ev, ["symbol"], ["s_ts", "event_id"], hot_rows=60, bucket_rows=9).collect()
    assert len(out) == 1000
    from sequor.plans import ranges as RA

    placed = RA.placed_rows(ev.filter("symbol is null"), ["symbol"], ["s_ts", "event_id"], 9)
    assert placed.select(F.shiftright(RA.PLACE, 33)).distinct().count() > 1  # the NULL series was split
    # fallback offsets path (no collected counts): NULL-key rows kept and numbered
    tagged = ev.withColumn(NB.BUCKET, F.array((F.col("event_id") % 3).cast("long")))
    got = NB.number_bucketed(tagged, ["symbol"], ["s_ts", "event_id"], rn="rn", total="n").collect()
    assert len(got) == 1000
    nulls = sorted(r["rn"] for r in got if r["symbol"] is None)
    assert nulls == list(range(1, len(nulls) + 1)) and len(nulls) > 0
