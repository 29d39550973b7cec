"""Micro goldens (FIXTURES §2) and the NULL policies."""

import pytest
from pyspark.sql import functions as F

from sequor.operators import windows as W
from sequor.params import SequenceSpec
from sequor.sources.csv_series import read_series_csv, series_schema

from .conftest import write_micro_csv

SPEC = SequenceSpec(series=("sym",), order=("s_ts",), features=("a", "b"), label="a", past=3, future=2)


def micro(spark, tmp_dir, **kw):
    path = write_micro_csv(f"{tmp_dir}/micro.csv", **kw)
    df = read_series_csv(spark, path, schema=series_schema(("a", "b")), quarantine=True)
    return df.withColumn("sym", F.lit("s1"))


def rows_by_rn(df):
    return {r["rn"]: r for r in df.collect()}


def test_csv_read_nulls_and_quarantine(spark, tmp_dir):
    df = micro(spark, tmp_dir)
    rows = df.orderBy("s_ts").collect()
    assert rows[4]["a"] is None and rows[4]["b"] == 40.0
    assert rows[6]["b"] is None and rows[6]["a"] == 6.0
    assert rows[6]["_corrupt_record"] is not None
    assert rows[5]["_corrupt_record"] is None


@pytest.mark.parametrize("plan", ["direct", "blocked", "auto"])
def test_keep_mode_reference_behaviour(spark, tmp_dir, plan):
    df = micro(spark, tmp_dir)
    kw = {"block_rows": 2, "bucket_rows": 3} if plan == "blocked" else {}
    out = W.sequence_windows(df, SPEC.with_(on_null="keep"), plan=plan, **kw)
    got = rows_by_rn(out)
    assert sorted(got) == [3, 4, 5, 6, 7, 8]
    expect = {
        3: ([0, 1, 2], [0, 10, 20], [3]),
        4: ([1, 2, 3], [10, 20, 30], [5]),
        5: ([2, 3], [20, 30, 40], [5, 6]),
        6: ([3, 5], [30, 40, 50], [6, 7]),
        7: ([5, 6], [40, 50], [7, 8]),
        8: ([5, 6, 7], [50, 70], [8, 9]),
    }
    for rn, (a, b, y) in expect.items():
        assert got[rn]["a"] == a and got[rn]["b"] == b and got[rn]["a_label"] == y, rn


def test_drop_mode_removes_ragged(spark, tmp_dir):
    out = W.sequence_windows(micro(spark, tmp_dir), SPEC, plan="direct")
    assert out.count() == 0


def test_fail_mode_raises(spark, tmp_dir):
    out = W.sequence_windows(micro(spark, tmp_dir), SPEC.with_(on_null="fail"), plan="direct")
    with pytest.raises(Exception, match="shorter than requested"):
        out.collect()


def test_clean_variant_well_formed(spark, tmp_dir):
    df = micro(spark, tmp_dir, blank_a=False, bad_b=False)
    for plan in ("direct", "blocked"):
        kw = {"block_rows": 1, "bucket_rows": 2} if plan == "blocked" else {}
        got = rows_by_rn(W.sequence_windows(df, SPEC, plan=plan, **kw))
        assert sorted(got) == [3, 4, 5, 6, 7, 8]
        for rn, r in got.items():
            assert r["a"] == [rn - 3.0, rn - 2.0, rn - 1.0]
            assert r["b"] == [10.0 * (rn - 3), 10.0 * (rn - 2), 10.0 * (rn - 1)]
            assert r["a_label"] == [float(rn), float(rn + 1)]


def test_label_before_feature_overwrite(spark, tmp_dir):
    """The label base is also a feature; its label must come from raw values."""
    df = micro(spark, tmp_dir, blank_a=False, bad_b=False)
    r = rows_by_rn(W.sequence_windows(df, SPEC, plan="direct"))[5]
    assert r["a_label"] == [5.0, 6.0] and r["a"] == [2.0, 3.0, 4.0]


def test_keys_dropped(spark, tmp_dir):
    df = micro(spark, tmp_dir, blank_a=False, bad_b=False)
    out = W.sequence_windows(df, SPEC.with_(keep_keys=False), plan="direct")
    assert out.columns == ["a", "b", "a_label"]


def test_stride_and_shift(spark, tmp_dir):
    df = micro(spark, tmp_dir, blank_a=False, bad_b=False)
    out = W.sequence_windows(df, SPEC.with_(step=2, shift=2), plan="direct")
    got = rows_by_rn(out)
    # anchors rn >= 3, rn <= 10 - 2 - 2 + 1 = 7, every 2nd from 3
    assert sorted(got) == [3, 5, 7]
    assert got[3]["a_label"] == [4.0, 5.0]


def test_null_time_sorts_first(spark):
    rows = [("s", None, 100.0)] + [("s", f"2020-01-01 00:00:0{i}", float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "sym string, t string, v double").select(
        "sym", F.col("t").cast("timestamp_ntz").alias("t"), "v")
    spec = SequenceSpec(series=("sym",), order=("t",), features=("v",), label="v", past=2, future=1)
    for plan, kw in (("direct", {}), ("blocked", {"block_rows": 2, "bucket_rows": 2})):
        got = rows_by_rn(W.sequence_windows(df, spec, plan=plan, **kw))
        assert got[2]["v"] == [100.0, 0.0], plan


def test_duplicate_times_ordered_by_tie_break(spark):
    # four rows share one timestamp; the tie-break column makes the order total
    rows = [("s", "2020-01-01 00:00:00", k, float(k)) for k in (3, 1, 2, 0)]
    rows += [("s", "2020-01-01 00:00:01", 4, 4.0)]
    df = spark.createDataFrame(rows, "sym string, t string, k long, v double").select(
        "sym", F.col("t").cast("timestamp_ntz").alias("t"), "k", "v")
    spec = SequenceSpec(series=("sym",), order=("t", "k"), features=("v",), label="v", past=2, future=1)
    for plan, kw in (("direct", {}), ("blocked", {"block_rows": 1, "bucket_rows": 1})):
        got = rows_by_rn(W.sequence_windows(df.repartition(3), spec, plan=plan, **kw))
        assert {rn: (r["v"], r["v_label"]) for rn, r in got.items()} == {
            2: ([0.0, 1.0], [2.0]), 3: ([1.0, 2.0], [3.0]), 4: ([2.0, 3.0], [4.0])}, plan


@pytest.mark.parametrize("mode", ["keep", "drop"])
def test_nested_layout_equals_converted(spark, tmp_dir, mode):
    from sequor.sources.sinks import to_record_layout

    df = micro(spark, tmp_dir)
    for feats in (("a", "b"), ("a", "b", "a2", "b2")):
        d2 = df.withColumn("a2", F.col("a") * 2).withColumn("b2", F.col("b") * 2)
        spec = SPEC.with_(features=feats, on_null=mode)
        flat = to_record_layout(W.sequence_windows(d2, spec, plan="direct"), spec, keep=["rn"])
        nest = to_record_layout(W.sequence_windows(d2, spec.with_(nested=True), plan="direct"), spec, keep=["rn"])
        assert nest.schema.simpleString() == flat.schema.simpleString()
        assert sorted(map(tuple, nest.collect())) == sorted(map(tuple, flat.collect()))
