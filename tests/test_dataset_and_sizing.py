"""Split, dataset feeding and sizing goldens (FIXTURES §2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sequor.functions.dates import is_valid_mdy, parse_mdy, format_mdy
from sequor.operators import dataset as DS
from sequor.operators.projections import channel_dir
from sequor.operators.split import split_chronological
from sequor.params import TrainingParams


def test_sizing_goldens(spark):
    df = spark.createDataFrame([(9,), (63,), (64,), (1000,)], "ds_len long")
    got = {r["ds_len"]: (r["max_steps"], r["shuffle_buffer"]) for r in DS.sizing(df).collect()}
    assert got == {9: (0, 0), 63: (0, 6), 64: (1, 6), 1000: (15, 100)}


def test_max_steps_equals_python_formula(spark):
    n = list(range(0, 5000, 7))
    df = spark.createDataFrame([(x,) for x in n], "ds_len long")
    got = {r["ds_len"]: r["max_steps"] for r in DS.sizing(df).collect()}
    assert all(got[x] == int(10 * ((x / 10) / 64)) for x in n)


def test_date_goldens(spark):
    df = spark.createDataFrame([("05-13-20",), ("13-05-20",), ("foo",), ("5-3-20",), ("02-30-20",),
                                ("05-13-2020",), (None,)], "t string")
    got = {r["t"]: r["ok"] for r in df.select("t", is_valid_mdy("t").alias("ok")).collect()}
    assert got == {"05-13-20": True, "13-05-20": False, "foo": False, "5-3-20": True,
                   "02-30-20": False, "05-13-2020": False, None: False}
    r = df.filter("t = '05-13-20'").select(parse_mdy("t").alias("d"), format_mdy(parse_mdy("t")).alias("s")).first()
    assert r["d"] == dt.date(2020, 5, 13) and r["s"] == "05-13-20"


def test_channel_alias(spark):
    df = spark.createDataFrame([("train",), ("eval",), ("test",), ("other",)], "c string")
    assert [r[0] for r in df.select(channel_dir("c")).collect()] == ["train", "evaluation", "validation", "other"]


def test_split_fractions(spark):
    df = spark.range(0, 10).select(F.lit("s").alias("k"), F.col("id").alias("t"))
    out = split_chronological(df, ["k"], ["t"], TrainingParams(test_size=0.2, val_size=0.2))
    got = {r["t"]: r["channel"] for r in out.collect()}
    assert [got[i] for i in range(10)] == ["train"] * 6 + ["eval"] * 2 + ["test"] * 2
    with pytest.raises(ValueError):
        split_chronological(df, ["k"], ["t"], TrainingParams(test_size=0.205, val_size=0.2))


def _recs(spark, n):
    return spark.range(0, n).select(F.col("id").alias("key"))


def test_batches_exact_and_short(spark):
    p = TrainingParams(batch_size=4, epochs=2)
    assert DS.batches(_recs(spark, 3), ["key"], p).count() == 0  # n < batch: no batch
    out = DS.batches(_recs(spark, 8), ["key"], p).collect()      # exactly two full batches per epoch
    assert len(out) == 16
    for e in (1, 2):
        rows = [r for r in out if r["epoch"] == e]
        assert sorted(r["pos"] for r in rows) == list(range(1, 9))
        assert sorted({r["batch_id"] for r in rows}) == [0, 1]
    assert sorted({r["step"] for r in out}) == [0, 1, 2, 3]


def test_batches_drop_remainder_and_order(spark):
    p = TrainingParams(batch_size=4, epochs=3, seed=13)
    out = DS.batches(_recs(spark, 10), ["key"], p, prefix_digits=1).collect()
    assert len(out) == 3 * 8
    # order inside an epoch follows the md5 key; epochs reshuffle
    import hashlib

    for e in (1, 2, 3):
        keys = sorted(range(10), key=lambda k: hashlib.md5(f"13|{e}|{k}".encode()).hexdigest())
        rows = sorted((r for r in out if r["epoch"] == e), key=lambda r: r["pos"])
        assert [r["key"] for r in rows] == keys[:8]


def test_step_cap(spark):
    p = TrainingParams(batch_size=2, epochs=3)
    out = DS.batches(_recs(spark, 10), ["key"], p, max_steps=7)
    assert sorted({r["step"] for r in out.collect()}) == list(range(7))


def test_bucket_digits():
    assert DS.bucket_digits(10) == 1
    assert DS.bucket_digits(16 * 1_000_000) == 1
    assert DS.bucket_digits(16 * 1_000_000 + 1) == 2
    assert DS.bucket_digits(10**12) == 5  # 10**12 / 16**5 = 0.95 M rows per bucket
    assert DS.bucket_digits(10**18) == 8


def test_a_step_cap_makes_no_epoch_beyond_it(spark):
    p = TrainingParams(batch_size=4, epochs=1000)
    out = DS.batches(_recs(spark, 10), ["key"], p, max_steps=5)  # 2 steps an epoch
    assert "sequence(1, 3" in out._jdf.queryExecution().optimizedPlan().toString() or out.agg(F.max("epoch")).first()[0] == 3
    assert {r["step"] for r in out.collect()} == set(range(5))
    assert DS.epochs_within(3, 4, 50) == 1 and DS.epochs_within(8, 4, 50) == 25


def test_unshuffled_batches_keep_the_record_order(spark):
    p = TrainingParams(batch_size=4, epochs=2)
    out = DS.batches(_recs(spark, 11).repartition(3), ["key"], p, shuffle=False, rows_per_bucket=3).collect()
    assert sorted((r["epoch"], r["key"], r["pos"], r["batch_id"], r["step"]) for r in out) == [
        (e, k, k + 1, k // 4, (e - 1) * 2 + k // 4) for e in (1, 2) for k in range(8)]
    capped = DS.batches(_recs(spark, 11), ["key"], p, shuffle=False, max_steps=3).collect()
    assert {r["step"] for r in capped} == {0, 1, 2}
