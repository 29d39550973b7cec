"""Work that must stay in proportion to the rows, whatever sizes are asked for."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sequor.operators import windows as W
from sequor.plans import ranges as RA
from sequor.plans.numbering import number_rows
from sequor.sources.tables import events_series, events_spec

SF001 = "/root/testdata/sf0.001"


def test_tasks_stay_in_proportion_to_the_rows():
    assert RA.range_count(300, 15) == 30  # few rows: every range is a task
    for asked in (8, 16, 244, 1_000, 4_000):
        for rows in (10**6, 36 * 10**6, 216 * 10**6):
            assert RA.range_count(rows, asked) <= max(RA.FEW_TASKS, 2 * rows // RA.TASK_ROWS)
    assert RA.range_count(10**9, 10**6) == 1500  # larger ranges stay as asked for


@pytest.fixture
def few_tasks(monkeypatch):
    monkeypatch.setattr(RA, "FEW_TASKS", 3)


def test_ranges_that_share_a_task(spark, few_tasks):
    """Numbers and windows are those of the plain plans where one task holds many ranges."""
    ev = events_series(spark, SF001).withColumn("symbol", F.when(F.col("symbol") > 1, F.col("symbol")))
    spec = events_spec(8, 3)
    rows = lambda df: {(r["symbol"], r["event_id"]): (r["rn"], r["n"]) for r in df.collect()}
    assert RA.range_count(1000, 7) == 3
    assert rows(number_rows(ev, ["symbol"], ["s_ts", "event_id"], hot_rows=20, bucket_rows=7)) == rows(W.row_numbers(ev, spec, n_name="n"))
    windows = lambda df: {(r["symbol"], r["rn"]): (r["ohlc_close"], r[spec.label_col]) for r in df.collect()}
    hot = W.sequence_windows(ev, spec, plan="auto", hot_rows=20, block_rows=16, bucket_rows=20)
    assert windows(hot) == windows(W.sequence_windows(ev, spec, plan="direct"))


def test_summaries_add_up_like_the_lambdas(spark):
    """Sums of whole Arrow columns equal the left-to-right sums of each array, to the last bit."""
    import random

    import pyarrow as pa

    from sequor.functions.arrays import array_moment, array_sum, list_sums

    r = random.Random(4)
    some = [[r.uniform(-1e6, 1e6) for _ in range(60)] for _ in range(200)]
    mixed = some[:5] + [[], None, [float("nan"), 1.0], [float("inf"), 2.0], [1.0, None], [-0.0], some[6][:7]]
    for lists in (some, mixed, [], [[], []]):
        df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i long, x array<double>")
        ref = {row["i"]: (repr(row["s"]), repr(row["m"])) for row in df.select("i", array_sum("x").alias("s"), array_moment("x").alias("m")).collect()}
        s, m = list_sums(pa.array(lists, pa.list_(pa.float64())))
        assert {i: (repr(a), repr(b)) for i, (a, b) in enumerate(zip(s.to_pylist(), m.to_pylist()))} == ref


def test_window_summary_runs_no_lambda_per_element(spark):
    from sequor.summaries import window_summary

    spec = events_spec(8, 3)
    plan = window_summary(W.sequence_windows(events_series(spark, SF001), spec), spec)._jdf.queryExecution().executedPlan().toString()
    assert "aggregate(" not in plan and "lambda" not in plan


def test_many_epochs_move_narrow_rows_once(spark):
    """Beyond the probe's table of 3 digits rows still move once, without their key."""
    from sequor.operators import dataset as DS
    from sequor.params import TrainingParams

    assert DS.probe_digits(2) == 3 and DS.probe_digits(30) == 2 and DS.probe_digits(400) == 1 and DS.probe_digits(10**5) == 0
    df = spark.range(100).select(F.col("id").alias("k"))
    for epochs in (30, 400):
        out = DS.batches(df, ["k"], TrainingParams(epochs=epochs, batch_size=8))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_COL") == 1 and "SortMergeJoin" not in plan and "Generate" in plan
        assert "shuffle_key" not in plan.split("REPARTITION_BY_COL")[1]
    got = out.filter("epoch in (1, 399)").collect()
    for e in (1, 399):
        mine = sorted((r["pos"], r["shuffle_key"], r["k"]) for r in got if r["epoch"] == e)
        assert [p for p, _, _ in mine] == list(range(1, 97)) and [k for _, k, _ in mine] == sorted(k for _, k, _ in mine)


def test_tfrecord_tasks_hold_few_records():
    """Reading holds a bounded list of records, and checks all of them."""
    import io

    import pyarrow as pa
    from pyspark.sql import types as T

    from sequor.sources import tfrecord as TR

    recs = [bytes([i % 250]) * (i % 40) for i in range(1300)]
    blob = TR.frame_records(recs)
    lists = list(TR.read_records(io.BytesIO(blob)))
    assert [len(x) for x in lists] == [512, 512, 276] and [r for x in lists for r in x] == recs
    assert max(sum(map(len, x)) for x in TR.read_records(io.BytesIO(blob), batch_bytes=100)) < 140
    for bad in (blob[:-1], blob[:-20] + b"x" + blob[-19:]):
        with pytest.raises(ValueError):
            list(TR.read_records(io.BytesIO(bad)))
    import tempfile

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.ArrayType(T.ArrayType(T.FloatType())))])
    path = tempfile.mkdtemp()
    batch = pa.RecordBatch.from_pylist([{"k": i if i % 3 else None, "v": [[float(i)], [0.5]]} for i in range(1100)])
    writer = TR.TFRecordWriter(path, schema, True, 512)
    writer.commit([writer.write(iter([batch]))])
    reader = TR.TFRecordReader(path, schema, True)
    got = [b for p in reader.partitions() for b in reader.read(p)]
    assert [b.num_rows for b in got] == [512, 512, 76] and [r for b in got for r in b.to_pylist()] == batch.to_pylist()


def test_moments_held_by_a_task_stay_small():
    from sequor.operators import moments as M

    spec = events_spec(8, 3)
    assert M.most_held(spec) * 8 * (8 * 7 + 3) ** 2 <= 8 << 20
