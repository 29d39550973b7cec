"""End-to-end jobs."""

from pyspark.sql import functions as F

from sequor.operators import windows as W
from sequor.operators.split import split_chronological
from sequor.params import SequenceSpec, TrainingParams
from sequor.plans.jobs import fit_evaluate_export, transform_tree
from sequor.sources.csv_series import series_schema
from sequor.sources.tables import events_series, events_spec
from sequor.sources.tfrecord import read_tfrecords

from .conftest import SF001, write_micro_csv

SPEC = SequenceSpec(order=("s_ts",), features=("a", "b"), label="a", past=3, future=2)


def test_transform_tree_parquet_and_tfrecord(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    for ch, date, sym in (("train", "05-13-20", "ada"), ("train", "05-14-20", "ada"),
                          ("evaluation", "05-13-20", "adx"), ("validation", "05-13-20", "ada")):
        write_micro_csv(f"{src}/{ch}/price/bn/{date}/{sym}.csv", blank_a=False, bad_b=False)
    schema = series_schema(("a", "b"))
    m = transform_tree(spark, src, f"{tmp_dir}/pq", SPEC, schema, channel="train")
    assert m["rows_in"] == 20 and m["windows_out"] == 12
    back = spark.read.parquet(f"{tmp_dir}/pq")
    assert back.count() == 12 and {r[0] for r in back.select("date").distinct().collect()} == {"05-13-20", "05-14-20"}
    r = back.filter("rn = 3 AND date = '05-13-20'").first()
    assert r["a"] == [[0.0], [1.0], [2.0]] and r["a_label"] == [[3.0], [4.0]]
    m = transform_tree(spark, src, f"{tmp_dir}/tfr", SPEC, schema, dates="05-13-20", fmt="tfrecord")
    assert m["windows_out"] == 18
    tfr = read_tfrecords(spark, f"{tmp_dir}/tfr", back.drop("channel", "date").schema)
    assert tfr.count() == 18
    got = {(r["symbol"], r["s_ts"], r["rn"]): r["a"] for r in tfr.collect()}
    pq = transform_tree(spark, src, f"{tmp_dir}/pq2", SPEC, schema, dates="05-13-20")
    ref = {(r["symbol"], r["s_ts"], r["rn"]): r["a"] for r in spark.read.parquet(f"{tmp_dir}/pq2").collect()}
    assert pq["windows_out"] == 18 and got == ref


def test_fit_evaluate_export(spark, tmp_dir):
    ev = events_series(spark, SF001)
    sp = split_chronological(ev, ["symbol"], ["s_ts", "event_id"], TrainingParams())
    spec = events_spec(8, 3).with_(series=("symbol", "channel"))
    win = W.sequence_windows(sp, spec).withColumn("ts_us", F.col("rn"))
    metrics = {r["channel"]: r for r in fit_evaluate_export(win, spec, f"{tmp_dir}/models", 7, keys=("ts_us",)).collect()}
    assert set(metrics) <= {"eval", "test"} and all(r["n"] > 0 for r in metrics.values())
    models = spark.read.parquet(f"{tmp_dir}/models")
    assert {r[0] for r in models.select("version").distinct().collect()} == {7}


def test_metrics_come_from_the_exported_fit(spark, tmp_dir):
    """The held-out rows are scored with the rows as exported; nothing of the fit is in that plan."""
    ev = events_series(spark, SF001)
    sp = split_chronological(ev, ["symbol"], ["s_ts", "event_id"], TrainingParams())
    spec = events_spec(8, 3).with_(series=("symbol", "channel"))
    win = W.sequence_windows(sp, spec).withColumn("ts_us", F.col("rn"))
    first = fit_evaluate_export(win, spec, f"{tmp_dir}/models", 1, keys=("ts_us",))
    assert "regr_slope" not in first._jdf.queryExecution().optimizedPlan().toString()
    again = fit_evaluate_export(win, spec, f"{tmp_dir}/models", 2, keys=("ts_us",))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
