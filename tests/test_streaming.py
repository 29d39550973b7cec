"""File-triggered streaming transform equals the batch transform, and resumes."""

from sequor.operators import windows as W
from sequor.params import SequenceSpec
from sequor.sources.csv_series import series_schema
from sequor.sources.layout import LAYOUT_COLS, read_layout
from sequor.streaming.transform_stream import start_transform_stream

from .conftest import write_micro_csv

SPEC = SequenceSpec(series=LAYOUT_COLS, order=("s_ts",), features=("a", "b"), label="a", past=3, future=2)


def _key(r):
    return (r["channel"], r["date"], r["symbol"], r["rn"])


def test_stream_equals_batch_and_resumes(spark, tmp_dir):
    src, sink, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    write_micro_csv(f"{src}/train/price/bn/05-13-20/ada.csv", blank_a=False, bad_b=False)
    write_micro_csv(f"{src}/train/price/bn/05-13-20/adx.csv", blank_a=False, bad_b=True)
    schema = series_schema(("a", "b"))
    q = start_transform_stream(spark, src, sink, SPEC, schema, checkpoint=ckpt)
    q.awaitTermination()
    got = spark.read.parquet(sink)
    assert got.count() == 6 + 4  # adx: the 2 anchors whose frames hold the NULL b are dropped
    write_micro_csv(f"{src}/evaluation/price/bn/05-14-20/ada.csv", blank_a=False, bad_b=False)
    q = start_transform_stream(spark, src, sink, SPEC, schema, checkpoint=ckpt)
    q.awaitTermination()
    got = spark.read.parquet(sink)
    assert got.select("batch_id").distinct().count() == 2  # second run only saw the new file
    batch = W.sequence_windows(read_layout(spark, src, schema=schema), SPEC, plan="direct")
    assert {_key(r) for r in got.collect()} == {_key(r) for r in batch.collect()}
    assert got.count() == 16
