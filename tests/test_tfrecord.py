"""TFRecord sequence-example source and sink."""

import pytest
from pyspark.sql import functions as F

from sequor.operators import windows as W
from sequor.params import SequenceSpec
from sequor.sources import tfrecord as TR
from sequor.sources.sinks import to_record_layout


def test_crc32c_published_vectors():
    got = TR.crc32c_many([b"123456789", bytes(32), b"\xff" * 32, bytes(range(32)), b""])
    assert [int(x) for x in got] == [0xE3069283, 0x8A9136AA, 0x62A8AB43, 0x46DD794E, 0x0]


def test_framing_roundtrip_and_corruption():
    recs = [b"a" * n for n in (0, 1, 5, 300)]
    blob = TR.frame_records(recs)
    assert TR.unframe_records(blob) == recs
    bad = bytearray(blob)
    bad[30] ^= 1
    with pytest.raises(ValueError):
        TR.unframe_records(bytes(bad))


def test_sequence_example_roundtrip():
    payload = TR.encode_sequence_example(
        {"symbol": TR._bytes_feature([b"ada"]), "rn": TR._int_feature([-5])},
        {"x": [TR._float_feature([1.5]), TR._float_feature([2.5])]},
    )
    ctx, lists = TR.decode_sequence_example(payload)
    assert ctx == {"symbol": [b"ada"], "rn": [-5]} and lists == {"x": [[1.5], [2.5]]}


def test_datasource_roundtrip(spark, tmp_dir):
    df = spark.range(0, 50).select(F.lit("ada").alias("symbol"), F.col("id").alias("i"),
                                   (F.col("id") * 0.5).alias("v"), (F.col("id") % 3).cast("double").alias("w"))
    spec = SequenceSpec(series=("symbol",), order=("i",), features=("v", "w"), label="v", past=5, future=2)
    rec = to_record_layout(W.sequence_windows(df, spec, plan="direct"), spec, keep=["symbol", "i"]).repartition(3)
    path = f"{tmp_dir}/tfr"
    TR.write_tfrecords(rec, path)
    back = TR.read_tfrecords(spark, path, rec.schema)
    assert back.count() == 50 - 5 - 2 + 1
    a = {r["i"]: r.asDict() for r in rec.collect()}
    b = {r["i"]: r.asDict() for r in back.collect()}
    assert a == b
    # overwrite replaces the previous files; the manifest lists only the committed ones
    TR.write_tfrecords(rec.coalesce(1), path)
    assert len(TR._manifest(path)) == 1 and TR.read_tfrecords(spark, path, rec.schema).count() == 44
