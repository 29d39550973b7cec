"""Sources and sinks: plain and hive series trees, CSV quarantine, Parquet records, errors."""


import pytest
from pyspark.sql import functions as F

from sequor.operators import projections as PJ
from sequor.params import SequenceSpec
from sequor.sources.csv_series import read_series_csv, series_schema
from sequor.sources.layout import read_layout
from sequor.sources.sinks import to_record_layout, write_plain_tree, write_sequences, write_series_csv
from sequor.operators import windows as W

from .conftest import write_micro_csv


def _plain_tree(root):
    for ch in ("train", "evaluation"):
        for date in ("05-13-20", "05-14-20"):
            for sym in ("ada", "adx"):
                write_micro_csv(f"{root}/{ch}/price/bn/{date}/{sym}.csv", blank_a=False, bad_b=(sym == "adx"))
    write_micro_csv(f"{root}/train/volume/bn/05-13-20/ada.csv", blank_a=False, bad_b=False)


def test_plain_tree_discovery(spark, tmp_dir):
    _plain_tree(tmp_dir)
    schema = series_schema(("a", "b"), quarantine=True)
    df = read_layout(spark, tmp_dir, layout="plain", schema=schema, quarantine=True)
    got = {(r["channel"], r["data_type"], r["exchange"], r["date"], r["symbol"]): r["n"]
           for r in df.groupBy("channel", "data_type", "exchange", "date", "symbol").agg(F.count("*").alias("n")).collect()}
    assert len(got) == 9 and set(got.values()) == {10}
    bad = df.select("b", "_corrupt_record").filter(F.col("_corrupt_record").isNotNull()).collect()
    assert len(bad) == 4 and all(r["b"] is None for r in bad)  # one bad row per adx file


def test_plain_tree_selection_is_a_glob(spark, tmp_dir):
    _plain_tree(tmp_dir)
    schema = series_schema(("a", "b"))
    df = read_layout(spark, tmp_dir, layout="plain", schema=schema, channel="eval",
                     data_type="price", exchange="bn", dates=["05-14-20"])
    rows = df.select("channel", "date", "symbol").distinct().collect()
    assert {(r["channel"], r["date"], r["symbol"]) for r in rows} == {
        ("evaluation", "05-14-20", "ada"), ("evaluation", "05-14-20", "adx")}
    files = set(df.inputFiles())
    assert len(files) == 2


PLAIN = "s_ts string, a double, b double, symbol string, channel string, data_type string, exchange string, date string"


def _plain_rows(spark, symbols, n=4):
    rows = [(f"2020-05-13 00:00:0{i}", float(i) if i != 2 else None, 10.0 * i, s, ch, "price", "bn", "05-13-20")
            for i in reversed(range(n)) for s in symbols for ch in ("train", "validation")]
    return spark.createDataFrame(rows, PLAIN).withColumn("s_ts", F.col("s_ts").cast("timestamp_ntz"))


def test_written_plain_tree_is_read_back(spark, tmp_dir):
    root, names = f"{tmp_dir}/tree", ["ada", "a b", "x#1", "50%", "p+q", "k=v", "été"]
    assert write_plain_tree(_plain_rows(spark, names), root, features=("a", "b")) == 2 * len(names)
    with open(f"{root}/train/price/bn/05-13-20/ada.csv") as fh:  # header, time order, blank for NULL
        assert fh.read().split("\n")[:4] == ["s_ts,a,b", "2020-05-13 00:00:00,0.0,0.0", "2020-05-13 00:00:01,1.0,10.0", "2020-05-13 00:00:02,,20.0"]
    back = read_layout(spark, root, schema=series_schema(("a", "b")))
    got = {(r["channel"], r["symbol"]): (r["n"], r["na"]) for r in
           back.groupBy("channel", "symbol").agg(F.count("*").alias("n"), F.count("a").alias("na")).collect()}
    assert got == {(ch, s): (4, 3) for ch in ("train", "validation") for s in names}
    # again with fewer rows: files of the same name are replaced, others stay
    write_plain_tree(_plain_rows(spark, ["ada"], n=2), root, features=("a", "b"))
    back = read_layout(spark, root, schema=series_schema(("a", "b")), channel="train")
    assert {r["symbol"]: r["count"] for r in back.groupBy("symbol").count().collect()} == {s: 2 if s == "ada" else 4 for s in names}


@pytest.mark.parametrize("bad", [None, "", "a/b", "c:d", ".."])
def test_plain_tree_refuses_names_that_are_no_file_names(spark, tmp_dir, bad):
    with pytest.raises(ValueError):
        write_plain_tree(_plain_rows(spark, ["ada", bad]), f"{tmp_dir}/tree", features=("a", "b"))
    with pytest.raises(FileNotFoundError):
        read_layout(spark, f"{tmp_dir}/tree", schema=series_schema(("a", "b")))


def test_missing_path_raises(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_series_csv(spark, f"{tmp_dir}/nothing/*.csv")
    with pytest.raises(FileNotFoundError):
        read_layout(spark, f"{tmp_dir}/none", layout="plain")


def _read_files(df):
    """The files that the rows came from."""
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_hive_tree_roundtrip_and_partition_pruning(spark, tmp_dir):
    rows = [(f"2020-05-1{d} 00:00:0{i}", float(i), float(10 * i), "ada", ch, "price", "bn", f"05-1{d}-20")
            for d in (3, 4) for i in range(5) for ch in ("train", "validation")]
    df = spark.createDataFrame(rows, "s_ts string, a double, b double, symbol string, channel string, "
                                     "data_type string, exchange string, date string")
    df = df.withColumn("s_ts", F.col("s_ts").cast("timestamp_ntz"))
    write_series_csv(df, tmp_dir, features=("a", "b"))
    back = read_layout(spark, tmp_dir, layout="hive", schema=series_schema(("a", "b")), channel="test")
    back = PJ.training_dates(back, how="05-14-20")
    assert back.count() == 5
    assert "PartitionFilters: [isnotnull(channel" in back._jdf.queryExecution().executedPlan().toString()
    assert back.inputFiles() and all("date=05-14-20" in f and "channel=validation" in f for f in _read_files(back))
    assert back.schema["a"].dataType.simpleString() == "float"


def test_training_dates_modes(spark):
    import datetime as dt

    df = spark.createDataFrame([("05-13-20",), ("05-14-20",)], "date string")
    assert PJ.training_dates(df, "all").count() == 2
    assert PJ.training_dates(df, "05-14-20").count() == 1
    assert PJ.training_dates(df, "today", today=dt.date(2020, 5, 13)).count() == 1
    with pytest.raises(ValueError):
        PJ.training_dates(df, "13-05-20")


def test_record_layout_parquet_roundtrip(spark, tmp_dir):
    df = spark.range(0, 20).select(F.lit("s").alias("symbol"), F.col("id").alias("i"),
                                   (F.col("id") * 1.5).alias("v"))
    spec = SequenceSpec(series=("symbol",), order=("i",), features=("v",), label="v", past=4, future=2)
    win = W.sequence_windows(df, spec, plan="direct")
    rec = to_record_layout(win, spec, keep=["symbol", "i"])
    assert rec.schema["v"].dataType.simpleString() == "array<array<float>>"
    path = f"{tmp_dir}/seq"
    write_sequences(rec.withColumn("part", F.col("i") % 2), path, partition_cols=["part"])
    back = spark.read.parquet(path)
    assert back.count() == 20 - 4 - 2 + 1
    r = back.filter("i = 3").first()
    assert r["v"] == [[0.0], [1.5], [3.0], [4.5]] and r["v_label"] == [[6.0], [7.5]]
    # dynamic partition overwrite replaces only the partitions written
    write_sequences(rec.filter("i % 2 = 0").withColumn("part", F.col("i") % 2), path, partition_cols=["part"])
    assert spark.read.parquet(path).count() == 15


def test_plain_tree_symbols_with_blanks_percent_and_plus(spark, tmp_dir):
    for sym in ("A B", "X%41", "C+D"):
        write_micro_csv(f"{tmp_dir}/train/price/bn/05-13-20/{sym}.csv", blank_a=False, bad_b=False)
    df = read_layout(spark, tmp_dir, layout="plain", schema=series_schema(("a", "b")))
    assert {r["symbol"] for r in df.select("symbol").distinct().collect()} == {"A B", "X%41", "C+D"}
