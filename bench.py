"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is fully materialised into Spark's ``noop`` sink (every row and
every array element is computed, nothing is collected) and timed ``RUNS``
times after one warm-up; the median is reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sequor.operators import dataset as DS  # noqa: E402
from sequor.operators import forecast as FC  # noqa: E402
from sequor.operators import windows as W  # noqa: E402
from sequor.operators.split import split_chronological  # noqa: E402
from sequor.params import DEFAULT_FEATURES, TrainingParams  # noqa: E402
from sequor.plans import blocked  # noqa: E402
from sequor.session import local_session  # noqa: E402
from sequor.sources.sinks import to_record_layout  # noqa: E402
from sequor.sources.tables import events_series, events_spec, lineitem_series, lineitem_spec  # noqa: E402
from sequor.summaries import micros  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def q_flagship(spark):
    """W4 auto plan, seven features, P=60 F=3, float32 nested record layout
    (built inside the window aggregate)."""
    spec = events_spec(60, 3, nested=True)
    win = W.sequence_windows(events_series(spark, SF_DIR), spec, plan="auto")
    return to_record_layout(win, spec, keep=["symbol", "s_ts"])


def q_windows_direct(spark):
    spec = events_spec(60, 3)
    return W.sequence_windows(events_series(spark, SF_DIR), spec, plan="direct")


def q_windows_baseline_shape(spark):
    spec = events_spec(60, 3).with_(features=("ohlc_close", "ohlc_pcr"))
    return W.sequence_windows(events_series(spark, SF_DIR), spec, plan="direct")


def q_windows_baseline_b(spark):
    spec = events_spec(60, 3).with_(features=("ohlc_close",))
    return W.sequence_windows(events_series(spark, SF_DIR), spec, plan="direct")


def q_blocked_baseline_a(spark):
    """
    series, blocks of 2 000 anchors."""
    spec = events_spec(60, 3).with_(series=("stream",), features=("ohlc_close", "ohlc_pcr"))
    src = events_series(spark, SF_DIR).withColumn("stream", F.lit("all"))
    return blocked.sequence_windows_blocked(src, spec, block_rows=2_000, bucket_rows=12_500)


def q_windows_p8(spark):
    spec = events_spec(8, 3)
    return W.sequence_windows(events_series(spark, SF_DIR), spec, plan="direct")


def q_windows_one_series_blocked(spark):
    """All events as one series, ranges of at most 12 500 rows in blocks of 2 000 anchors."""
    spec = events_spec(60, 3).with_(series=("stream",))
    src = events_series(spark, SF_DIR).withColumn("stream", F.lit("all"))
    return blocked.sequence_windows_blocked(src, spec, bucket_rows=12_500)


def q_windows_lineitem(spark):
    spec = lineitem_spec(60, 3)
    return W.sequence_windows(lineitem_series(spark, SF_DIR), spec, plan="auto")


def q_split_windows(spark):
    """T1 + W4 per (series, channel)."""
    ev = events_series(spark, SF_DIR)
    sp = split_chronological(ev, ["symbol"], ["s_ts", "event_id"], TrainingParams())
    spec = events_spec(60, 3).with_(series=("symbol", "channel"))
    return W.sequence_windows(sp, spec, plan="auto")


def q_batches(spark):
    """D1-D3 over P=8 windows, 10 epochs, batches of 64."""
    spec = events_spec(8, 3)
    win = W.sequence_windows(events_series(spark, SF_DIR), spec, plan="auto")
    rec = win.select("symbol", micros("s_ts").alias("ts_us"))
    return DS.batches(rec, ["symbol", "ts_us"], TrainingParams())


def q_fit_predict_metrics(spark):
    """M1 v1 fit + M4 scoring + A5 metrics per horizon on P=8 windows."""
    spec = events_spec(8, 3)
    win = W.sequence_windows(events_series(spark, SF_DIR), spec, plan="auto")
    model = FC.fit_linear(win, spec)
    preds = FC.predict_linear(win, model, spec)
    return FC.regression_metrics(preds, ["horizon"], rollup=True)


def _by_hand(spark, features, series, past=60, future=3):
    """The same windows written out with Spark's window functions, as a yardstick in the same session."""
    ev = events_series(spark, SF_DIR).withColumn("stream", F.lit("all"))
    w = Window.partitionBy(series).orderBy("s_ts", "event_id")
    back, ahead = w.rowsBetween(-(past - 1), 0), w.rowsBetween(1, future)
    out = ev.select(series, "s_ts", "event_id", F.row_number().over(w).alias("rn"), F.count("*").over(Window.partitionBy(series)).alias("n"),
                    F.collect_list("ohlc_close").over(ahead).alias("label"), *[F.collect_list(f).over(back).alias(f"x_{f}") for f in features])
    return out.filter((F.col("rn") >= past) & (F.col("rn") <= F.col("n") - future))


def c_users_2feat(spark):
    return _by_hand(spark, ["ohlc_close", "ohlc_pcr"], "symbol")


def c_users_1feat(spark):
    return _by_hand(spark, ["ohlc_close"], "symbol")


def c_global_2feat(spark):
    return _by_hand(spark, ["ohlc_close", "ohlc_pcr"], "stream")


def c_global_7feat(spark):
    return _by_hand(spark, list(DEFAULT_FEATURES), "stream")


#: Yardsticks, timed in the same rounds but not part of the total; the ratio of each query to its own is printed.
CONTROLS = {
    "control_users_2feat": c_users_2feat,
    "control_users_1feat": c_users_1feat,
    "control_global_2feat": c_global_2feat,
    "control_global_7feat": c_global_7feat,
}
YARDSTICK = {
    "sequence_windows_2feat_baseline_shape": "control_users_2feat",
    "sequence_windows_1feat_baseline_b_shape": "control_users_1feat",
    "blocked_2feat_baseline_a_shape": "control_global_2feat",
    "sequence_windows_blocked": "control_global_7feat",
}

QUERIES = {
    "sequence_windows": q_flagship,
    "sequence_windows_direct": q_windows_direct,
    "sequence_windows_2feat_baseline_shape": q_windows_baseline_shape,
    "sequence_windows_1feat_baseline_b_shape": q_windows_baseline_b,
    "blocked_2feat_baseline_a_shape": q_blocked_baseline_a,
    "sequence_windows_p8": q_windows_p8,
    "sequence_windows_blocked": q_windows_one_series_blocked,
    "sequence_windows_lineitem": q_windows_lineitem,
    "split_then_windows": q_split_windows,
    "ds_batch_10_epochs": q_batches,
    "fit_predict_metrics": q_fit_predict_metrics,
}


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    # Two shuffle partitions per core: the window stages expand every row into
    # past x features values, so CPU per shuffled byte is high and an uneven
    # hash split of series over exactly one partition per core leaves cores idle.
    cores = os.cpu_count() if CPUS == "*" else int(CPUS)
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cores)))
    spark = local_session(CPUS, shuffle_partitions=parts)
    only = [a for a in sys.argv[1:] if a in QUERIES]
    chosen = {k: v for k, v in QUERIES.items() if not only or k in only}
    names = list(chosen)
    chosen |= {c: CONTROLS[c] for k, c in YARDSTICK.items() if k in names}
    for fn in chosen.values():
        run(fn(spark))  # warm-up pass over every query: JIT, file listing, python workers
    samples: dict[str, list[float]] = {k: [] for k in chosen}
    for _ in range(RUNS):  # round-robin, so host noise spreads over all queries
        for name, fn in chosen.items():
            t0 = time.perf_counter()
            run(fn(spark))
            samples[name].append(time.perf_counter() - t0)
    every = {k: round(statistics.median(v), 4) for k, v in samples.items()}
    times = {k: every[k] for k in names}
    sf = os.path.basename(SF_DIR).replace("sf", "")
    print(json.dumps({
        "metric": "total_median_sec",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "controls": {k: v for k, v in every.items() if k not in times},
        "ratio_to_control": {k: round(times[k] / every[c], 2) for k, c in YARDSTICK.items() if k in times},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": CPUS,
        "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
