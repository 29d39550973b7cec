"""Forecasters, metrics and the registry."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sequor.operators import forecast as FC
from sequor.operators import registry as RG
from sequor.operators import windows as W
from sequor.sources.tables import events_series, events_spec

from .conftest import SF001


@pytest.fixture(scope="module")
def win8(spark):
    spec = events_spec(8, 3)
    return spec, W.sequence_windows(events_series(spark, SF001), spec, plan="direct").cache()


def test_linear_fit_matches_numpy(win8):
    spec, win = win8
    model = {(r["symbol"], r["horizon"]): r for r in FC.fit_linear(win, spec).collect()}
    rows = win.select("symbol", "ohlc_close", "ohlc_close_label").collect()
    sym = rows[0]["symbol"]
    x = np.array([r["ohlc_close"][-1] for r in rows if r["symbol"] == sym])
    for h in (1, 2, 3):
        y = np.array([r["ohlc_close_label"][h - 1] for r in rows if r["symbol"] == sym])
        slope, intercept = np.polyfit(x, y, 1)
        assert model[(sym, h)]["slope"] == pytest.approx(slope, rel=1e-9, abs=1e-12)
        assert model[(sym, h)]["intercept"] == pytest.approx(intercept, rel=1e-9, abs=1e-9)


def test_lagged_ridge_matches_numpy(win8):
    spec, win = win8
    lags, ridge = 4, 1e-3
    model = {(r["symbol"], r["horizon"]): r["coef"] for r in FC.fit_lagged_ridge(win, spec, lags, ridge).collect()}
    rows = win.select("symbol", "ohlc_close", "ohlc_close_label").collect()
    for sym in sorted({r["symbol"] for r in rows})[:3]:
        mine = [r for r in rows if r["symbol"] == sym]
        X = np.array([[1.0] + list(r["ohlc_close"][-lags:]) for r in mine])
        for h in (1, 2, 3):
            y = np.array([r["ohlc_close_label"][h - 1] for r in mine])
            reg = np.eye(lags + 1)
            reg[0, 0] = 0
            coef = np.linalg.solve(X.T @ X + ridge * len(y) * reg, X.T @ y)
            assert np.allclose(model[(sym, h)], coef, rtol=1e-6, atol=1e-8)
    preds = FC.predict_lagged_ridge(win, FC.fit_lagged_ridge(win, spec, lags, ridge), spec, lags)
    persist = FC.predict_persistence(win, spec)
    mse = lambda p: FC.regression_metrics(p).first()["mse"]
    assert mse(preds) < mse(persist)  # in-sample fit beats persistence


def test_window_ridge_fits_all_values_of_the_window(spark, win8):
    from sequor.queries import q_fit_window_ridge

    spec, win = win8
    ridge, size = 1e-3, spec.past * len(spec.features)
    fitted = FC.fit_window_ridge(win, spec, ridge).collect()
    model = {(r["symbol"], r["horizon"]): r for r in fitted}
    rows = win.select("symbol", *spec.features, spec.label_col).collect()
    for sym in sorted({r["symbol"] for r in rows})[:3]:
        mine = [r for r in rows if r["symbol"] == sym]
        X = np.array([np.concatenate([r[c] for c in spec.features]) for r in mine], dtype=float)
        assert X.shape[1] == size
        mean, sd = X.mean(axis=0), X.std(axis=0)
        varies = sd > 1e-6 * np.sqrt((X * X).mean(axis=0))
        Z = (X[:, varies] - mean[varies]) / sd[varies]
        for h in (1, 2, 3):
            y = np.array([r[spec.label_col][h - 1] for r in mine])
            slopes = np.zeros(size)
            slopes[varies] = np.linalg.solve(Z.T @ Z / len(y) + ridge * np.eye(Z.shape[1]), Z.T @ (y - y.mean()) / len(y)) / sd[varies]
            got = model[(sym, h)]
            assert got["n_obs"] == len(y) and len(got["coef"]) == size + 1
            assert np.allclose(got["coef"][0] + X @ got["coef"][1:], y.mean() + (X - mean) @ slopes, rtol=1e-7, atol=1e-7)
            assert np.allclose(np.array(got["coef"][1:])[varies] * sd[varies], slopes[varies] * sd[varies], rtol=1e-5, atol=1e-6)
    mse = lambda p: FC.regression_metrics(p).first()["mse"]
    preds = FC.predict_window_ridge(win, spark.createDataFrame(fitted, FC.fit_window_ridge(win, spec).schema), spec)
    assert preds.count() == FC.predict_persistence(win, spec).count()
    assert mse(preds) < mse(FC.predict_lagged_ridge(win, FC.fit_lagged_ridge(win, spec), spec))
    assert all(r["gradient"] == 0.0 == r["bias"] for r in q_fit_window_ridge(spark, SF001).collect())


def test_window_ridge_leaves_out_windows_with_missing_values(spark):
    from sequor.params import SequenceSpec

    spec = SequenceSpec(series=("s",), order=("t",), features=("a", "b"), label="a", past=2, future=1)
    whole = [("x", [float(i), float(i % 3)], [float(i * i % 7), 5.0], [float(2 * i)]) for i in range(20)]
    odd = [("x", [1.0, None], [1.0, 5.0], [9.0]), ("x", [1.0], [1.0, 5.0], [9.0]), ("x", [1.0, float("nan")], [1.0, 5.0], [9.0]),
           ("x", [1.0, 2.0], [1.0, 5.0], [None]), ("x", [1.0, 2.0], [float("inf"), 5.0], [9.0])]
    schema = "s string, a array<double>, b array<double>, a_label array<double>"
    got, same = ([(r["n_obs"], r["coef"]) for r in FC.fit_window_ridge(spark.createDataFrame(x, schema), spec).collect()]
                 for x in (whole, whole + odd))
    assert len(got) == 1 and got[0][0] == same[0][0] == 20 and np.allclose(got[0][1], same[0][1])
    assert got[0][1][4] == 0.0  # a constant value
    preds = FC.predict_window_ridge(spark.createDataFrame(odd[:1], schema), FC.fit_window_ridge(spark.createDataFrame(whole, schema), spec), spec)
    assert preds.first()["pred"] == preds.first()["last"]


def _window_matrix(rows, spec):
    """Design matrix and labels of one series' rows [K values each], by plain loops; the label is the first value."""
    x, y = [], []
    for a in range(spec.past - 1, len(rows) - spec.shift - spec.future + 1, spec.step):
        x.append([rows[a - spec.past + 1 + p][f] for f in range(len(spec.features)) for p in range(spec.past)])
        y.append([rows[a + spec.shift + h][0] for h in range(spec.future)])
    return np.array(x, float), np.array(y, float)


@pytest.mark.parametrize("past,future,shift,n", [(1, 1, 1, 40), (4, 2, 1, 60), (7, 3, 2, 300)])
def test_run_moments_equal_direct_ones(past, future, shift, n):
    from sequor.operators import moments as M
    from sequor.params import SequenceSpec

    rng = np.random.default_rng(past)
    spec = SequenceSpec(series=("s",), order=("t",), features=("a", "b"), label="a", past=past, future=future, shift=shift)
    rows = rng.normal(size=(n, 2)).cumsum(0) + [1e8, 5]
    x, y = _window_matrix(rows, spec)
    count, mean, m2 = M.of_block(rows, rows[:, 0], np.arange(past - 1, n - shift - future + 1), spec)[0]
    z = np.c_[x, y]
    assert count == len(z) and np.allclose(mean, z.mean(0), rtol=1e-12)
    c = z - z.mean(0)
    assert np.allclose(m2, c.T @ c, rtol=1e-6, atol=1e-5 * len(z))
    a, b = M.direct(z[:11]), M.direct(z[11:])
    both = M.merged(M.merged(None, a), b)
    assert both[0] == count and np.allclose(both[2], m2, rtol=1e-6, atol=1e-5 * len(z))


def test_window_ridge_from_rows(spark, monkeypatch):
    """Rows give the coefficients that windows give, for any ranges and blocks, with gaps and with means of 1e8."""
    from sequor.operators import moments as M
    from sequor.params import SequenceSpec

    rng = np.random.default_rng(4)
    spec = SequenceSpec(series=("s",), order=("t",), features=("a", "b"), label="a", past=4, future=2)
    rows, plain = [], {}
    for s, n in (("x", 400), ("y", 30), (None, 90), ("short", 5)):
        v = np.c_[1e8 + rng.normal(size=n).cumsum(), rng.normal(size=n)]
        plain[s] = v
        rows += [(s, i, float(v[i, 0]), float(v[i, 1])) for i in range(n)]
    df = spark.createDataFrame(rows, "s string, t long, a double, b double").repartition(3)
    model = {(r["s"], r["horizon"]): r for r in FC.fit_window_ridge_rows(df, spec, block_rows=40, rows_per_range=90).collect()}
    assert set(model) == {(s, h) for s in ("x", "y", None) for h in (1, 2)}
    for s in ("x", "y", None):
        x, y = _window_matrix(plain[s].tolist(), spec)
        mean, sd = x.mean(0), x.std(0)
        z = (x - mean) / sd
        for h in (1, 2):
            own = y[:, h - 1]
            slopes = np.linalg.solve(z.T @ z / len(z) + 1e-3 * np.eye(8), z.T @ (own - own.mean()) / len(z)) / sd
            got = model[s, h]
            assert got["n_obs"] == len(z) and np.allclose(got["coef"][1:], slopes, rtol=1e-4, atol=1e-6)
    monkeypatch.setattr(M, "SALTS", 1)  # parts are merged in two steps
    monkeypatch.setattr(M, "MOST_BYTES", 1)
    again = {(r["s"], r["horizon"]): r for r in FC.fit_window_ridge_rows(df, spec, block_rows=40, rows_per_range=90).collect()}
    assert all(np.allclose(again[k]["coef"], r["coef"], rtol=1e-6) and again[k]["n_obs"] == r["n_obs"] for k, r in model.items())
    gaps = df.withColumn("a", F.when(F.col("t") % 37 == 5, F.lit(None)).when(F.col("t") % 41 == 3, F.lit(float("nan"))).otherwise(F.col("a")))
    by_rows = {(r["s"], r["horizon"]): r for r in FC.fit_window_ridge_rows(gaps, spec, block_rows=30, rows_per_range=100).collect()}
    by_windows = {(r["s"], r["horizon"]): r for r in FC.fit_window_ridge(W.sequence_windows(gaps, spec, plan="direct"), spec).collect()}
    assert set(by_rows) == set(by_windows)
    for k, r in by_rows.items():
        assert r["n_obs"] == by_windows[k]["n_obs"] and np.allclose(r["coef"][1:], by_windows[k]["coef"][1:], rtol=1e-4, atol=1e-6), k


def test_metrics_and_batch_loss(spark):
    df = spark.createDataFrame([(1, 0, 1.0, 2.0), (1, 0, 3.0, 3.0), (1, 1, 0.0, 2.0), (1, 1, 4.0, 2.0)],
                               "epoch int, batch_id int, y double, pred double")
    m = FC.regression_metrics(df).first()
    assert m["mse"] == pytest.approx((1 + 0 + 4 + 4) / 4) and m["mae"] == pytest.approx(1.25)
    assert m["label_mean"] == 2.0 and m["pred_mean"] == 2.25
    b = FC.batch_losses(df).first()
    assert b["loss"] == pytest.approx((0.5 + 4.0) / 2) and b["batches"] == 2


def test_registry_fixture(spark):
    listing = spark.createDataFrame(
        [("s1", "1590", "saved_model.pb"), ("s1", "1600", None), ("s2", "1580", "saved_model.pb"),
         ("s3", "1570", None), ("s4", "999", "saved_model.pb"), ("s4", "1000", "saved_model.pb")],
        "symbol string, version string, file_name string")
    assert {r[0] for r in RG.complete_symbols(listing).collect()} == {"s1", "s2", "s4"}
    got = {r["symbol"]: r["version"] for r in RG.latest_complete_versions(listing).collect()}
    assert got == {"s1": 1590, "s2": 1580, "s4": 1000}  # numeric, not text, comparison


def test_artifact_listing_from_tree(spark, tmp_dir):
    import os

    for sym, ver, name in (("s1", "1590", "saved_model.pb"), ("s1", "1600", "variables.index"),
                           ("s2", "1580", "saved_model.pb")):
        os.makedirs(f"{tmp_dir}/{sym}/{ver}", exist_ok=True)
        open(f"{tmp_dir}/{sym}/{ver}/{name}", "wb").write(b"x")
    listing = RG.list_artifacts(spark, tmp_dir)
    assert {tuple(r) for r in listing.collect()} == {
        ("s1", "1590", "saved_model.pb"), ("s1", "1600", "variables.index"), ("s2", "1580", "saved_model.pb")}
    got = {r["symbol"]: r["version"] for r in RG.latest_complete_versions(listing).collect()}
    assert got == {"s1": 1590, "s2": 1580}


def test_export_appends_versions(spark, win8, tmp_dir):
    spec, win = win8
    model = FC.fit_linear(win, spec)
    RG.export_models(model, f"{tmp_dir}/models", 1)
    back = RG.export_models(model, f"{tmp_dir}/models", 2)
    assert sorted(r[0] for r in back.select("version").distinct().collect()) == [1, 2]


def test_export_twice_and_stray_folders(spark, tmp_dir):
    model = spark.createDataFrame([("a", 1.0)], "symbol string, w double")
    RG.export_models(model, f"{tmp_dir}/again", 1)
    assert RG.export_models(model, f"{tmp_dir}/again", 1).count() == 1
    listing = spark.createDataFrame([("a", "3", "saved_model.pb"), ("a", "temp-200", "saved_model.pb")], "symbol string, version string, file_name string")
    got = RG.latest_complete_versions(listing, "saved_model.pb").collect()
    assert [(r["symbol"], r["version"]) for r in got] == [("a", 3)]



def test_an_export_that_broke_off_is_never_served(spark, tmp_dir):
    from sequor.params import SequenceSpec

    root = tmp_dir + "/models"
    spec = SequenceSpec(series=("date", "symbol"), order=("t",), features=("v",), label="v", past=1, future=1)
    model = lambda slope, symbols: spark.createDataFrame(
        [("d1", s, 1, slope, 0.0) for s in symbols], "date string, symbol string, horizon int, slope double, intercept double")
    RG.export_models(model(2.0, ["a", "b"]), root, 1)
    RG.export_models(model(3.0, ["a"]), root, 2)
    RG.write_attempt(model(99.0, ["a", "b"]), root, 3)  # broke off before its commit
    RG.write_attempt(model(98.0, ["a"]), root, 2)
    RG.export_models(model(4.0, ["a"]), root, 2)  # again: replaces
    win = spark.createDataFrame([("d1", s, [10.0], [0.0]) for s in ("a", "b", "c")], "date string, symbol string, v array<double>, v_label array<double>")
    got = {r["symbol"]: (r["version"], r["pred"]) for r in RG.score_latest(win, root, spec).collect()}
    assert got == {"a": (2, 40.0), "b": (1, 20.0), "c": (None, 10.0)}
    assert sorted((r["version"], r["symbol"], r["slope"]) for r in RG.read_models(spark, root).collect()) == [(1, "a", 2.0), (1, "b", 2.0), (2, "a", 4.0)]


def test_scoring_runs_no_job_while_the_plan_is_built(spark, win8):
    spec, win = win8
    model = FC.fit_linear(win, spec)
    spark.sparkContext.setJobGroup("building", "building")
    try:
        preds = FC.predict_linear(win, model, spec)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
        assert preds.count() == 3 * win.count()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
