"""Folds, baselines, fitted models and metrics."""

from __future__ import annotations

from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwatt.operators import arima, baselines, folds, metrics, trees
from fleetwatt.operators.features import ml_dataset
from frames import START, ar1, hours, series

# Hourly demand of seven days, and the scores of the 24-hour lag on days 2 to 7.
DEMAND = [
    0.25, 0.26, 0.24, 0.25, 0.27, 0.24, 1.02, 1.98, 0.7, 0.45, 0.29, 0.31, 0.44, 0.38, 0.32, 0.35, 0.75, 0.67, 0.5, 0.55, 0.8, 0.58, 0.29, 0.28,
    0.25, 0.25, 0.28, 0.28, 0.29, 0.44, 0.28, 0.62, 0.28, 0.32, 0.29, 0.86, 0.7, 1.37, 1.36, 0.8, 0.46, 0.36, 0.45, 0.45, 0.43, 0.36, 0.32, 0.32,
    0.35, 0.36, 0.35, 0.32, 0.31, 0.33, 0.31, 0.32, 0.38, 0.4, 0.43, 0.36, 0.37, 0.35, 0.3, 0.32, 0.34, 0.31, 0.33, 0.37, 0.4, 0.34, 0.33, 0.3,
    0.37, 0.31, 0.31, 0.31, 0.3, 0.32, 0.3, 0.38, 0.4, 0.33, 0.37, 0.36, 0.35, 0.33, 0.34, 0.35, 0.32, 0.35, 0.35, 0.36, 0.33, 0.34, 0.3, 0.31,
    0.33, 0.29, 0.31, 0.32, 0.29, 0.38, 0.35, 0.31, 0.33, 0.3, 0.35, 0.33, 0.32, 0.35, 0.31, 0.31, 0.32, 0.31, 0.32, 0.34, 0.38, 0.34, 0.32, 0.31,
    0.32, 0.29, 0.3, 0.32, 0.29, 0.31, 0.31, 0.3, 0.34, 0.28, 0.42, 0.38, 0.38, 0.39, 0.34, 0.35, 0.34, 0.36, 0.34, 0.29, 0.33, 0.34, 0.3, 0.38,
    0.31, 0.37, 0.34, 0.28, 0.32, 0.28, 0.32, 0.44, 2.09, 1.56, 1.02, 1.04, 1.51, 0.74, 0.64, 0.66, 0.71, 0.84, 0.37, 0.82, 0.66, 0.4, 0.28, 0.28,
]
NAIVE = {
    2: (0.31875, 0.48512455445311503),
    3: (0.2058333333333333, 0.3512359131220307),
    4: (0.02791666666666667, 0.0348209706929603),
    5: (0.028749999999999998, 0.035296364307578945),
    6: (0.030833333333333338, 0.03872983346207417),
    7: (0.36166666666666664, 0.5731928122368597),
}
# MAE, RMSE, nRMSE of one model by day, with their mean, std and median
# (the first set with ddof 1, the second with ddof 0).
PER_DAY = [
    (0.24816844376280858, 0.36667182040038077, 0.0864792029246181),
    (0.2356129486023998, 0.3065346884095653, 0.07229591707772767),
    (0.165040405758739, 0.1696013221755882, 0.04000031183386514),
    (0.1276093163550143, 0.13185084794218038, 0.031096898099570842),
    (0.08590964412910107, 0.08920508198374877, 0.021038934430129424),
    (0.04523399748364928, 0.05242677465909716, 0.012364805344126688),
    (0.35687908791507733, 0.5631934932552055, 0.13282865406962394),
]
SUMMARY = [
    0.18063626342954134, 0.10724314927281307, 0.165040405758739, 0.2399262898322523, 0.18234657751566238, 0.1696013221755882,
    0.05658638911138027, 0.04300626828199584, 0.04000031183386514,
]
PER_DAY_POP = [
    (0.40375000322858495, 0.5289231829816573, 0.4722528419479083),
    (0.21161839182178177, 0.362681575451094, 2.7898582727007226),
    (0.1021409208451708, 0.12807716563361696, 1.280771656336169),
    (0.053943468034267424, 0.06251513696428819, 0.6946126329365353),
    (0.10533705232044062, 0.11635242308722106, 0.8310887363372935),
    (0.3601293171942234, 0.5718764600895491, 0.31595384535334203),
]
SUMMARY_POP = [
    0.20615319224074483, 0.1334998514275221, 0.1584777220711112, 0.2950709907012378, 0.2040379033480061, 0.24537937054235548,
    1.064089664268662, 0.8292576110025136, 0.7628506846369144,
]


def test_naive_24h_scores(spark):
    df = series(spark, DEMAND)
    days = folds.daily_folds(df)
    pred = baselines.naive_24h(df, days.where("fold >= 2"))
    got = {r["fold"]: (r["MAE"], r["RMSE"]) for r in metrics.forecast_metrics(pred, ["fold"]).collect()}
    assert got.keys() == NAIVE.keys()
    for fold, want in NAIVE.items():
        assert got[fold] == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("table,want,ddof", [(PER_DAY, SUMMARY, 1), (PER_DAY_POP, SUMMARY_POP, 0)])
@pytest.mark.parametrize("by", [["series_id", "model_name"], ["model_name"]])
def test_metric_summary(spark, table, want, ddof, by):
    rows = [("a", "m", i, *r) for i, r in enumerate(table)]
    df = spark.createDataFrame(rows, "series_id string, model_name string, fold int, MAE double, RMSE double, nRMSE double")
    got = metrics.metrics_summary(df, by, ddof=ddof).first()
    names = [f"{m}_{s}" for m in metrics.METRICS for s in ("mean", "std", "median")]
    assert [got[n] for n in names] == pytest.approx(want, rel=1e-9)


def test_folds_are_the_last_days_and_do_not_leak(spark):
    df = series(spark, range(24 * 9 + 5))
    days = folds.daily_folds(df).orderBy("fold").collect()
    assert [d["fold"] for d in days] == list(range(1, 8))
    assert days[-1]["start"] == START + timedelta(days=9)
    test = folds.fold_rows(df, folds.daily_folds(df))
    assert test.count() == 24 * 6 + 5
    first = test.groupBy("fold").agg(F.min("timestamp").alias("t")).collect()
    assert all(r["t"] == START + timedelta(days=2 + r["fold"]) for r in first)


def test_short_history_tiles_what_there_is(spark):
    df = series(spark, [1.0, 2.0, 3.0] + [0.0] * 24, start=START - timedelta(hours=3))
    days = folds.daily_folds(df).where(F.col("start") == F.lit(START))
    got = [r["y_pred"] for r in baselines.naive_tile(df, days).orderBy("timestamp").collect()]
    assert got == [1.0, 2.0, 3.0] * 8
    flat = {r["y_pred"] for r in baselines.naive_flat(df, days).collect()}
    assert flat == {3.0}


def test_no_history_gives_no_flat_rows(spark):
    df = series(spark, [None] * 24 + [1.0] * 24)
    days = folds.daily_folds(df)
    assert {r["fold"] for r in baselines.naive_flat(df, days).collect()} == set()


def test_flat_truth_has_no_nrmse(spark):
    df = spark.createDataFrame([("a", "m", 1.0, 2.0), ("a", "m", 1.0, 3.0)], "series_id string, model_name string, y_true double, y_pred double")
    got = metrics.forecast_metrics(df).first()
    assert got["MAE"] == 1.5 and got["nRMSE"] is None


def _direct(y, p, q, horizon):
    """Hannan-Rissanen on first differences with plain numpy."""
    w = np.diff(y)
    m = max(p, q) + 4
    t = np.arange(m + q, len(w))

    def past(rows, series_, lags):
        return np.column_stack([series_[rows - k] for k in range(1, lags + 1)])

    phi = np.linalg.lstsq(past(t, w, m), w[t], rcond=None)[0]
    e = np.full(len(w), np.nan)
    known = np.arange(m, len(w))
    e[known] = w[known] - past(known, w, m) @ phi
    theta = np.linalg.lstsq(np.column_stack([past(t, w, p), past(t, e, q)]), w[t], rcond=None)[0]
    w, e, last, out = list(w), list(e), y[-1], []
    for _ in range(horizon):
        step = sum(theta[k - 1] * w[-k] for k in range(1, p + 1)) + sum(theta[p + k - 1] * e[-k] for k in range(1, q + 1))
        w.append(step)
        e.append(0.0)
        last += step
        out.append(last)
    return np.array(out)


def test_arima_equals_a_direct_fit(spark):
    y = np.cumsum(ar1(24 * 40, 0.5, mean=0.0))
    df = series(spark, y)
    days = folds.daily_folds(df, 3)
    pred = arima.fit_and_forecast(df.repartition(7), days, arima.Spec((2, 1, 2))).toPandas()
    assert set(pred["fold"]) == {1, 2, 3} and (pred["status"] == "ok").all()
    for fold, part in pred.groupby("fold"):
        got = part.sort_values("timestamp")["y_pred"].to_numpy()
        np.testing.assert_allclose(got, _direct(y[: 24 * (36 + fold)], 2, 2, 24), rtol=1e-6)


def test_ar1_walk_forward_finds_phi(spark):
    y = ar1(24 * 60, 0.8)
    got = arima.ar1(series(spark, y)).first()
    assert got["phi"] == pytest.approx(0.8, abs=0.06)


def test_seasonal_model_beats_persistence(spark):
    t = np.arange(24 * 40)
    y = 5 + 2 * np.sin(2 * np.pi * t / 24) + np.random.default_rng(0).normal(0, 0.2, len(t))
    df = series(spark, y)
    days = folds.daily_folds(df, 3)
    fitted = arima.walk_forward(df, days, [arima.Spec((2, 1, 1), (0, 1, 1, 24))]).drop("status")
    both = fitted.unionByName(baselines.naive_flat(df, days))
    got = {r["model_name"]: r["RMSE"] for r in metrics.forecast_metrics(both, ["model_name"]).collect()}
    assert got["SARIMA(2,1,1)(0,1,1,24)"] < 0.4 * got["naive_flat"]


def test_arimax_uses_the_signal(spark):
    rng = np.random.default_rng(0)
    x = np.cumsum(rng.normal(size=24 * 30))
    y = 3 * x + rng.normal(0, 0.1, len(x))
    rows = [("a", h, float(a), float(b)) for h, a, b in zip(hours(len(x)), y, x)]
    df = spark.createDataFrame(rows, "series_id string, timestamp timestamp_ntz, value double, x double")
    days = folds.daily_folds(df, 2)
    specs = [arima.Spec((2, 1, 2)), arima.Spec((2, 1, 2), exog=("x",))]
    got = {r["model_name"]: r["RMSE"] for r in metrics.forecast_metrics(arima.walk_forward(df, days, specs), ["model_name"]).collect()}
    assert got["ARIMAX(2,1,2)"] < 0.3 * got["ARIMA(2,1,2)"]


def test_training_window_and_short_series(spark):
    y = ar1(24 * 40, 0.5)
    y[: 24 * 20] += 500.0
    df = series(spark, y)
    days = folds.daily_folds(df, 1)
    near = arima.fit_and_forecast(df, days, arima.Spec((1, 0, 0)), window=300).toPandas()["y_pred"]
    only = arima.fit_and_forecast(series(spark, y[24 * 39 - 300 : 24 * 40], start=START + timedelta(hours=24 * 39 - 300)), days, arima.Spec((1, 0, 0))).toPandas()["y_pred"]
    assert np.allclose(sorted(near), sorted(only))
    short = series(spark, range(30), start=START + timedelta(hours=14))
    got = arima.fit_and_forecast(short, folds.daily_folds(short, 1), arima.Spec((2, 1, 2))).select("status", "y_pred").distinct().collect()
    assert [tuple(r) for r in got] == [("too_short", None)]


def test_trees(spark):
    t = np.arange(24 * 30)
    y = 2 + np.sin(2 * np.pi * t / 24)
    rows = [("a", h, float(v), float(v * 2)) for h, v in zip(hours(len(t)), y)]
    df = spark.createDataFrame(rows, "series_id string, timestamp timestamp_ntz, Demand double, x double")
    frame = trees.ar_frame(df)
    names = trees.AR_FEATURES + trees.TIME_FEATURES
    train, test = trees.split_by_end(ml_dataset(frame.na.drop(), "Demand", names))
    assert test.count() == 24 * 7 + 1
    model = trees.fit_gbt(train, 8, rate=0.5, depth=3)
    curve = trees.learning_curve(model, train, test).orderBy("iteration").collect()
    assert len(curve) == 8 and curve[-1]["training_rmse"] < curve[0]["training_rmse"]
    score = metrics.forecast_metrics(trees.predict(model, test, "GBT")).first()
    assert score["RMSE"] < 0.2
    ahead = trees.recursive_forecast(model, df).orderBy("timestamp").collect()
    assert [r["timestamp"] for r in ahead] == [START + timedelta(hours=len(t) + i) for i in range(24)]
    assert np.abs(np.array([r["y_pred"] for r in ahead]) - (2 + np.sin(2 * np.pi * np.arange(24) / 24))).max() < 0.6
    table = metrics.top_features(trees.feature_importance(model, names, train), 3).collect()
    assert len(table) == 3 and table[0]["importance"] >= table[1]["importance"]
