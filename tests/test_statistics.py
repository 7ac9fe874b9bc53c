"""Tests, decomposition and ranking against direct computation."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwatt.operators import decompose, features, impute, profile, stats
from frames import ar1, hours, series, values


def test_adf_equals_direct_regression(spark):
    y = ar1(900, 0.7)
    got = stats.adf(series(spark, y)).first()
    n = len(y)
    most = math.ceil(12 * (n / 100) ** 0.25)
    dy = np.diff(y)

    def fit(lags, start):
        t = np.arange(start, len(dy))
        x = np.column_stack([np.ones(len(t)), y[t], *[dy[t - k] for k in range(1, lags + 1)]])
        beta, *_ = np.linalg.lstsq(x, dy[t], rcond=None)
        r = dy[t] - x @ beta
        return beta, float(r @ r), x

    scores = []
    for lag in range(most + 1):
        _, ssr, x = fit(lag, most)
        m = len(x)
        scores.append((m * (math.log(2 * math.pi * ssr / m) + 1) + 2 * x.shape[1], lag))
    best = min(scores)[1]
    beta, ssr, x = fit(best, best)
    se = math.sqrt(ssr / (len(x) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
    assert got["used_lag"] == best
    assert got["nobs"] == len(x)
    assert got["statistic"] == pytest.approx(beta[1] / se, rel=1e-7)
    assert got["p_value"] < 0.01
    assert got["critical_5"] == pytest.approx(-2.8648, abs=1e-3)


def test_adf_p_value_at_the_critical_value():
    assert stats._adf_p(-2.86154) == pytest.approx(0.05, abs=5e-4)
    assert stats._adf_p(-3.43035) == pytest.approx(0.01, abs=5e-4)


def test_verdicts(spark):
    walk = np.cumsum(np.random.default_rng(3).normal(size=900))
    got = {(r["series"], r["test"]): r["conclusion"] for r in stats.stationarity(series(spark, walk)).collect()}
    assert got["Original", "ADF"] == "Non-Stationary"
    assert got["Original", "KPSS"] == "Non-Stationary"
    assert got["Differenced", "ADF"] == "Stationary"
    assert got["Differenced", "KPSS"] == "Stationary"


def test_acf_and_pacf_of_an_ar1(spark):
    y = ar1(4000, 0.6, seed=5)
    df = series(spark, y)
    got = {r["lag"]: r["acf"] for r in stats.acf(df, 5).collect()}
    d = y - y.mean()
    for k in range(6):
        assert got[k] == pytest.approx(float(d[k:] @ d[: len(d) - k]) / float(d @ d), rel=1e-9)
    p = {r["lag"]: r["pacf"] for r in stats.pacf(df, 5).collect()}
    assert p[1] == pytest.approx(got[1]) and p[1] == pytest.approx(0.6, abs=0.05)
    assert abs(p[2]) < 0.06


def test_constant_series_has_no_acf(spark):
    assert {r["acf"] for r in stats.acf(series(spark, [2.0] * 60), 3).collect()} == {None}


def test_stl_recovers_trend_and_season(spark):
    t = np.arange(24 * 40)
    season, trend = 2 * np.sin(2 * np.pi * t / 24), 0.01 * t
    noise = np.random.default_rng(0).normal(0, 0.1, len(t))
    out = decompose.stl(series(spark, trend + season + noise), 24).orderBy("timestamp").toPandas()
    assert np.abs(out["value"] - out["trend"] - out["seasonal"] - out["resid"]).max() < 1e-9
    middle = slice(48, -48)
    assert np.abs(out["seasonal"].to_numpy() - season)[middle].max() < 0.3
    assert np.abs(out["trend"].to_numpy() - trend)[middle].max() < 0.3
    strength = {r["strength_type"]: r["value"] for r in stats.seasonality_strength(spark.createDataFrame(out), ["series_id"]).collect()}
    assert strength["seasonal"] > 0.98 and strength["trend"] > 0.98


def test_stl_of_a_straight_line_and_of_too_few_points(spark):
    line = decompose.stl(series(spark, 3.0 + 0.5 * np.arange(24 * 8)), 24).toPandas()
    assert np.abs(line["resid"]).max() < 1e-6 and np.abs(line["seasonal"]).max() < 1e-6
    short = decompose.stl(series(spark, range(30)), 24).toPandas()
    assert short["trend"].isna().all() and len(short) == 30


def test_stl_resists_outliers(spark):
    t = np.arange(24 * 30)
    season = np.sin(2 * np.pi * t / 24)
    y = season + np.random.default_rng(0).normal(0, 0.1, len(t))
    y[200] += 50
    out = decompose.stl(series(spark, y), 24).orderBy("timestamp").toPandas()
    assert np.abs(out["seasonal"].to_numpy() - season)[100:300].max() < 0.3
    assert out["resid"].iloc[200] == pytest.approx(50, abs=0.5)


def test_stl_imputation_fills_gaps_only(spark):
    t = np.arange(24 * 40)
    y = 5 + np.sin(2 * np.pi * t / 24) + np.random.default_rng(0).normal(0, 0.1, len(t))
    holes = {i for first in (100, 330, 571, 800) for i in range(first, first + 10)}
    gaps = [None if i in holes else float(v) for i, v in enumerate(y)]
    df = series(spark, gaps)
    got = values(decompose.impute_stl(df, "value"))
    assert all(a == b for a, b in zip(gaps, got) if a is not None)
    assert all(v is not None for v in got)
    line = values(impute.interpolate(df, ["value"]))

    def error(filled):
        return np.sqrt(np.mean([(filled[i] - y[i]) ** 2 for i in holes]))

    assert error(got) < 0.8 * error(line)


def test_shapiro_known_values():
    w, p = stats.shapiro_wilk(np.arange(1.0, 11.0))
    assert (w, p) == (pytest.approx(0.97016, abs=1e-4), pytest.approx(0.8924, abs=1e-3))
    w, p = stats.shapiro_wilk(np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236.0]))
    assert (w, p) == (pytest.approx(0.79, abs=5e-3), pytest.approx(0.0067, abs=5e-4))
    assert stats.shapiro_wilk(np.ones(10)) == (None, None)


def test_normality_verdict(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.normal(size=800), rng.exponential(size=800)))]
    df = spark.createDataFrame(rows, "id int, normal_values double, skewed double")
    got = {r["variable"]: r["normal"] for r in stats.normality(df, ["normal_values", "skewed"], ["id"]).collect()}
    assert got == {"normal_values": True, "skewed": False}


def test_shapiro_wilk_says_what_it_cannot_take(spark):
    with pytest.raises(ValueError, match="5000"):
        stats.normality(spark.createDataFrame([(1, 1.0)], "id int, x double"), ["x"], ["id"], sample=6000)


def test_shapiro_francia_over_all_rows(spark):
    rng = np.random.default_rng(2)
    n = 6000
    columns = {"bell": rng.normal(3, 2, n), "skewed": rng.exponential(size=n), "ties": np.round(rng.normal(size=n), 1)}
    rows = [tuple(float(v[i]) for v in columns.values()) + (1.0, None) for i in range(n)]
    df = spark.createDataFrame(rows, "bell double, skewed double, ties double, same double, none double")
    got = {r["variable"]: r for r in stats.shapiro_francia(df, ["bell", "skewed", "ties", "same", "none"]).collect()}
    scores = [NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    for name, values in columns.items():
        assert got[name]["n"] == n
        assert got[name]["statistic"] == pytest.approx(np.corrcoef(np.sort(values), scores)[0, 1] ** 2, abs=1e-9)
    assert got["bell"]["normal"] and not got["skewed"]["normal"]
    assert got["same"]["statistic"] is None and got["none"]["n"] == 0 and got["none"]["p_value"] is None


def test_normal_probability(spark):
    zs = [-4.0, -1.3, 0.0, 0.4, 2.5]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select(stats.normal_probability(F.col("z"))).collect()
    assert [r[0] for r in got] == pytest.approx([NormalDist().cdf(z) for z in zs], abs=1e-7)


def test_normal_quantile_and_qq(spark):
    ps = [0.001, 0.02, 0.3, 0.5, 0.9, 0.99, 0.9999]
    df = spark.createDataFrame([(p,) for p in ps], "p double").withColumn("z", profile.normal_quantile(F.col("p")))
    for r in df.collect():
        assert r["z"] == pytest.approx(NormalDist().inv_cdf(r["p"]), abs=1e-8)
    y = np.concatenate([np.random.default_rng(0).normal(3, 2, 700), [3.0] * 5])
    points = profile.qq_points(series(spark, y), "value", step=3).orderBy("rank").collect()
    assert [r["ordered"] for r in points] == sorted(y.tolist())
    line = profile.qq_line(profile.qq_points(series(spark, y), "value")).first()
    assert line["slope"] == pytest.approx(2, abs=0.15) and line["intercept"] == pytest.approx(3, abs=0.2) and line["r"] > 0.99


def test_mutual_information_ranks_the_informative_feature(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=2000)
    rows = [(float(a), float(b), float(a * a + 0.1 * c)) for a, b, c in zip(x, rng.normal(size=2000), rng.normal(size=2000))]
    df = spark.createDataFrame(rows, "x double, noise double, y double")
    got = stats.mutual_information(df, "y", ["noise", "x"]).collect()
    assert got[0]["feature"] == "x" and got[0]["mutual_information"] > 3 * got[1]["mutual_information"]


def test_permutation_importance_ranks_the_informative_feature(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), float(3 * a)) for i, (a, b) in enumerate(rng.normal(size=(600, 2)))]
    df = spark.createDataFrame(rows, "id long, x double, noise double, y double")
    got = {r["feature"]: r["permutation"] for r in stats.permutation_importance(df, "y", ["x", "noise"], ["id"], trees=10, depth=5, repeats=2).collect()}
    assert got["x"] > 0.5 and abs(got["noise"]) < 0.2


def test_yeo_johnson(spark):
    rng = np.random.default_rng(0)
    rows = [(float(v),) for v in np.exp(rng.normal(size=3000)) - 1]
    df = spark.createDataFrame(rows, "v double")
    lam = features.yeo_johnson_lambda(df, ["v"])["v"]
    assert lam < 0.4  # a log-like transform
    one = df.select(features.yeo_johnson("v", 1.0).alias("t"), "v")
    assert one.where("abs(t - v) > 1e-12").count() == 0


def test_sample_moments(spark):
    y = np.random.default_rng(0).exponential(size=50)
    row = series(spark, y).agg(profile.sample_skewness("value").alias("s"), profile.sample_kurtosis("value").alias("k")).first()
    import pandas as pd

    assert row["s"] == pytest.approx(pd.Series(y).skew()) and row["k"] == pytest.approx(pd.Series(y).kurt())


def test_calendar_names(spark):
    rows = features.calendar_features(series(spark, [0.0] * 24 * 7)).orderBy("timestamp").collect()
    assert rows[0]["day_name"] == "Monday" and rows[0]["dayofweek"] == 0 and rows[0]["is_weekend"] == 0
    assert rows[-1]["day_name"] == "Sunday" and rows[-1]["is_weekend"] == 1 and hours(1)[0] == rows[0]["day"]
