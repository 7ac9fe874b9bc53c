"""Ordered operators against pandas and plain loops, across slice borders."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetwatt.functions.ordered import newest, running_total, with_lags
from fleetwatt.functions.quantiles import exact_quantiles
from fleetwatt.operators import clean, coerce, grid, impute, missing
from fleetwatt.plans import load_all
from frames import SERIES, START, gappy, hours, series, values

# 2,000 hours cross three month borders
N = 2000
GAPS = gappy(N, 0.6)
GAPS[:9] = [None] * 9
GAPS[-7:] = [None] * 7
GAPS[700:800] = [None] * 100


def as_pandas(vals=None) -> pd.Series:
    vals = GAPS if vals is None else vals
    return pd.Series([np.nan if v is None else v for v in vals], index=pd.DatetimeIndex(hours(len(vals))))


def same(got: list, want: pd.Series) -> None:
    got = np.array([np.nan if v is None else v for v in got])
    np.testing.assert_allclose(got, want.to_numpy(), rtol=1e-12, equal_nan=True)


@pytest.mark.parametrize(
    "kind,want",
    [
        (dict(by="time"), dict(method="time", limit_direction="both")),
        (dict(by="time", both=False), dict(method="time")),
        (dict(by="time", limit=4), dict(method="time", limit=4, limit_direction="both")),
        (dict(by="position"), dict(method="linear", limit_direction="both")),
    ],
)
def test_interpolation_equals_pandas(spark, kind, want):
    got = impute.interpolate(series(spark, GAPS), ["value"], **kind)
    same(values(got), as_pandas().interpolate(**want))


def test_irregular_rows(spark):
    kept = [i for i in range(N) if i % 5 not in (1, 2)]
    rows = [("a", START + timedelta(hours=i), GAPS[i]) for i in kept]
    df = spark.createDataFrame(rows, SERIES)
    p = as_pandas().iloc[kept]
    same(values(impute.interpolate(df, ["value"])), p.interpolate("time", limit_direction="both"))
    same(values(impute.interpolate(df, ["value"], by="position")), p.interpolate(limit_direction="both"))
    same(values(impute.forward_fill(df, ["value"], limit=3)), p.ffill(limit=3))


def test_gap_between_readings_of_one_moment(spark):
    rows = [("a", START, v, n) for n, v in enumerate([1.0, None, 3.0])]
    df = spark.createDataFrame(rows, SERIES + ", n int")
    got = impute.interpolate(df, ["value"], order=["n"]).orderBy("n").collect()
    assert [r["value"] for r in got] == [1.0, 3.0, 3.0]


def test_forward_fill_equals_pandas(spark):
    df = series(spark, GAPS)
    same(values(impute.forward_fill(df, ["value"], limit=3)), as_pandas().ffill(limit=3))
    same(values(impute.forward_fill(df, ["value"], then_back=True)), as_pandas().ffill().bfill())


def test_fill_keeps_known_values_whatever_the_partitioning(spark):
    df = series(spark, GAPS)
    one = values(impute.interpolate(df.repartition(1), ["value"]))
    many = values(impute.interpolate(df.repartition(8), ["value"]))
    assert one == many
    assert all(a == b for a, b in zip(GAPS, one) if a is not None)


@pytest.mark.parametrize("vals", [[], [1.0], [None], [None, None, None], [2.0, 2.0]])
def test_tiny_series(spark, vals):
    got = values(impute.interpolate(series(spark, vals), ["value"]))
    assert got == [v for v in vals]


def test_missing_runs_equal_a_loop(spark):
    times, want, begin = hours(N), [], None
    for t, v in zip(times, GAPS):
        if v is None and begin is None:
            begin = t
        elif v is not None and begin is not None:
            want.append((begin, t, (t - begin).total_seconds() / 3600))
            begin = None
    if begin is not None:
        want.append((begin, times[-1], (times[-1] - begin).total_seconds() / 3600))
    got = missing.missing_runs(series(spark, GAPS), "value").orderBy("start").collect()
    assert [(r["start"], r["end"], r["length_hours"]) for r in got] == want


def test_open_final_run_of_one_row_has_no_length(spark):
    got = missing.missing_runs(series(spark, [1.0, None]), "value").collect()
    assert [r["length_hours"] for r in got] == [0.0]


def test_lags_cross_slices(spark):
    full = [float(i) for i in range(N)]
    got = with_lags(series(spark, full), {"l1": ("value", 1), "l800": ("value", 800)}, past={"p": ("value", 48)})
    rows = got.orderBy("timestamp").collect()
    assert len(rows) == N
    for i in (0, 1, 743, 744, 745, 1500, 1999):
        assert rows[i]["l1"] == (i - 1.0 if i >= 1 else None)
        assert rows[i]["l800"] == (i - 800.0 if i >= 800 else None)
        assert rows[i]["p"] == [float(j) for j in range(i, max(i - 48, 0) - 1, -1)]


def test_running_total_and_newest(spark):
    full = [float(i % 7) for i in range(N)]
    df = series(spark, full)
    got = values(running_total(df, {"total": F.col("value")}), "total")
    np.testing.assert_allclose(got, np.cumsum(full))
    last = newest(df, 900, ["series_id"]).orderBy("timestamp").collect()
    assert [r["timestamp"] for r in last] == hours(N)[-900:]


def test_finer_slices_change_nothing(spark):
    gaps = series(spark, GAPS)
    want = values(impute.interpolate(gaps, ["value"], limit=4))
    for unit in ("day", "hour"):
        assert values(impute.interpolate(gaps, ["value"], limit=4, unit=unit)) == want


def test_rows_without_a_series_stay(spark):
    rows = [("a", hours(30)[i], float(i) if i % 3 else None) for i in range(30)]
    rows += [(None, hours(30)[i], None if i % 2 else 1.0) for i in range(10)] + [("a", None, 5.0), ("a", None, None)]
    df = spark.createDataFrame(rows, "series_id string, timestamp timestamp_ntz, value double")
    got = impute.interpolate(df, ["value"]).collect()
    assert len(got) == len(rows)
    loose = sorted(str(r["value"]) for r in got if r["series_id"] is None or r["timestamp"] is None)
    assert loose == sorted(str(v) for k, t, v in rows if k is None or t is None)
    assert all(r["value"] is not None for r in got if r["series_id"] and r["timestamp"])
    total = running_total(df, {"total": F.col("value")}).collect()
    assert len(total) == len(rows) and sum(r["total"] is None for r in total) == 12


def test_exact_quantiles_on_skewed_and_tied_values(spark):
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.lognormal(0, 3, 4000), np.zeros(3000), [1e12, -5.0]])
    rows = [("a" if i % 3 else "b", START, float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, SERIES)
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 0.999, 1.0]
    got = {(r["series_id"], r["prob"]): r["quantile"] for r in exact_quantiles(df, ["series_id"], "value", probs).collect()}
    for name in "ab":
        mine = np.array([v for s, _, v in rows if s == name])
        for p in probs:
            assert got[name, p] == pytest.approx(np.quantile(mine, p), rel=1e-12, abs=1e-300)


def test_resample_empty_bins(spark):
    t0 = datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t0, 1.0), ("a", t0 + timedelta(hours=3, minutes=20), 4.0), ("a", t0 + timedelta(hours=3), 2.0)], SERIES)
    rows = grid.resample(df, {"m": ("value", "mean"), "s": ("value", "sum"), "n": ("value", "count")}).orderBy("timestamp").collect()
    assert [(r["m"], r["s"], r["n"]) for r in rows] == [(1.0, 1.0, 1), (None, 0.0, 0), (None, 0.0, 0), (3.0, 6.0, 2)]


def test_dedup_keeps_the_first(spark):
    rows = [("a", START, float(i)) for i in (3, 1, 2)] + [("a", START + timedelta(hours=1), 9.0)]
    df = spark.createDataFrame(rows, SERIES).withColumn("n", F.col("value") * 10)
    got = coerce.dedup_first(df, ["value"]).orderBy("timestamp").collect()
    assert [(r["value"], r["n"]) for r in got] == [(1.0, 10.0), (9.0, 90.0)]


def test_bad_text(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00+00:00", "1.5"), ("a", "2024-01-01T01:00:00+01:00", "x"), ("a", "bad", "2"), ("a", None, "NaN")],
        "series_id string, timestamp string, value string",
    )
    got = coerce.normalise_time(df).collect()
    assert [r["timestamp"] for r in got] == [START, START]
    assert [r["value"] for r in coerce.coerce_numeric(df, ["value"]).collect()] == [1.5, None, 2.0, None]
    assert coerce.text_columns_with_numbers(df, skip=["series_id", "timestamp"]) == ["value"]


def test_column_resolvers(spark):
    df = spark.createDataFrame([(1.0, 2.0, "x", 3)], "Demand double, pv_mod1 double, name string, hour int")
    assert coerce.columns_like(df, ("pv", "mod")) == ["pv_mod1"]
    assert coerce.columns_starting(df, "PV") == ["pv_mod1"]
    assert coerce.resolve_target(df, "demand") == "Demand"
    assert coerce.resolve_features(df, "Demand") == ["pv_mod1", "hour"]
    assert coerce.resolve_features(df, "Demand", also_in=df.select("hour")) == ["hour"]
    with pytest.raises(ValueError):
        coerce.resolve_target(df, "load")
    with pytest.raises(ValueError):
        coerce.resolve_features(df, "Demand", ["absent"])


def test_clean_log_counts(spark):
    demand = [1.0, None, None, None, None, None, -2.0, 3.0]
    pv = [None, 1.0, None, None, 4.0, -1.0, 0.5, None]
    rows = [("a", t.isoformat(sep=" "), d, p) for t, d, p in zip(hours(8), demand, pv)] + [("a", "soon", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "series_id string, timestamp string, Demand double, pv double")
    out = clean.clean_dataset(df)
    log = {(r["step"], r["column"]): r["count"] for r in out.log.collect()}
    assert log["drop invalid timestamps", "timestamp"] == 1
    assert log["interpolated pv", "pv"] == 4
    assert log["forward-filled demand", "Demand"] == 3
    assert log["clipped negatives", "pv"] == 1
    assert log["clipped negatives", "Demand"] == 1
    assert log["dropped rows with long demand gaps", "*"] == 2
    assert values(out.data, "Demand") == [1.0, 1.0, 1.0, 1.0, 0.0, 3.0]
    assert values(out.data, "pv") == [1.0, 1.0, 2.0, 3.0, 0.5, 0.5]


def test_fallback_and_samples(spark):
    df = series(spark, range(50)).withColumn("model_name", F.when(F.col("value") < 10, "x").otherwise("y"))
    assert coerce.with_fallback(df, "model_name", ["none", "x"]).count() == 10
    assert coerce.with_fallback(df, "model_name", ["none"]).count() == 50
    one = coerce.sample_rows(df, 7, ["timestamp"]).collect()
    assert one == coerce.sample_rows(df.repartition(5), 7, ["timestamp"]).collect() and len(one) == 7
    per = coerce.sample_per_group(df, 5, ["model_name"], ["timestamp"])
    assert [r["count"] for r in per.groupBy("model_name").count().collect()] == [5, 5]


def test_knn_prefers_the_nearest_donor(spark):
    rows = []
    for day in range(6):
        rows.append(("a", START + timedelta(days=day), 10.0 * day if day else None, 3.0 if day in (0, 4) else float(day * 100)))
    df = spark.createDataFrame(rows, "series_id string, timestamp timestamp_ntz, target double, x double")
    got = impute.knn_impute(df, "target", ["x"]).orderBy("timestamp").first()
    assert got["target"] == 40.0  # the donor at distance zero decides


def test_knn_without_a_donor_takes_the_mean(spark):
    rows = [("a", START, None, None), ("a", START + timedelta(hours=1), 4.0, 1.0), ("a", START + timedelta(hours=2), 6.0, 1.0)]
    df = spark.createDataFrame(rows, "series_id string, timestamp timestamp_ntz, target double, x double")
    assert impute.knn_impute(df, "target", ["x"]).orderBy("timestamp").first()["target"] == 5.0


def test_resample_unfolds_after_the_aggregates(spark):
    """No task aggregates or shuffles the empty slots: they come last, slice by slice."""
    known = [("a", datetime(2024, 1, 1, 0, 10), 1.0), ("a", datetime(2024, 1, 1, 0, 40), 3.0), ("a", datetime(2024, 4, 1, 5), 5.0), ("a", None, 7.0)]
    known += [(None, datetime(2024, 1, 31, 23), 1.0), (None, datetime(2024, 2, 1, 1), None), ("b", None, None)]
    df = spark.createDataFrame(known, SERIES)
    got = grid.resample(df, {"m": ("value", "mean"), "s": ("value", "sum"), "n": ("value", "count"), "x": ("value", "max")})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Aggregate")
    rows = {(r.series_id, r.timestamp): (r.m, r.s, r.n, r.x) for r in got.collect()}
    hours = [datetime(2024, 1, 1) + timedelta(hours=h) for h in range(91 * 24 + 6)]
    want = {("a", t): (None, 0.0, 0, None) for t in hours}
    want |= {("a", hours[0]): (2.0, 4.0, 2, 3.0), ("a", hours[-1]): (5.0, 5.0, 1, 5.0), ("a", None): (7.0, 7.0, 1, 7.0), ("b", None): (None, 0.0, 0, None)}
    want |= {(None, datetime(2024, 1, 31, 23)): (1.0, 1.0, 1, 1.0)} | {(None, datetime(2024, 2, 1, h)): (None, 0.0, 0, None) for h in (0, 1)}
    assert rows == want and got.count() == len(want)


def test_queries_read_small_shuffle_tasks(spark):
    """Rows of a grid take 20 times their shuffled bytes when sorted."""
    registry, size = load_all(), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    default = spark.conf.get(size)
    try:
        registry.QUERIES["resample_fleet"](spark, "/root/testdata/sf0.001")
        assert spark.conf.get(size) == registry.TASK_BYTES == "16m"
    finally:
        spark.conf.set(size, default)
