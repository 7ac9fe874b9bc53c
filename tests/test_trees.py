"""Boosting that stops early, and the fold table of the tree member."""

from __future__ import annotations

import datetime as dt
import threading
import time

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from fleetwatt.operators import folds, trees

START = dt.datetime(2024, 1, 1)


def hourly(spark, days: dict[str, int]):
    """A label that is a step of its feature, on a grid of hours."""
    rows = [
        (s, START + dt.timedelta(hours=h), 5.0 * (h % 24 >= 12), [float(h % 24)]) for s, n in days.items() for h in range(24 * n)
    ]
    df = spark.createDataFrame(rows, "series_id string, timestamp timestamp_ntz, label double, features array<double>")
    return df.withColumn("features", array_to_vector("features"))


def test_tail_is_the_newest_days_of_each_series(spark):
    marked = trees.with_tail(hourly(spark, {"a": 5, "b": 9}), days=2)
    got = marked.groupBy("series_id").agg(F.count_if("in_tail").alias("n"), F.min(F.when(F.col("in_tail"), F.col("timestamp"))).alias("first")).collect()
    assert {r.series_id: (r.n, r.first) for r in got} == {"a": (48, START + dt.timedelta(days=3)), "b": (48, START + dt.timedelta(days=7))}


def test_stopping_needs_both_kinds_of_rows(spark):
    rows = hourly(spark, {"a": 2})
    for days in (0, 9):
        with pytest.raises(ValueError, match="rows are there"):
            trees.fit_gbt(trees.with_tail(rows, days=days), 5, validation="in_tail")


def test_best_round_is_kept(spark):
    noise = F.pmod(F.hash("timestamp"), F.lit(11)) - 5
    rows = trees.with_tail(hourly(spark, {"a": 8}).withColumn("label", F.col("label") + noise), days=2)
    model = trees.fit_gbt(rows, 40, validation="in_tail")
    errors = model.evaluateEachIteration(rows.where("in_tail"), "squared")
    assert 1 <= model.getNumTrees < 40 and len(errors) == model.getNumTrees
    assert errors[-1] == min(errors)


def test_fold_table(spark):
    rows = hourly(spark, {"a": 10, "b": 4})
    days = folds.daily_folds(rows)
    got = {(r.series_id, r.timestamp): (r.trains_from, r.tested) for r in trees.fold_table(rows, days).collect()}
    assert len(got) == 14 * 24
    for (s, t), (trains_from, tested) in got.items():
        day = (t - START).days
        first, last = (3, 9) if s == "a" else (0, 3)  # days of the oldest and the newest fold
        assert tested == (day - first + 1 if day >= first else None)
        assert trains_from == (None if day == last else max(day - first + 2, 1))


def test_training_rows_never_reach_the_fold(spark):
    rows = hourly(spark, {"a": 12})
    table = trees.fold_table(rows, folds.daily_folds(rows))
    for r in trees.fold_training_rows(table, 2).collect():
        start = START + dt.timedelta(days=4 + r.fold)
        assert r.newest == start - dt.timedelta(hours=1) and r.rows == (4 + r.fold) * 24 and r.tail_rows == 48


def test_fold_forecasts(spark):
    rows = hourly(spark, {"a": 12, "b": 11})
    out, rounds = trees.fold_forecasts(trees.fold_table(rows, folds.daily_folds(rows)), [1, 6, 7], 10, tail_days=1)
    got = out.groupBy("series_id", "fold").agg(F.count("y_pred").alias("n"), F.max(F.abs(F.col("y_pred") - F.col("y_true"))).alias("gap")).collect()
    assert {(r.series_id, r.fold, r.n) for r in got} == {(s, f, 24) for s in "ab" for f in (1, 6, 7)}
    assert max(r.gap for r in got) < 0.5 and set(rounds) == {1, 6, 7}


def test_together_keeps_order_and_bound(spark):
    running, most, lock = [0], [0], threading.Lock()

    def job(k):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.05)
        with lock:
            running[0] -= 1
        return k

    assert trees.together(spark, [lambda k=k: job(k) for k in range(9)], 3) == list(range(9))
    assert 1 < most[0] <= 3


def test_exog_models_are_fitted_together(spark, monkeypatch):
    both, fit = threading.Barrier(2, timeout=60), trees.fit_gbt

    def waits(*args, **kw):
        both.wait()
        return fit(*args, **kw)

    monkeypatch.setattr(trees, "fit_gbt", waits)
    rows = hourly(spark, {"a": 12}).select("series_id", "timestamp", F.col("label").alias("Demand"), F.dayofmonth("timestamp").cast("double").alias("Price"))
    got = trees.exog_comparison(rows, "Demand", ["Price"], trees=2, days=2).collect()
    assert sorted(r.model_name for r in got) == ["GBT (AR only)", "GBT (with exog)"]


def test_levels_keep_no_node_ids(spark):
    assert not trees.fit_gbt(hourly(spark, {"a": 3}), 1).getCacheNodeIds()
