"""Registered queries against their SQL on the smallest tables.

By default one or two queries per operator family; FLEETWATT_ALL=1 takes them all.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from oracle import connect, run

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
CHOSEN = """
    scan_projection csv_roundtrip parquet_sink alias_normalise ts_normalise dedup_first last_n_days filter_fallback quality_checks
    tail_n clean_dataset clean_log resample_daily_gaps interp_limit4 interp_pos ffill_bfill impute_knn missing_summary missing_runs
    lag_features feature_table yeo_johnson describe moments corr_matrix histogram boxplot_by_hour qq_ranks energy_kpis insights
    acf pacf kpss seasonality_strength mutual_information normality naive_24h naive_7d ar1_walk_forward arima_forecast
    metrics_train_range metrics_summary best_model stat_vs_ml dispatch_kpis dispatch_validate dispatch_invariants
    fold_training_rows rolling_members rolling_members_2_7 gbt_skill gbt_halves_error early_stop_check
""".split()
NAMES = sorted(QUERIES) if os.environ.get("FLEETWATT_ALL") else CHOSEN


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    problem, rows, _, _ = run(spark, con, name, SF, QUERIES, ORACLES)
    assert problem is None, problem
    assert rows > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 48
