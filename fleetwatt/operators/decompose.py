"""Seasonal-trend decomposition by LOESS (Cleveland et al., 1990).

One series is smoothed as a whole, so this is a grouped job.  Its input is a
complete calendar, which bounds the group: 8,760 numbers per series and year.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import as_column
from fleetwatt.operators.impute import interpolate


def _loess(y: np.ndarray, span: int, at: np.ndarray, robust: np.ndarray) -> np.ndarray:
    """Local lines through ``y`` (rows: series, columns: points 0..n-1) at positions ``at``.

    Each position uses its ``span`` nearest points with tricube weights.
    """
    n = y.shape[1]
    q = min(span, n)
    left = np.clip(at - (q - 1) // 2, 0, n - q).astype(int)
    cols = left[:, None] + np.arange(q)
    gap = np.abs(cols - at[:, None])
    width = np.maximum(at - left, left + q - 1 - at).astype(float)
    if span > n:
        width += (span - n) / 2
    width = np.maximum(width, 1e-9)
    share = gap / width[:, None]
    near = np.where(share <= 0.999, (1 - np.minimum(share, 1) ** 3) ** 3, 0.0)
    near = np.where(share <= 0.001, 1.0, near)
    w = near[None] * robust[:, cols]
    total = w.sum(axis=2)
    known = total > 0
    w = w / np.where(known, total, 1)[..., None]
    pos = cols[None].astype(float)
    centre = (w * pos).sum(axis=2)
    spread = (w * (pos - centre[..., None]) ** 2).sum(axis=2)
    tilt = np.where(np.sqrt(spread) > 0.001 * (n - 1), (at[None] - centre) / np.where(spread > 0, spread, 1), 0.0)
    w = w * (1 + tilt[..., None] * (pos - centre[..., None]))
    fit = (w * y[:, cols]).sum(axis=2)
    nearest = np.clip(at, 0, n - 1).astype(int)
    return np.where(known, fit, y[:, nearest])


def _moving_mean(x: np.ndarray, k: int) -> np.ndarray:
    c = np.cumsum(np.concatenate([[0.0], x]))
    return (c[k:] - c[:-k]) / k


def _odd(x: float) -> int:
    k = math.ceil(x)
    return k if k % 2 else k + 1


def stl_arrays(
    y: np.ndarray, period: int, seasonal: int = 7, robust: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trend, seasonal and remainder of one complete series."""
    n = len(y)
    trend_span = _odd(1.5 * period / (1 - 1.5 / seasonal))
    low_span = _odd(period + 1)
    inner, outer = (2, 15) if robust else (5, 0)
    trend, season = np.zeros(n), np.zeros(n)
    rho = np.ones(n)
    everywhere = np.arange(n, dtype=float)
    for step in range(outer + 1):
        for _ in range(inner):
            cycle = np.empty(n + 2 * period)
            detrended = y - trend
            for length in {len(range(p, n, period)) for p in range(period)}:
                phases = [p for p in range(period) if len(range(p, n, period)) == length]
                block = np.stack([detrended[p::period] for p in phases])
                weight = np.stack([rho[p::period] for p in phases])
                wide = _loess(block, seasonal, np.arange(-1, length + 1, dtype=float), weight)
                for p, row in zip(phases, wide):
                    cycle[p :: period][: length + 2] = row
            low = _moving_mean(_moving_mean(_moving_mean(cycle, period), period), 3)
            low = _loess(low[None], low_span, everywhere, np.ones((1, n)))[0]
            season = cycle[period : period + n] - low
            trend = _loess((y - season)[None], trend_span, everywhere, rho[None])[0]
        if step < outer:
            r = np.abs(y - trend - season)
            scale = 6 * np.median(r)
            if scale <= 0:
                break
            share = r / scale
            rho = np.where(share <= 0.999, (1 - np.minimum(share, 1) ** 2) ** 2, 0.0)
            rho = np.where(share <= 0.001, 1.0, rho)
    return trend, season, y - trend - season


def stl(
    df: DataFrame,
    period: int,
    seasonal: int = 7,
    robust: bool = True,
    value: str = "value",
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
) -> DataFrame:
    """``keys, time, value, trend, seasonal, resid`` on a complete, null-free grid.

    A series shorter than two periods has null components.
    """
    rows = df.select(*keys, time, as_column(value).cast("double").alias("value"))
    parts = ["trend", "seasonal", "resid"]
    schema = T.StructType([*rows.schema.fields, *[T.StructField(p, T.DoubleType()) for p in parts]])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(time, ignore_index=True)
        y = pdf["value"].to_numpy(float)
        if len(y) < 2 * period or np.isnan(y).any():
            return pdf.assign(**{p: None for p in parts})
        t, s, r = stl_arrays(y, period, seasonal, robust)
        return pdf.assign(trend=t, seasonal=s, resid=r)

    return rows.groupBy(*keys).applyInPandas(run, schema)


def impute_stl(
    df: DataFrame, value: str = "value", period: int = 24, keys: Sequence[str] = (KEY,), time: str = TIME
) -> DataFrame:
    """Gaps filled with trend + seasonal + interpolated remainder; readings stay as they are."""
    grid = df.select(*keys, time, as_column(value).cast("double").alias("value"))
    parts = stl(interpolate(grid, ["value"], keys, time), period, keys=keys, time=time)
    rest = grid.withColumnRenamed("value", "_known").join(parts, [*keys, time])
    rest = rest.withColumn("_rest", F.when(F.col("_known").isNotNull(), F.col("resid")))
    rest = interpolate(rest, ["_rest"], keys, time)
    filled = F.coalesce("_known", F.col("trend") + F.col("seasonal") + F.col("_rest"), F.col("value"))
    return rest.select(*keys, time, filled.alias(value))
