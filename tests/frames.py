"""Small tables for tests."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np

START = datetime(2024, 1, 1)
SERIES = "series_id string, timestamp timestamp_ntz, value double"


def hours(n: int, start: datetime = START) -> list[datetime]:
    return [start + timedelta(hours=i) for i in range(n)]


def series(spark, values, name: str = "a", start: datetime = START, step: int = 1):
    """One hourly series; None is a gap."""
    rows = [
        (name, start + timedelta(hours=step * i), None if v is None or math.isnan(v) else float(v)) for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, SERIES)


def values(df, column: str = "value") -> list:
    return [r[column] for r in df.orderBy("timestamp").collect()]


def ar1(n: int, phi: float, seed: int = 1, mean: float = 5.0) -> np.ndarray:
    rng = np.random.default_rng(seed)
    y = np.zeros(n)
    for i in range(1, n):
        y[i] = phi * y[i - 1] + rng.normal()
    return y + mean


def gappy(n: int, share: float, seed: int = 2) -> list:
    rng = np.random.default_rng(seed)
    return [None if rng.random() < share else float(rng.normal(10, 3)) for _ in range(n)]
