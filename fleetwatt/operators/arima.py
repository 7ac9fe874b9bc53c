"""ARIMA-family forecasts by two-stage least squares (Hannan and Rissanen, 1982).

Each row of a grid carries its own recent past as an array, so a long
autoregression, its residuals and the final regression are row-wise work plus
moment sums.  A series is never gathered; folds share one pass over its rows.
The estimates are least squares, not exact maximum likelihood.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import SLOT_SECONDS, as_column, epoch, later
from fleetwatt.functions.leastsq import moments, solve, stack_arrays, unpack
from fleetwatt.functions.ordered import with_lags


@dataclass(frozen=True)
class Spec:
    """Orders (p, d, q) and (P, D, Q, s), and the exogenous columns."""

    order: tuple[int, int, int]
    seasonal: tuple[int, int, int, int] | None = None
    exog: tuple[str, ...] = field(default_factory=tuple)

    @property
    def name(self) -> str:
        head = "SARIMA" if self.seasonal else ("ARIMAX" if self.exog else "ARIMA")
        text = head + "(" + ",".join(map(str, self.order)) + ")"
        return text + "(" + ",".join(map(str, self.seasonal)) + ")" if self.seasonal else text

    def _lags(self, near: int, far: int, s: int) -> list[int]:
        return sorted({i + s * j for i in range(near + 1) for j in range(far + 1)} - {0})

    @property
    def ar(self) -> list[int]:
        far, s = (self.seasonal[0], self.seasonal[3]) if self.seasonal else (0, 0)
        return self._lags(self.order[0], far, s)

    @property
    def ma(self) -> list[int]:
        far, s = (self.seasonal[2], self.seasonal[3]) if self.seasonal else (0, 0)
        return self._lags(self.order[2], far, s)

    @property
    def shifts(self) -> np.ndarray:
        """Coefficients of (1-B)^d (1-B^s)^D by power of B."""
        poly = np.ones(1)
        for _ in range(self.order[1]):
            poly = np.convolve(poly, [1.0, -1.0])
        if self.seasonal:
            step = np.zeros(self.seasonal[3] + 1)
            step[0], step[-1] = 1.0, -1.0
            for _ in range(self.seasonal[1]):
                poly = np.convolve(poly, step)
        return poly

    @property
    def constant(self) -> bool:
        return len(self.shifts) == 1

    @property
    def long_ar(self) -> int:
        """Length of the first autoregression; zero if no moving average needs one."""
        return max([*self.ar, *self.ma]) + 4 if self.ma else 0

    @property
    def depth(self) -> int:
        """Differenced values a row must look back on."""
        return max([*self.ar, *[m + self.long_ar for m in self.ma], 1])

    @property
    def reach(self) -> int:
        return self.depth + len(self.shifts) - 1


def _differenced(y: np.ndarray, spec: Spec) -> np.ndarray:
    """Column k is the differenced value k slots back."""
    c = spec.shifts
    width = y.shape[1] - len(c) + 1
    return sum(c[j] * y[:, j : j + width] for j in range(len(c)))


def _block(pdf: pd.DataFrame, spec: Spec) -> tuple[np.ndarray, list[np.ndarray]]:
    return _differenced(stack_arrays(pdf["_y"]), spec), [_differenced(stack_arrays(pdf[f"_z{i}"]), spec) for i in range(len(spec.exog))]


def _first_design(w: np.ndarray, z: Sequence[np.ndarray], k: int, spec: Spec) -> np.ndarray:
    cols = [np.ones(len(w))] if spec.constant else []
    return np.column_stack([*cols, *[e[:, k] for e in z], w[:, k + 1 : k + 1 + spec.long_ar]])


def _shock(w: np.ndarray, z: Sequence[np.ndarray], k: int, phi: np.ndarray, spec: Spec) -> np.ndarray:
    return w[:, k] - _first_design(w, z, k, spec) @ phi


def _final_design(w: np.ndarray, z: Sequence[np.ndarray], shocks: Sequence[np.ndarray], spec: Spec, back: int = 0) -> np.ndarray:
    cols = [np.ones(len(w))] if spec.constant else []
    parts = [*cols, *[e[:, back] for e in z], *[w[:, back + k] for k in spec.ar], *shocks]
    return np.column_stack(parts) if parts else np.zeros((len(w), 0))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _fit(moment: pd.Series) -> pd.Series:
    def run(m: np.ndarray) -> np.ndarray | None:
        xtx, xty, _, n = unpack(m)
        return solve(xtx, xty) if n > 2 * len(xtx) else None

    return moment.map(run)


def fit_and_forecast(
    df: DataFrame,
    folds: DataFrame,
    spec: Spec,
    horizon: int = 24,
    window: int | None = None,
    value: str = "value",
    key: str = KEY,
    time: str = TIME,
    freq: str = "hour",
) -> DataFrame:
    """``key, fold, timestamp, y_pred, status`` for ``horizon`` slots from each fold start.

    ``df`` is a complete, null-free grid; a fold trains on everything before its
    ``start``, or on the last ``window`` slots before it.
    """
    step = SLOT_SECONDS[freq]
    arrays = {"_y": (value, spec.reach)}
    arrays |= {f"_z{i}": (c, spec.reach) for i, c in enumerate(spec.exog)}
    base = df.select(key, time, *[as_column(c).cast("double").alias(c) for c in dict.fromkeys([value, *spec.exog])])
    rows = with_lags(base, {}, [key], time, freq, past=arrays).select(key, time, *arrays)
    for a in arrays:
        rows = rows.where((F.size(a) == spec.reach + 1) & ~F.exists(a, lambda v: v.isNull()))
    # one entry per fold day of a series
    starts = folds.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "fold"))).alias("_folds"))
    placed = rows.join(starts, key)
    t = F.col(time)
    used = F.filter("_folds", lambda f: f.getField("start") > t)
    if window is not None:
        span = F.expr(f"INTERVAL {(window - spec.reach) * step} SECOND")
        used = F.filter(used, lambda f: f.getField("start") <= t + span)
    placed = placed.withColumn("_used", F.transform(used, lambda f: f.getField("fold"))).where(F.size("_used") > 0)
    part = T.StructType([df.schema[key], T.StructField("fold", T.IntegerType())])

    def by_use(pdf: pd.DataFrame) -> Iterable[tuple[object, list[int], pd.DataFrame]]:
        tag = pdf["_used"].map(lambda u: tuple(int(f) for f in u))
        for (name, folds_of), g in pdf.groupby([pdf[key], tag], sort=False):
            yield name, list(folds_of), g

    def first_stage(pdf: pd.DataFrame):
        for name, folds_of, g in by_use(pdf):
            w, z = _block(g, spec)
            x = _first_design(w, z, 0, spec)
            for f in folds_of:
                yield (name, f), x, w[:, 0]

    if spec.ma:
        phis = moments(placed.drop("_folds", time), part, first_stage).select(key, "fold", _fit("moment").alias("_phi"))
        phis = phis.where("_phi IS NOT NULL")
        known = phis.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("fold", "_phi"))).alias("_phis"))
        staged = placed.join(known, key)
    else:
        phis, staged = None, placed.withColumn("_phis", F.lit(None).cast("map<int,array<double>>"))

    def second_stage(pdf: pd.DataFrame):
        for name, folds_of, g in by_use(pdf):
            w, z = _block(g, spec)
            held = g["_phis"].iloc[0]
            held = dict(held) if held is not None else {}
            for f in folds_of:
                if spec.ma and f not in held:
                    continue
                shocks = [_shock(w, z, k, np.asarray(held[f], float), spec) for k in spec.ma]
                yield (name, f), _final_design(w, z, shocks, spec), w[:, 0]

    theta = moments(staged.drop("_folds", time), part, second_stage).select(key, "fold", _fit("moment").alias("_theta"))

    # the row just before a fold holds the whole state of the recursion
    state = rows.withColumn("start", later(time, step)).drop(time).join(folds.select(key, "fold", "start"), [key, "start"])
    fitted = folds.select(key, "fold", "start").join(state.drop("start"), [key, "fold"], "left").join(theta, [key, "fold"], "left")
    if phis is not None:
        fitted = fitted.join(phis, [key, "fold"], "left")
    else:
        fitted = fitted.withColumn("_phi", F.array().cast("array<double>"))
    if spec.exog:
        offset = ((epoch(time) - epoch("start")) / step).cast("int")
        ahead = base.join(folds.select(key, "fold", "start"), key).withColumn("_i", offset)
        ahead = ahead.where((F.col("_i") >= 0) & (F.col("_i") < horizon))
        # `horizon` rows per fold
        future = ahead.groupBy(key, "fold").agg(
            *[
                F.transform(F.array_sort(F.collect_list(F.struct("_i", as_column(c).alias("v")))), lambda p: p.getField("v")).alias(f"_f{i}")
                for i, c in enumerate(spec.exog)
            ]
        )
        fitted = fitted.join(future, [key, "fold"], "left")

    n_exog = len(spec.exog)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def project(*cols: pd.Series) -> pd.Series:
        y, phi, theta_, *zs = cols
        return pd.Series([_project(spec, horizon, y[i], phi[i], theta_[i], [z[i] for z in zs]) for i in range(len(y))])

    extras = [F.col(f"_z{i}") for i in range(n_exog)] + [F.col(f"_f{i}") for i in range(n_exog)]
    out = fitted.withColumn("_path", project("_y", "_phi", "_theta", *extras))
    status = (
        F.when(F.col("_theta").isNull() | F.col("_y").isNull(), F.lit("too_short"))
        .when(F.col("_path").isNull(), F.lit("failed"))
        .otherwise(F.lit("ok"))
    )
    empty = F.array_repeat(F.lit(None).cast("double"), horizon)
    out = out.select(key, "fold", "start", status.alias("status"), F.posexplode(F.coalesce("_path", empty)).alias("_i", "y_pred"))
    moment = (F.col("start") + F.make_dt_interval(secs=(F.col("_i") * step).cast("decimal(18,6)"))).cast("timestamp_ntz")
    return out.select(key, "fold", moment.alias(time), "y_pred", "status")


def _project(spec: Spec, horizon: int, y, phi, theta, exog) -> np.ndarray | None:
    """The recursion from the last row's past; future shocks are zero."""
    if y is None or theta is None or phi is None or any(e is None for e in exog):
        return None
    half = len(exog) // 2
    futures = [np.asarray(f, float) for f in exog[half:]]
    if any(len(f) < horizon for f in futures):
        return None
    level = np.asarray(y, float)
    signals = [np.asarray(z, float) for z in exog[:half]]
    phi, theta = np.asarray(phi, float), np.asarray(theta, float)
    w = _differenced(level[None], spec)
    z = [_differenced(s[None], spec) for s in signals]
    past = max(spec.ma, default=0)
    shocks = [float(_shock(w, z, k, phi, spec)[0]) for k in range(past)]  # newest first
    w = list(w[0])
    level = list(level)
    signals = [list(s) for s in signals]
    c = spec.shifts
    path = []
    for h in range(horizon):
        for s, f in zip(signals, futures):
            s.insert(0, f[h])
        x = [1.0] if spec.constant else []
        x += [float(sum(c[j] * s[j] for j in range(len(c)))) for s in signals]
        x += [w[k - 1] for k in spec.ar] + [shocks[k - 1] for k in spec.ma]
        step = float(np.dot(x, theta))
        value = step - float(sum(c[j] * level[j - 1] for j in range(1, len(c))))
        w.insert(0, step)
        shocks.insert(0, 0.0)
        level.insert(0, value)
        path.append(value)
    out = np.asarray(path)
    return out if np.isfinite(out).all() else None


def walk_forward(
    df: DataFrame,
    folds: DataFrame,
    specs: Sequence[Spec],
    horizon: int = 24,
    window: int | None = None,
    value: str = "value",
    key: str = KEY,
    time: str = TIME,
    freq: str = "hour",
) -> DataFrame:
    """Predictions of several models over the folds: ``key, model_name, fold, timestamp, y_true, y_pred, status``."""
    truth = df.select(key, time, as_column(value).alias("y_true"))
    out = None
    for spec in specs:
        part = fit_and_forecast(df, folds, spec, horizon, window, value, key, time, freq)
        part = part.join(truth, [key, time], "inner").select(
            key, F.lit(spec.name).alias("model_name"), "fold", time, "y_true", "y_pred", "status"
        )
        out = part if out is None else out.unionByName(part)
    return out


def ar1(df: DataFrame, value: str = "value", keys: Sequence[str] = (KEY,), time: str = TIME, freq: str = "hour") -> DataFrame:
    """Slope and intercept of each value on the one before it."""
    rows = with_lags(df, {"_back": (value, 1)}, keys, time, freq).where(as_column(value).isNotNull() & F.col("_back").isNotNull())
    return rows.groupBy(*keys).agg(
        F.regr_slope(as_column(value), F.col("_back")).alias("phi"),
        F.regr_intercept(as_column(value), F.col("_back")).alias("intercept"),
        F.count(F.lit(1)).alias("n"),
    )
