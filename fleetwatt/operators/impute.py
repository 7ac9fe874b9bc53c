"""Filling gaps along a series and from similar hours."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import as_column, epoch
from fleetwatt.functions.ordered import with_neighbours
from fleetwatt.session import materialise


@dataclass(frozen=True)
class Fill:
    """How one column is filled.

    ``how`` is ``"time"`` or ``"position"`` for linear interpolation, ``"forward"`` for the
    last known value.  ``back`` also uses the next known value where there is no last one.
    ``limit`` is the number of rows a known value may reach.
    """

    how: str = "time"
    back: bool = True
    limit: int | None = None


def _filled(i: int, c: str, rule: Fill, time: str) -> Column:
    p, n, here = F.col(f"_prev_{i}"), F.col(f"_next_{i}"), F.col("_pos")
    behind, ahead = here - p.getField("pos"), n.getField("pos") - here
    before, after = p.getField("value"), n.getField("value")
    if rule.how == "forward":
        kept = before if rule.limit is None else F.when(behind <= rule.limit, before)
        return F.coalesce(kept, after) if rule.back else kept
    if rule.how == "time":
        x, x0, x1 = epoch(time), epoch(p.getField("at")), epoch(n.getField("at"))
    else:
        x, x0, x1 = (e.cast("double") for e in (here, p.getField("pos"), n.getField("pos")))
    value = (
        F.when(as_column(c).isNotNull(), as_column(c))
        .when(p.isNull(), after if rule.back else F.lit(None).cast("double"))
        .when(n.isNull(), before)
        .when(x1 > x0, before + (after - before) * ((x - x0) / (x1 - x0)))
        .otherwise(after)  # known readings of the same moment on both sides
    )
    if rule.limit is None:
        return value
    return F.when((F.least(behind, ahead) if rule.back else behind) <= rule.limit, value)


def fill(
    df: DataFrame,
    rules: dict[str, Fill],
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
    unit: str = "month",
    order: Sequence[str] = (),
) -> DataFrame:
    """Fill several columns, each by its own rule, from one look at the neighbours."""
    rows = with_neighbours(df, list(rules), keys, time, unit, order)
    filled = {c: _filled(i, c, rule, time) for i, (c, rule) in enumerate(rules.items())}
    return rows.select(*[filled[c].alias(c) if c in filled else as_column(c) for c in df.columns])


def interpolate(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (KEY,), time: str = TIME, by: str = "time", both: bool = True, limit: int | None = None, **kw
) -> DataFrame:
    """Linear interpolation in time or row position (``by``).

    With ``both`` leading gaps take the first known value, otherwise they stay null.
    With ``limit`` a gap row is filled only if a known row lies within that many
    rows on either side.
    """
    return fill(df, {c: Fill(by, both, limit) for c in cols}, keys, time, **kw)


def forward_fill(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (KEY,), time: str = TIME, limit: int | None = None, then_back: bool = False, **kw
) -> DataFrame:
    """Last known value, over at most ``limit`` rows; optionally the next one after that."""
    return fill(df, {c: Fill("forward", then_back, limit) for c in cols}, keys, time, **kw)


def _knn_block(target: str, covariates: Sequence[str], time: str, k: int):
    """Vote for the gaps of one block; a block has one row per day at most."""
    scale = float(len(covariates) + 1)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(time, ignore_index=True)
        known = pdf[target].notna().to_numpy()
        x = pdf[list(covariates)].to_numpy(float)
        donors, values = x[known], pdf[target].to_numpy(float)[known]
        votes = np.full(int((~known).sum()), np.nan)
        for row, gap in enumerate(x[~known]):
            diff = donors - gap
            present = (~np.isnan(diff)).sum(axis=1)
            usable = np.flatnonzero(present)
            if not len(usable):
                continue
            total = np.zeros(len(usable))
            for j in range(diff.shape[1]):
                d = diff[usable, j]
                total = total + np.where(np.isnan(d), 0.0, d * d)
            dist = np.sqrt(scale / present[usable] * total)
            near = np.argsort(dist, kind="stable")[:k]
            d, v = dist[near], values[usable[near]]
            votes[row] = v[d == 0].mean() if (d == 0).any() else np.average(v, weights=1 / d)
        out = pdf.loc[~known, [c for c in pdf.columns if c not in (target, *covariates)]].copy()
        out["_vote"] = votes
        return out

    return run


def knn_impute(
    df: DataFrame,
    target: str,
    covariates: Sequence[str],
    block: str = "hour",
    k: int = 5,
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
) -> DataFrame:
    """Distance-weighted mean of the ``k`` nearest donors at the same hour of day.

    On an hourly grid the rows of one series and hour number one per day, which
    bounds the group a task holds; the distances stay inside the task and only the
    votes leave it.  The distance skips missing covariates and scales up for them.
    A donor at distance zero settles the value alone.  Without any usable donor the
    gap takes the mean of its series.
    """
    if block not in ("hour", "minute"):
        raise ValueError("block must keep one row per day: 'hour' or 'minute'")
    part = F.hour(time) if block == "hour" else F.date_format(time, "HHmm").cast("int")
    rows = df.select(*keys, time, as_column(target).cast("double").alias(target), *[as_column(c).cast("double").alias(c) for c in covariates])
    kept = T.StructType([rows.schema[c] for c in [*keys, time]])
    schema = kept.add("_block", T.IntegerType()).add("_vote", T.DoubleType())
    voted = (
        rows.withColumn("_block", part)
        .groupBy(*keys, "_block")
        .applyInPandas(lambda pdf: _knn_block(target, covariates, time, k)(pdf)[schema.names], schema)
        .select(*keys, time, F.nanvl("_vote", F.lit(None).cast("double")).alias("_vote"))
    )
    means = materialise(df.groupBy(*keys).agg(F.avg(as_column(target)).alias("_mean")))
    return (
        df.join(voted, [*keys, time], "left")
        .join(means, list(keys), "left")
        .select(
            *[
                F.coalesce(as_column(c), F.col("_vote"), F.col("_mean")).alias(c) if c == target else as_column(c)
                for c in df.columns
            ]
        )
    )


def imputation_summary(df: DataFrame, methods: Sequence[str]) -> DataFrame:
    """Mean, std, min, max and missing share per method column."""
    long = df.unpivot([], list(methods), "method", "value")
    return long.groupBy("method").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        (F.avg(F.col("value").isNull().cast("int")) * 100).alias("missing_pct"),
    )


def imputation_profile(df: DataFrame, before: str, after: str, time: str = TIME) -> DataFrame:
    return df.groupBy(F.hour(time).alias("hour")).agg(
        F.avg(as_column(before)).alias("before"), F.avg(as_column(after)).alias("after")
    )
