"""Forecasts that need no fit.  Output: ``keys, model_name, fold, timestamp, y_true, y_pred``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import SLOT_SECONDS, as_column, epoch, later
from fleetwatt.functions.ordered import BEFORE
from fleetwatt.operators.folds import fold_rows
from fleetwatt.operators.grid import with_day


def _pred(df: DataFrame, name: str, y_pred: Column, value: str, keys: Sequence[str], time: str) -> DataFrame:
    return df.select(
        *keys, F.lit(name).alias("model_name"), "fold", F.col(time), as_column(value).alias("y_true"), y_pred.alias("y_pred")
    )


def _known_before(df: DataFrame, folds: DataFrame, n: int, value: str, keys: Sequence[str], time: str) -> DataFrame:
    """The last ``n`` known rows before each fold, numbered back from it (``_back`` = 1 is newest).

    Daily counts tell from which day on they can lie, so only the last rows of a series
    are paired with its folds.
    """
    known = with_day(df.where(as_column(value).isNotNull()).select(*keys, time, as_column(value).alias("_v")), time)
    first = folds.groupBy(*keys).agg(F.min("start").alias("_first"))
    per_day = known.groupBy(*keys, "day").agg(F.count(F.lit(1)).alias("_rows")).join(first, list(keys)).where("day < _first")
    nearer = F.sum("_rows").over(Window.partitionBy(*keys).orderBy(F.col("day").desc()).rowsBetween(*BEFORE))
    reach = per_day.withColumn("_nearer", F.coalesce(nearer, F.lit(0))).where(F.col("_nearer") < n)
    reach = reach.groupBy(*keys).agg(F.min("day").alias("_from"))
    begin = first.join(reach, list(keys), "left").select(*keys, F.coalesce("_from", "_first").alias("_from"))
    pool = known.join(begin, list(keys)).where("day >= _from")
    paired = pool.join(folds.select(*keys, "fold", "start"), list(keys)).where(F.col(time) < F.col("start"))
    back = F.row_number().over(Window.partitionBy(*keys, "fold").orderBy(F.col(time).desc()))
    return paired.withColumn("_back", back).where(F.col("_back") <= n).select(*keys, "fold", "start", "_back", "_v")


def naive_flat(df: DataFrame, folds: DataFrame, value: str = "value", keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """The last known value before the day, all day long; no rows without one."""
    per_day = (
        with_day(df.where(as_column(value).isNotNull()), time).groupBy(*keys, "day").agg(F.max_by(as_column(value), time).alias("_v"))
    )
    days = per_day.select(*keys, "day", "_v").unionByName(
        folds.select(*keys, F.col("start").alias("day"), F.lit(None).cast("double").alias("_v"))
    )
    days = days.groupBy(*keys, "day").agg(F.max("_v").alias("_v"))
    before = Window.partitionBy(*keys).orderBy("day").rowsBetween(*BEFORE)
    last = days.withColumn("_last", F.last("_v", ignorenulls=True).over(before)).select(*keys, F.col("day").alias("start"), "_last")
    flat = folds.join(last, [*keys, "start"]).where("_last IS NOT NULL").select(*keys, "fold", "_last")
    rows = fold_rows(df, folds, keys, time).join(flat, [*keys, "fold"])
    return _pred(rows, "naive_flat", F.col("_last"), value, keys, time)


def naive_tile(
    df: DataFrame, folds: DataFrame, season: int = 24, value: str = "value", keys: Sequence[str] = (KEY,), time: str = TIME, freq: str = "hour"
) -> DataFrame:
    """The last ``season`` known values before the day, repeated over the horizon."""
    known = _known_before(df, folds, season, value, keys, time)
    sizes = known.groupBy(*keys, "fold").agg(F.max("_back").alias("_n"))
    known = known.join(sizes, [*keys, "fold"]).select(
        *keys, "fold", (F.col("_n") - F.col("_back")).cast("long").alias("_at"), "_v", "_n"
    )
    rows = fold_rows(df, folds, keys, time).join(folds.select(*keys, "fold", "start"), [*keys, "fold"]).join(sizes, [*keys, "fold"])
    step = ((epoch(time) - epoch("start")) / SLOT_SECONDS[freq]).cast("long")
    rows = rows.withColumn("_at", step % F.col("_n")).drop("_n")
    return _pred(rows.join(known.drop("_n"), [*keys, "fold", "_at"]), "naive_tile", F.col("_v"), value, keys, time)


def _shifted(
    df: DataFrame, folds: DataFrame, seconds: int, name: str, value: str, keys: Sequence[str], time: str
) -> DataFrame:
    """History moved forward, so that an equi-join on time reads the past; only what
    the folds can reach."""
    reach = folds.groupBy(*keys).agg(F.min(later("start", -seconds)).alias("_from"))
    recent = df.join(reach, list(keys), "inner").where(F.col(time) >= F.col("_from"))
    return recent.select(*keys, later(time, seconds).alias(time), as_column(value).alias(name), F.lit(True).alias(f"{name}_found"))


def naive_24h(df: DataFrame, folds: DataFrame, value: str = "value", keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """The value 24 hours earlier; where that row is absent, the row at the same place
    in the last 24 rows before the day."""
    rows = fold_rows(df, folds, keys, time).join(_shifted(df, folds, 86400, "_day", value, keys, time), [*keys, time], "left")
    with_row = df.withColumn("_row", F.struct(as_column(value).alias("v")))
    place = _known_before(with_row.select(*keys, time, "_row"), folds, 24, "_row", keys, time)
    place = place.select(*keys, "fold", F.col("_back").alias("_at"), F.col("_v.v").alias("_place"))
    rows = rows.withColumn("_at", F.lit(24) - F.hour(time)).join(place, [*keys, "fold", "_at"], "left")
    y = F.when(F.col("_day_found"), F.col("_day")).otherwise(F.col("_place"))
    return _pred(rows, "naive_24h", y, value, keys, time)


def naive_7d(df: DataFrame, folds: DataFrame, value: str = "value", keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """The value 7 days earlier, else 24 hours earlier, else the last row before the day."""
    rows = fold_rows(df, folds, keys, time)
    rows = rows.join(_shifted(df, folds, 7 * 86400, "_week", value, keys, time), [*keys, time], "left")
    rows = rows.join(_shifted(df, folds, 86400, "_day", value, keys, time), [*keys, time], "left")
    with_row = df.withColumn("_row", F.struct(as_column(value).alias("v")))
    last = _known_before(with_row.select(*keys, time, "_row"), folds, 1, "_row", keys, time)
    rows = rows.join(last.select(*keys, "fold", F.col("_v.v").alias("_last")), [*keys, "fold"], "left")
    y = (
        F.when(F.col("_week_found"), F.col("_week"))
        .when(F.col("_day_found"), F.col("_day"))
        .otherwise(F.col("_last"))
    )
    return _pred(rows, "naive_7d", y, value, keys, time)


def rolling_baselines(
    df: DataFrame,
    folds: DataFrame,
    value: str = "value",
    skip_first: bool = False,
    members: Sequence[str] = ("naive_flat", "naive_tile"),
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
) -> DataFrame:
    """Several baselines over the fold days; ``skip_first`` leaves out the oldest day."""
    used = folds.where(F.col("fold") >= 2) if skip_first else folds
    build = {"naive_flat": naive_flat, "naive_tile": naive_tile, "naive_24h": naive_24h, "naive_7d": naive_7d}
    out = None
    for m in members:
        part = build[m](df, used, value=value, keys=keys, time=time)
        out = part if out is None else out.unionByName(part)
    return out
