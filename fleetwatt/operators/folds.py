"""Train and test ranges in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import naive
from fleetwatt.operators.grid import with_day
from fleetwatt.session import materialise


def with_end(df: DataFrame, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """Add the newest moment of the series; the written table tells the planner its size."""
    ends = materialise(df.groupBy(*keys).agg(F.max(time).alias("_end")))
    return df.join(ends, list(keys), "inner")


def holdout_split(
    df: DataFrame, days: int = 7, validate_hours: int = 24, keys: Sequence[str] = (KEY,), time: str = TIME
) -> DataFrame:
    """Add ``split`` (train before newest − days, else test) and ``in_validation``,
    the first hours after the cutoff."""
    cut = F.col("_end") - F.expr(f"INTERVAL {int(days)} DAY")
    stop = cut + F.expr(f"INTERVAL {int(validate_hours)} HOUR")
    t = F.col(time)
    return (
        with_end(df, keys, time)
        .withColumn("split", F.when(t < cut, F.lit("train")).otherwise(F.lit("test")))
        .withColumn("in_validation", (t >= cut) & (t < stop))
        .drop("_end")
    )


def daily_folds(df: DataFrame, days: int = 7, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """``keys, fold, start, end``: the newest calendar days with rows, 00:00 to 23:00.

    The window runs over the days of a series, not over its rows.
    """
    per_day = with_day(df.select(*keys, time), time).groupBy(*keys, "day").agg(F.count(F.lit(1)).alias("_rows"))
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("day").desc()))
    newest = per_day.withColumn("_back", back).where(F.col("_back") <= days)
    held = F.max("_back").over(Window.partitionBy(*keys))
    return newest.select(
        *keys,
        (held - F.col("_back") + 1).cast("int").alias("fold"),
        F.col("day").alias("start"),
        naive(F.col("day") + F.expr("INTERVAL 23 HOUR")).alias("end"),
    )


def fold_rows(df: DataFrame, folds: DataFrame, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """Test rows with their fold: an equi-join on series and day."""
    return (
        with_day(df, time)
        .join(folds.select(*keys, "fold", F.col("start").alias("day")), [*keys, "day"], "inner")
        .drop("day")
    )


def last_day(df: DataFrame, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    return (
        with_end(df, keys, time)
        .where(F.col(time) >= naive(F.date_trunc("day", F.col("_end"))))
        .drop("_end")
    )


def history_context(
    history: DataFrame, pred: DataFrame, days: int = 3, keys: Sequence[str] = (KEY,), time: str = TIME
) -> DataFrame:
    """The days before the first forecast of a series, up to the hour before it."""
    first = pred.groupBy(*keys).agg(F.min(time).alias("_first"))
    t = F.col(time)
    return (
        history.join(first, list(keys), "inner")
        .where((t >= F.col("_first") - F.expr(f"INTERVAL {int(days)} DAY")) & (t < F.col("_first")))
        .drop("_first")
    )


def train_range(df: DataFrame, folds: DataFrame, value: str, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """``keys, fold, train_min, train_max`` over everything before each fold.

    Rows shrink to one per series and day before they meet the folds.
    """
    v: Column = F.col(value)
    per_day = with_day(df, time).groupBy(*keys, "day").agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    return (
        per_day.join(folds, list(keys))
        .where(F.col("day") < F.col("start"))
        .groupBy(*keys, "fold")
        .agg(F.min("_lo").alias("train_min"), F.max("_hi").alias("train_max"))
    )
