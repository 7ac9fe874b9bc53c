"""Complete calendars: one row per series and slot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import SLICE_OF, as_column, every, floor_to, naive, slots


def span(df: DataFrame, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(time).alias("first"), F.max(time).alias("last"))


def resample(
    df: DataFrame,
    how: dict[str, tuple[str, str]],
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
    freq: str = "hour",
) -> DataFrame:
    """Every slot between the first and last row of a series, aggregated.

    ``how`` maps a new column to ``(column, "mean" | "sum" | "max" | "min" | "count")``.
    An empty slot gives a null mean and a zero sum.  The readings are aggregated first
    (partially before the shuffle); then each slice of a series, a row with its known slots
    as an array, gets the slots that it lacks and is unfolded.  So no task holds or
    shuffles the calendar, however long or many the series are.
    """
    cols = sorted({c for c, _ in how.values()})
    cells = df.select(*keys, floor_to(freq, time).alias(time), *[as_column(c) for c in cols])
    fold = {
        "mean": F.avg,
        "sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0)),
        "max": F.max,
        "min": F.min,
        "count": F.count,
    }
    known = cells.groupBy(*keys, time).agg(*[fold[f](as_column(c)).alias(name) for name, (c, f) in how.items()])
    unit = SLICE_OF[freq]
    slot = F.struct(as_column(time), *[as_column(name) for name in how])
    held = known.select(*keys, floor_to(unit, time).alias("_slice"), slot.alias("_slot"))
    # one row per series and slice, also where all slots are empty
    slices = span(cells, keys, time).select(
        *keys, "first", "last", F.explode(slots(floor_to(unit, "first"), floor_to(unit, "last"), unit)).alias("_slice")
    )
    each = held.unionByName(slices, allowMissingColumns=True).groupBy(*keys, "_slice")
    each = each.agg(F.collect_list("_slot").alias("_known"), F.max("first").alias("first"), F.max("last").alias("last"))
    ends = F.col("_slice") + every(unit) - every(freq)
    calendar = slots(F.greatest("first", "_slice"), F.least("last", ends), freq)
    lacking = F.array_except(calendar, F.transform("_known", lambda s: s[time]))
    empty = [F.lit({"sum": 0.0, "count": 0}.get(f)).cast(known.schema[name].dataType).alias(name) for name, (_, f) in how.items()]
    added = F.transform(lacking, lambda t: F.struct(t.alias(time), *empty))
    # rows without a moment have no calendar
    return each.select(*keys, F.inline(F.concat("_known", F.coalesce(added, F.slice("_known", 1, 0)))))


def daily_mean(df: DataFrame, value: str = "value", keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    return resample(df, {value: (value, "mean")}, keys, time, "day")


def with_day(df: DataFrame, time: str = TIME) -> DataFrame:
    return df.withColumn("day", naive(F.date_trunc("day", F.col(time))))
