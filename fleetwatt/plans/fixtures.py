"""Tables of the domain, derived from the star-schema test tables.

long     one hourly series per event type, absent hours absent (``L`` in SQL)
fleet    one hourly series per user (``U``)
wide     two houses with six signals on a complete calendar (``W``)
daily    one daily series per order priority (``D``)
predicted  baseline predictions of the last seven days of the filled long table (``P``)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import floor_to, naive
from fleetwatt.operators.baselines import rolling_baselines
from fleetwatt.operators.folds import daily_folds
from fleetwatt.operators.grid import resample
from fleetwatt.operators.impute import forward_fill, interpolate
from fleetwatt.operators.storage import CAPACITY_KWH, dispatch_input, scenario_unpivot, with_capacities
from fleetwatt.session import materialise

WIDE = ["Demand", "pv", "pv_mod1", "Price", "Temperature", "radiation"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def long(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    return e.groupBy(F.col("event_type").alias(KEY), floor_to("hour", "ts").alias(TIME)).agg(F.sum("value").alias("value"))


def long_grid(spark: SparkSession, sf: str) -> DataFrame:
    return resample(long(spark, sf), {"value": ("value", "mean")})


def long_filled(spark: SparkSession, sf: str) -> DataFrame:
    return interpolate(long_grid(spark, sf), ["value"])


def fleet(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    return e.groupBy(F.col("user_id").cast("string").alias(KEY), floor_to("hour", "ts").alias(TIME)).agg(F.sum("value").alias("value"))


def wide(spark: SparkSession, sf: str) -> DataFrame:
    def of(kind: str) -> Column:
        return F.when(F.col("event_type") == kind, F.col("value"))

    e = events(spark, sf).select(
        F.concat(F.lit("house_"), (F.col("user_id") % 2).cast("string")).alias(KEY),
        F.col("ts").alias(TIME),
        (of("purchase") / 100).alias("Demand"),
        (of("view") / 100).alias("pv"),
        (of("click") / 100).alias("pv_mod1"),
        (of("signup") / 1000).alias("Price"),
        of("error").alias("Temperature"),
        F.col("event_id"),
    )
    how = {c: (c, "mean") for c in ["Demand", "pv", "pv_mod1", "Price", "Temperature"]}
    grid = resample(e, how | {"radiation": ("event_id", "count")})
    return grid.withColumns(
        {
            "Temperature": F.col("Temperature") - 30,
            "radiation": F.when(F.col("radiation") > 0, F.col("radiation") * 10.0),
        }
    )


def wide_filled(spark: SparkSession, sf: str) -> DataFrame:
    return forward_fill(wide(spark, sf), WIDE, then_back=True)


def daily(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.groupBy(F.col("o_orderpriority").alias(KEY), naive("o_orderdate").alias(TIME)).agg(F.sum("o_totalprice").alias("value"))


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    rows = materialise(long_filled(spark, sf))
    return rolling_baselines(rows, materialise(daily_folds(rows)), members=["naive_24h", "naive_7d"])


def storage_days(spark: SparkSession, sf: str) -> DataFrame:
    rows = wide_filled(spark, sf)
    rows = rows.withColumns({"pv_low": F.col("pv") * 0.3, "pv_high": F.col("pv")})
    return scenario_unpivot(dispatch_input(rows))


def timer_schedule(spark: SparkSession, sf: str) -> DataFrame:
    """A fixed battery timetable on the storage days: charge 0.5 kW before six,
    give the energy back from 17 to 22 o'clock."""
    h = F.col("hour")
    rows = with_capacities(storage_days(spark, sf), [CAPACITY_KWH])
    rows = rows.withColumn("charge", F.when(h < 6, 0.5).otherwise(0.0)).withColumn(
        "discharge", F.when(h.between(17, 22), 0.45125).otherwise(0.0)
    )
    # the timetable fixes the stored energy of every hour
    stored = 5.0 + 0.475 * F.least(h, F.lit(6)) - 0.475 * F.least(F.greatest(h - 17, F.lit(0)), F.lit(6))
    net = F.col("demand") - F.col("pv") + F.col("charge") - F.col("discharge")
    return rows.withColumns(
        {
            "grid_import": F.greatest(net, F.lit(0.0)),
            "grid_export": F.greatest(-net, F.lit(0.0)),
            "soc": stored,
            "soc_end": F.lit(5.0),
        }
    )


def components(spark: SparkSession, sf: str) -> DataFrame:
    """A simple additive split of the filled long table: day mean, hour-of-day offset, rest."""
    rows = long_filled(spark, sf).withColumns({"_day": F.date_trunc("day", TIME), "_hour": F.hour(TIME)})
    trend = rows.groupBy(KEY, "_day").agg(F.avg("value").alias("trend"))
    rows = rows.join(trend, [KEY, "_day"]).withColumn("_left", F.col("value") - F.col("trend"))
    seasonal = rows.groupBy(KEY, "_hour").agg(F.avg("_left").alias("seasonal"))
    rows = rows.join(seasonal, [KEY, "_hour"])
    return rows.select(KEY, TIME, "value", "trend", "seasonal", (F.col("_left") - F.col("seasonal")).alias("resid"))
