"""Battery schedules for many sites and days, and their reports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import as_column
from fleetwatt.operators import battery
from fleetwatt.operators.features import tariffs
from fleetwatt.operators.grid import with_day

# Battery and connection limits of the reference case.
CAPACITY_KWH = 10.0
POWER_KW = 5.0
EFFICIENCY = 0.95
START_SHARE = 0.5
END_SHARE = 0.2
SCENARIOS = {"PV_low": "pv_low", "PV_high": "pv_high"}
CAPACITIES = (5.0, 10.0, 15.0)
#: Problems planned at a time; their pieces are about 50 kB each.
DAYS = 512

PROBLEM = [KEY, "day", "scenario", "capacity_kwh"]


@dataclass(frozen=True)
class Battery:
    power: float = POWER_KW
    grid: float = POWER_KW
    efficiency: float = EFFICIENCY
    start: float = START_SHARE
    end: float = END_SHARE


def scenario_unpivot(df: DataFrame, scenarios: dict[str, str] = SCENARIOS) -> DataFrame:
    """One row per scenario with its generation as ``pv``."""
    ids = [c for c in df.columns if c not in scenarios.values()]
    long = df.select(*[as_column(c) for c in ids], *[as_column(c).alias(n) for n, c in scenarios.items()])
    return long.unpivot(ids, list(scenarios), "scenario", "pv")


def dispatch_input(
    df: DataFrame, demand: str = "Demand", price: str = "Price", time: str = TIME, keys: Sequence[str] = (KEY,)
) -> DataFrame:
    """``keys, day, hour, demand, pv_low, pv_high, price_buy, price_sell``, 24 hours of every day.

    An hour without a row, or a signal without a value, stays as nulls; ``dispatch`` then
    gives the day the status ``missing_input``.
    """
    rows = with_day(tariffs(df, price), time).select(
        *keys,
        "day",
        F.hour(time).alias("hour"),
        as_column(demand).alias("demand"),
        "pv_low",
        "pv_high",
        "price_buy",
        "price_sell",
    )
    signals = ["demand", "pv_low", "pv_high", "price_buy", "price_sell"]
    hour = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    # the empty hours join the readings before the sums, so a day costs one shuffle
    empty = rows.select(*keys, "day").distinct().select(*keys, "day", hour, *[F.lit(None).cast("double").alias(s) for s in signals])
    both = rows.unionByName(empty.select(*rows.columns))
    return both.groupBy(*keys, "day", "hour").agg(*[F.max(s).alias(s) for s in signals])


def with_capacities(df: DataFrame, capacities: Sequence[float] = (CAPACITY_KWH,)) -> DataFrame:
    return df.withColumn("capacity_kwh", F.explode(F.array(*[F.lit(float(c)) for c in capacities])))


def plan_day(
    demand: np.ndarray, pv: np.ndarray, buy: np.ndarray, sell: np.ndarray, capacity: float, b: Battery = Battery()
) -> dict | None:
    """The cheapest schedule of one day, or None if no schedule meets the limits."""
    one = [np.asarray(x, float)[None, :] for x in (demand - pv, buy, sell)]
    found, feasible = battery.plan(*one, np.array([float(capacity)]), b.power, b.grid, b.efficiency, b.start, b.end)
    return {k: v[0] for k, v in found.items()} if feasible[0] else None


def dispatch(df: DataFrame, limits: Battery = Battery(), problem: Sequence[str] = tuple(PROBLEM)) -> DataFrame:
    """One row per problem and hour with the optimal flows, ``soc`` before the hour,
    ``energy_value`` (the cost of a further kWh stored after it), ``soc_end`` after the day,
    the cost of the day and a ``status``.

    Input: ``problem..., hour, demand, pv, price_buy, price_sell``.  Prices may have any
    sign and order.  A problem with an unknown signal is ``missing_input``, one whose
    limits cannot be met ``infeasible``; their rows stay, with null flows.  The 24 rows of
    a problem become one row of arrays, and tasks plan ``DAYS`` problems at a time.
    """
    problem = list(problem)
    signals = ["demand", "pv", "price_buy", "price_sell"]
    hours = F.array_sort(F.collect_list(F.struct("hour", *[as_column(s).cast("double").alias(s) for s in signals])))
    days = df.groupBy(*problem).agg(hours.alias("_h"))
    # a field of an array of structs is the array of that field
    arrays = days.select(*problem, *[F.col("_h").getField(s).alias(s) for s in ["hour", *signals]])
    flows = ["grid_import", "grid_export", "charge", "discharge", "energy_value", "soc"]
    lists = [T.StructField(n, T.ArrayType(T.DoubleType())) for n in flows]
    schema = T.StructType(
        [
            *arrays.schema.fields,
            *lists,
            T.StructField("soc_end", T.DoubleType()),
            T.StructField("cost", T.DoubleType()),
            T.StructField("status", T.StringType()),
        ]
    )

    def solved(pdf: pd.DataFrame) -> pd.DataFrame:
        """Problems of one number of hours."""
        demand, pv, buy, sell = (np.array(pdf[s].tolist(), float).reshape(len(pdf), -1) for s in signals)
        capacity = pdf["capacity_kwh"].to_numpy(float)
        known = ~np.isnan(demand + pv + buy + sell).any(axis=1) & ~np.isnan(capacity)
        out = {n: np.full(demand.shape, np.nan) for n in flows}
        soc_end, cost = np.full(len(pdf), np.nan), np.full(len(pdf), np.nan)
        status = np.where(known, "infeasible", "missing_input").astype(object)
        for at in np.array_split(np.flatnonzero(known), max(1, -(-int(known.sum()) // DAYS))):
            b = limits
            found, ok = battery.plan(demand[at] - pv[at], buy[at], sell[at], capacity[at], b.power, b.grid, b.efficiency, b.start, b.end)
            done = at[ok]
            for n in flows:
                out[n][done] = found[n][ok, : demand.shape[1]]
            soc_end[done], cost[done], status[done] = found["soc"][ok, -1], found["cost"][ok], "optimal"
        return pdf.assign(**{n: list(v) for n, v in out.items()}, soc_end=soc_end, cost=cost, status=status)

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, same in pdf.groupby(pdf["demand"].map(len)):
                yield solved(same)[schema.names]

    planned = arrays.mapInPandas(plan, schema)
    rows = planned.select(
        *problem,
        "status",
        F.nanvl("cost", F.lit(None).cast("double")).alias("cost"),
        F.nanvl("soc_end", F.lit(None).cast("double")).alias("soc_end"),
        F.explode(F.arrays_zip("hour", *signals, *flows)).alias("_r"),
    )
    known = [F.nanvl(F.col(f"_r.{n}"), F.lit(None).cast("double")).alias(n) for n in [*signals, *flows]]
    return rows.select(*problem, F.col("_r.hour").alias("hour"), *known, "soc_end", "cost", "status")


def dual_bound(schedule: DataFrame, limits: Battery = Battery(), by: Sequence[str] = tuple(PROBLEM)) -> DataFrame:
    """``cost`` of each optimal problem beside ``bound``, which no schedule can undercut.

    The bound is the dual function of the linear program at the values of stored energy:
    each hour on its own takes the cheapest corner of its flows, energy kept included.
    It holds for any values, so it judges the schedule whatever made it.
    """
    p, g, eff = limits.power, limits.grid, limits.efficiency
    rows = schedule.where("status = 'optimal'")
    net = F.col("demand") - F.col("pv")
    edges = []  # corners (charge, discharge) of the square, and where the grid draw is a limit or zero on its edges
    for x in (0.0, p):
        edges += [(F.lit(x), F.lit(y)) for y in (0.0, p)]
        edges += [pair for level in (-g, 0.0, g) for pair in ((F.lit(x), net + x - level), (level - net + x, F.lit(x)))]
    corner = F.explode(F.array(*[F.struct(c.alias("c"), d.alias("d")) for c, d in edges]))
    w = Window.partitionBy(*by).orderBy("hour")
    cap, value = F.col("capacity_kwh"), F.col("energy_value")
    lagged = rows.withColumns({"_before": F.lag("energy_value").over(w), "_last": F.lead("energy_value").over(w).isNull()})
    inner = F.least(F.lit(0.0), (value - F.col("_before")) * cap)
    stored = F.when(F.col("_before").isNull(), value * limits.start * cap).otherwise(inner)
    stored = stored + F.when(F.col("_last"), F.least(-value * limits.end * cap, -value * cap)).otherwise(0.0)
    each = lagged.select(*by, "hour", "cost", value, "price_buy", "price_sell", net.alias("_net"), stored.alias("_stored"), corner.alias("_x"))
    draw = F.col("_net") + F.col("_x.c") - F.col("_x.d")
    near = 1e-9
    fits = (F.least("_x.c", "_x.d") >= -near) & (F.greatest("_x.c", "_x.d") <= p + near) & (F.abs(draw) <= g + near)
    both = F.greatest(F.col("price_sell") - F.col("price_buy"), F.lit(0.0)) * g
    paid = F.when(draw > 0, F.greatest("price_buy", "price_sell") * draw).otherwise(F.least("price_buy", "price_sell") * draw) - both
    least = F.min(F.when(fits, paid + value * (eff * F.col("_x.c") - F.col("_x.d") / eff)))
    hourly = each.groupBy(*by, "hour").agg(least.alias("_least"), F.first("_stored").alias("_stored"), F.first("cost").alias("cost"))
    return hourly.groupBy(*by).agg(F.first("cost").alias("cost"), F.sum(F.col("_least") + F.col("_stored")).alias("bound"))


def capacity_sweep(df: DataFrame, capacities: Sequence[float] = CAPACITIES, limits: Battery = Battery()) -> DataFrame:
    """Total cost per site, scenario and capacity."""
    planned = dispatch(with_capacities(df.drop("capacity_kwh"), capacities), limits)
    daily = planned.where("hour = 0")
    return daily.groupBy(KEY, "scenario", "capacity_kwh").agg(
        F.sum("cost").alias("total_cost"), F.count("cost").alias("days"), F.count_if(F.col("status") != "optimal").alias("unsolved")
    )


def dispatch_kpis(schedule: DataFrame, by: Sequence[str] = tuple(PROBLEM)) -> DataFrame:
    """Cost, energy sums, self-consumption, cycles and the range of stored energy.

    The energy after the last hour counts as well.
    """
    pv, sold = F.sum("pv"), F.sum("grid_export")
    return schedule.groupBy(*by).agg(
        F.sum(F.col("price_buy") * F.col("grid_import") - F.col("price_sell") * F.col("grid_export")).alias("total_cost"),
        pv.alias("pv_generation"),
        F.sum("grid_import").alias("grid_import"),
        sold.alias("grid_export"),
        (pv - sold).alias("self_consumption"),
        (F.try_divide(pv - sold, pv) * 100).alias("self_consumption_pct"),
        (F.sum("discharge") / F.max("capacity_kwh")).alias("battery_cycles"),
        F.greatest(F.max("soc"), F.max("soc_end")).alias("soc_max"),
        F.least(F.min("soc"), F.min("soc_end")).alias("soc_min"),
    )


def dispatch_wide(
    schedule: DataFrame, scenarios: Sequence[str], by: Sequence[str] = (KEY, "day", "hour"), digits: int = 3, price_digits: int = 4
) -> DataFrame:
    """Hours against scenarios, rounded for print."""

    def of(s: str, c: str) -> Column:
        return F.round(F.max(F.when(F.col("scenario") == s, F.col(c))), digits)

    flows = [("pv", "pv"), ("grid_import", "import"), ("grid_export", "export"), ("charge", "charge"), ("discharge", "discharge"), ("soc", "soc")]
    return schedule.groupBy(*by).agg(
        F.round(F.max("demand"), digits).alias("demand"),
        F.round(F.max("price_buy"), price_digits).alias("price"),
        *[of(s, c).alias(f"{n}_{s.lower()}") for s in scenarios for c, n in flows],
    )


def scenario_savings(kpis: DataFrame, base: str, other: str, by: Sequence[str] = (KEY,)) -> DataFrame:
    """Cost difference and, where the base cost is positive, its percentage."""
    a = F.sum(F.when(F.col("scenario") == base, F.col("total_cost")))
    b = F.sum(F.when(F.col("scenario") == other, F.col("total_cost")))
    return kpis.groupBy(*by).agg(
        a.alias("base_cost"),
        b.alias("other_cost"),
        (a - b).alias("saving"),
        F.when(a > 0, (a - b) / a * 100).alias("saving_pct"),
    )


def dispatch_validate(schedule: DataFrame, limits: Battery = Battery(), by: Sequence[str] = tuple(PROBLEM)) -> DataFrame:
    """Largest violations per problem: balance, energy steps, limits, start and end."""
    w = Window.partitionBy(*by).orderBy("hour")
    eff = limits.efficiency
    rows = schedule.withColumn("_after", F.coalesce(F.lead("soc").over(w), F.col("soc_end")))
    balance = F.col("pv") + F.col("grid_import") + F.col("discharge") - F.col("demand") - F.col("grid_export") - F.col("charge")
    step = F.col("_after") - F.col("soc") - eff * F.col("charge") + F.col("discharge") / eff
    power = F.greatest("charge", "discharge", "grid_import", "grid_export")
    low = F.least("charge", "discharge", "grid_import", "grid_export")
    zero = F.lit(0.0)
    return rows.groupBy(*by).agg(
        F.max(F.abs(balance)).alias("balance_gap"),
        F.max(F.abs(step)).alias("step_gap"),
        F.max(F.greatest(power - limits.power, -low, zero)).alias("power_excess"),
        F.max(F.greatest(F.greatest("soc", "_after") - F.col("capacity_kwh"), -F.least("soc", "_after"), zero)).alias("energy_excess"),
        F.max(F.when(F.col("hour") == 0, F.abs(F.col("soc") - limits.start * F.col("capacity_kwh")))).alias("start_gap"),
        F.max(F.greatest(limits.end * F.col("capacity_kwh") - F.col("soc_end"), zero)).alias("end_gap"),
    )
