"""Battery schedules and their reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetwatt import KEY
from fleetwatt.operators import storage
from fleetwatt.plans import fixtures as fx
from fleetwatt.plans.registry import query
from fleetwatt.plans.sqltext import r, sql
from fleetwatt.session import materialise

_PROBLEM = "series_id, day, scenario, capacity_kwh"


@query(
    "scenario_unpivot",
    sql(
        f"""select series_id, day, hour, {r('demand')} as demand, {r('price_buy')} as price_buy, {r('price_sell')} as price_sell, scenario, {r('pv')} as pv from S"""
    ),
)
def scenario_unpivot(spark, sf):
    return fx.storage_days(spark, sf)


_KPI = f"""{r('sum(price_buy * grid_import - price_sell * grid_export)')} as total_cost, {r('sum(pv)')} as pv_generation, {r('sum(grid_import)')} as grid_import,
    {r('sum(grid_export)')} as grid_export, {r('sum(pv) - sum(grid_export)')} as self_consumption, {r('(sum(pv) - sum(grid_export)) / nullif(sum(pv), 0) * 100')} as self_consumption_pct,
    {r('sum(discharge) / max(capacity_kwh)')} as battery_cycles, {r('greatest(max(soc), max(soc_end))')} as soc_max, {r('least(min(soc), min(soc_end))')} as soc_min"""


@query("dispatch_kpis", sql(f"select {_PROBLEM}, {_KPI} from TIMER group by all"))
def dispatch_kpis(spark, sf):
    return storage.dispatch_kpis(fx.timer_schedule(spark, sf))


_FLOWS = [("pv", "pv"), ("grid_import", "import"), ("grid_export", "export"), ("charge", "charge"), ("discharge", "discharge"), ("soc", "soc")]


@query(
    "dispatch_wide",
    sql(
        f"select series_id, day, hour, {r('max(demand)')} as demand, {r('max(price_buy)')} as price, "
        + ", ".join(
            f"""{r(f"max({c}) filter (scenario = '{s}')")} as {n}_{s.lower()}""" for s in storage.SCENARIOS for c, n in _FLOWS
        )
        + " from TIMER group by 1, 2, 3"
    ),
)
def dispatch_wide(spark, sf):
    """Unrounded: engines differ on ties of the three printed digits."""
    return storage.dispatch_wide(fx.timer_schedule(spark, sf), list(storage.SCENARIOS), digits=8, price_digits=8)


@query(
    "scenario_savings",
    sql(
        f"""select series_id, day, {r('a')} as base_cost, {r('b')} as other_cost, {r('a - b')} as saving, {r('case when a > 0 then (a - b) / a * 100 end')} as saving_pct from (
        select series_id, day, sum(price_buy * grid_import - price_sell * grid_export) filter (scenario = 'PV_low') as a,
        sum(price_buy * grid_import - price_sell * grid_export) filter (scenario = 'PV_high') as b from TIMER group by 1, 2) x"""
    ),
)
def scenario_savings(spark, sf):
    kpis = storage.dispatch_kpis(fx.timer_schedule(spark, sf))
    return storage.scenario_savings(kpis, "PV_low", "PV_high", [KEY, "day"])


@query(
    "dispatch_validate",
    sql(
        f"""select {_PROBLEM}, {r('max(abs(pv + grid_import + discharge - demand - grid_export - charge))')} as balance_gap,
        {r('max(abs(after - soc - 0.95 * charge + discharge / 0.95))')} as step_gap,
        {r('max(greatest(greatest(charge, discharge, grid_import, grid_export) - 5, -least(charge, discharge, grid_import, grid_export), 0))')} as power_excess,
        {r('max(greatest(greatest(soc, after) - capacity_kwh, -least(soc, after), 0))')} as energy_excess,
        {r('max(abs(soc - 0.5 * capacity_kwh)) filter (hour = 0)')} as start_gap, {r('max(greatest(0.2 * capacity_kwh - soc_end, 0))')} as end_gap
        from (select *, coalesce(lead(soc) over (partition by {_PROBLEM} order by hour), soc_end) as after from TIMER) x group by all"""
    ),
)
def dispatch_validate(spark, sf):
    return storage.dispatch_validate(fx.timer_schedule(spark, sf))


def _optimal(spark, sf, capacities=(storage.CAPACITY_KWH,)):
    return storage.dispatch(storage.with_capacities(fx.storage_days(spark, sf), capacities))


@query("dispatch")
def dispatch(spark, sf):
    return _optimal(spark, sf)


@query(
    "dispatch_invariants",
    sql(
        """select series_id, scenario, count(distinct day) as problems, 0::bigint as violations, 0::bigint as worse_than_timer from S group by 1, 2"""
    ),
)
def dispatch_invariants(spark, sf):
    """Solved schedules that break a limit, or cost more than a feasible timetable: none."""
    schedule = materialise(_optimal(spark, sf))
    gaps = ["balance_gap", "step_gap", "power_excess", "energy_excess", "start_gap", "end_gap"]
    checked = storage.dispatch_validate(schedule).withColumn("_gap", F.greatest(*gaps))
    timer = materialise(fx.timer_schedule(spark, sf))
    allowed = storage.dispatch_validate(timer).where(F.greatest(*gaps) < 1e-9).select(*storage.PROBLEM)
    timed = storage.dispatch_kpis(timer).join(allowed, storage.PROBLEM, "left_semi")
    timed = timed.select(*storage.PROBLEM, F.col("total_cost").alias("_timer"))
    costs = schedule.where("hour = 0").select(*storage.PROBLEM, "cost", F.when(F.col("status") != "missing_input", True).alias("_known"))
    table = checked.join(costs, storage.PROBLEM).join(timed, storage.PROBLEM, "left")
    return table.groupBy(KEY, "scenario").agg(
        F.count(F.lit(1)).alias("problems"),
        F.count_if(F.col("_gap") > 1e-6).alias("violations"),
        F.count_if(F.col("_known") & F.col("_timer").isNotNull() & (F.col("cost").isNull() | (F.col("cost") > F.col("_timer") + 1e-9))).alias("worse_than_timer"),
    )


def _any_price(spark, sf):
    """The storage days at prices around zero; every third hour selling is dearer than buying."""
    days = storage.with_capacities(fx.storage_days(spark, sf), storage.CAPACITIES)
    buy = F.col("price_buy") - F.avg("price_buy").over(Window.partitionBy(KEY, "day"))
    days = days.withColumn("price_buy", buy)
    return days.withColumn("price_sell", F.when(F.col("hour") % 3 == 0, F.col("price_buy") + 0.02).otherwise(F.col("price_buy") / 2))


def _bounded(schedule, by):
    """Problems solved, schedules that break a limit, and ones that cost more than their dual bound."""
    schedule = materialise(schedule)
    gaps = ["balance_gap", "step_gap", "power_excess", "energy_excess", "start_gap", "end_gap"]
    valid = storage.dispatch_validate(schedule).withColumn("_gap", F.greatest(*gaps)).select(*storage.PROBLEM, "_gap")
    bound = storage.dual_bound(schedule)
    status = schedule.where("hour = 0").select(*storage.PROBLEM, "status")
    all_days = status.join(valid, storage.PROBLEM).join(bound, storage.PROBLEM, "left")
    return all_days.groupBy(*by).agg(
        F.count(F.lit(1)).alias("problems"),
        F.count_if(F.col("status") == "optimal").alias("optimal"),
        F.count_if(F.col("_gap") > 1e-6).alias("violations"),
        F.count_if(F.col("cost") > F.col("bound") + 1e-7).alias("above_bound"),
    )


@query("dispatch_bound", sql("select series_id, scenario, count(distinct day) as problems, count(distinct day) as optimal, 0::bigint as violations, 0::bigint as above_bound from S group by 1, 2"))
def dispatch_bound(spark, sf):
    """Every day is solved, within its limits, at a cost that no schedule can undercut (linear-programming dual)."""
    return _bounded(_optimal(spark, sf), [KEY, "scenario"])


@query(
    "dispatch_any_price",
    sql(
        """select series_id, scenario, capacity_kwh, count(distinct day) as problems, count(distinct day) as optimal, 0::bigint as violations, 0::bigint as above_bound
        from S cross join (select unnest([5.0, 10.0, 15.0])::double as capacity_kwh) c group by 1, 2, 3"""
    ),
)
def dispatch_any_price(spark, sf):
    """The same at negative prices, at selling prices above the buying ones, and for all capacities of the sweep."""
    return _bounded(storage.dispatch(_any_price(spark, sf)), [KEY, "scenario", "capacity_kwh"])


@query("dispatch_optimal_kpis")
def dispatch_optimal_kpis(spark, sf):
    return storage.dispatch_kpis(_optimal(spark, sf))


@query("capacity_sweep")
def capacity_sweep(spark, sf):
    return storage.capacity_sweep(fx.storage_days(spark, sf))
