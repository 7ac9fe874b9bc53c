"""Battery schedules."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwatt.operators import battery, storage
from frames import START

# One day of demand, generation of two scenarios and prices, and the
# lowest cost with its key figures.
DEMAND = [0.294, 0.29, 0.287, 0.28, 0.277, 0.298, 0.379, 0.501, 0.58, 0.597, 0.665, 0.802, 0.925, 0.855, 0.744, 0.662, 0.762, 0.822, 0.816, 0.991, 0.876, 0.764, 0.549, 0.369]
PV_LOW = [0, 0, 0, 0, 0, 0, 0, 0, 0, 0.03, 0.21, 0.16, 0.29, 0.19, 0.27, 0.07, 0, 0, 0, 0, 0, 0, 0, 0]
PV_HIGH = [0, 0, 0, 0, 0, 0.18, 0.58, 1.58, 2.52, 2.83, 0.36, 0.39, 0.41, 0.85, 0.73, 1.36, 0.66, 0.23, 0.3, 0.01, 0, 0, 0, 0]
PRICE = [0.06096, 0.07006, 0.07005, 0.055, 0.05757, 0.07006, 0.04968, 0.06806, 0.07489, 0.09684, 0.10008, 0.10243, 0.09509, 0.09005, 0.09005, 0.09484, 0.09351, 0.09778, 0.09205, 0.09591, 0.09762, 0.09027, 0.07956, 0.06631]
GOLD = {
    "PV_low": dict(total_cost=0.6366, pv_generation=1.22, grid_import=11.16, grid_export=0.0, self_consumption=1.22, battery_cycles=1.07, soc_max=10.0, soc_min=0.0),
    "PV_high": dict(total_cost=-0.0459, pv_generation=12.99, grid_import=0.0, grid_export=0.95, self_consumption=12.04, battery_cycles=0.75, soc_max=7.65, soc_min=2.0),
}


def problems(spark, demand=DEMAND, scenarios=None, price=PRICE, capacity=10.0):
    scenarios = scenarios or {"PV_low": PV_LOW, "PV_high": PV_HIGH}
    rows = [
        ("a", START, s, capacity, h, float(demand[h]), float(pv[h]), float(price[h]), 0.5 * float(price[h]))
        for s, pv in scenarios.items()
        for h in range(24)
    ]
    schema = "series_id string, day timestamp_ntz, scenario string, capacity_kwh double, hour int, demand double, pv double, price_buy double, price_sell double"
    return spark.createDataFrame(rows, schema)


def test_known_optimum(spark):
    got = {r["scenario"]: r for r in storage.dispatch_kpis(storage.dispatch(problems(spark))).collect()}
    for scenario, want in GOLD.items():
        # the demand above is rounded to three digits
        assert got[scenario]["total_cost"] == pytest.approx(want["total_cost"], abs=2e-4)
        for name, value in want.items():
            assert got[scenario][name] == pytest.approx(value, abs=1.2e-2), (scenario, name)


def test_schedules_are_valid(spark):
    row = storage.dispatch_validate(storage.dispatch(problems(spark))).agg(
        *[F.max(c).alias(c) for c in ["balance_gap", "step_gap", "power_excess", "energy_excess", "start_gap", "end_gap"]]
    ).first()
    assert max(row) < 1e-9


def brute_force(demand, pv, buy, sell, capacity, cells=240, burns=60):
    """Lowest cost over schedules on a fine grid of stored energy and of charging beside discharging."""
    b = storage.Battery()
    soc = np.linspace(0, capacity, cells + 1)
    best = np.where(soc >= b.end * capacity - 1e-9, 0.0, np.inf)
    more = np.linspace(0, b.power, burns + 1)[None, None, :]
    for t in range(len(demand) - 1, -1, -1):
        drop = (soc[:, None] - soc[None, :])[:, :, None]
        charge = np.maximum(0, -drop / b.efficiency) + more
        give = b.efficiency * drop + b.efficiency**2 * charge
        net = demand[t] - pv[t] + charge - give
        ok = (charge <= b.power + 1e-9) & (give <= b.power + 1e-9) & (np.abs(net) <= b.grid + 1e-9)
        # imports and exports at once, as far as the connection goes, if selling is dearer
        through = np.where(sell[t] > buy[t], b.grid - np.abs(net), 0.0)
        cost = buy[t] * (np.maximum(net, 0) + through) - sell[t] * (np.maximum(-net, 0) + through)
        best = (np.where(ok, cost, np.inf).min(axis=2) + best[None, :]).min(axis=1)
    return best[int(round(b.start * cells))]


@pytest.mark.parametrize("prices", ["usual", "signed", "inverted"])
@pytest.mark.parametrize("seed", range(4))
def test_optimum_against_a_grid_search(seed, prices):
    rng = np.random.default_rng(seed)
    hours = 6
    demand, pv = rng.uniform(0, 6, hours), rng.uniform(0, 9, hours) * (rng.random(hours) < 0.6)
    buy = rng.uniform(0.02 if prices == "usual" else -0.4, 0.4, hours)
    sell = rng.uniform(-0.4, 0.4, hours) if prices == "inverted" else buy * rng.uniform(0, 1, hours)
    plan = storage.plan_day(demand, pv, buy, sell, 10.0)
    searched = brute_force(demand, pv, buy, sell, 10.0)
    if plan is None:
        assert not np.isfinite(searched)
        return
    assert plan["cost"] <= searched + 1e-9
    # a grid of 1/24 kWh cannot be much worse than the optimum
    assert plan["cost"] >= searched - 0.06


def test_batch_is_the_same_as_one_by_one():
    rng = np.random.default_rng(7)
    net, buy, sell = rng.uniform(-8, 8, (40, 24)), rng.uniform(-0.1, 0.3, (40, 24)), rng.uniform(-0.1, 0.3, (40, 24))
    capacity = rng.choice([0.0, 5.0, 10.0, 15.0], 40)
    args = (5.0, 5.0, 0.95, 0.5, 0.2)
    found, feasible = battery.plan(net, buy, sell, capacity, *args)
    assert 0 < feasible.sum() < 40
    for i in range(40):
        one, ok = battery.plan(net[i : i + 1], buy[i : i + 1], sell[i : i + 1], capacity[i : i + 1], *args)
        assert ok[0] == feasible[i]
        if ok[0]:
            assert one["cost"][0] == pytest.approx(found["cost"][i], abs=1e-9)


def test_lossless_battery_and_empty_batch():
    net, price = np.array([[1.0, 2.0, -3.0]]), np.array([[0.1, 0.3, 0.2]])
    found, ok = battery.plan(net, price, price / 2, np.array([4.0]), 5.0, 5.0, 1.0, 0.5, 0.5)
    assert ok[0] and np.allclose(found["soc"][0, -1] - 2.0, -(found["discharge"] - found["charge"]).sum())
    none, ok = battery.plan(net[:0], price[:0], price[:0], np.zeros(0), 5.0, 5.0, 0.95, 0.5, 0.2)
    assert len(ok) == 0 and none["cost"].shape == (0,)


def test_statuses(spark):
    flood = problems(spark, scenarios={"PV_high": [20.0] * 24})
    rows = storage.dispatch(flood).select("status", "charge", "cost").distinct().collect()
    assert [tuple(r) for r in rows] == [("infeasible", None, None)]
    holed = problems(spark).withColumn("demand", F.when(F.col("hour") != 5, F.col("demand")))
    assert {r["status"] for r in storage.dispatch(holed).select("status").distinct().collect()} == {"missing_input"}


def test_negative_price_burns_energy(spark):
    """Paid to draw: the connection is used in full, charging and discharging at once."""
    negative = problems(spark, price=[-0.1] + PRICE[1:], scenarios={"PV_low": PV_LOW}, capacity=0.0)
    schedule = storage.dispatch(negative)
    first = schedule.where("hour = 0").first()
    assert first["status"] == "optimal" and min(first["charge"], first["discharge"]) > 1.0
    gaps = storage.dispatch_validate(schedule).first()
    assert max(gaps[c] for c in ["balance_gap", "step_gap", "power_excess", "energy_excess"]) < 1e-9


def test_dual_bound(spark):
    days = problems(spark).withColumn("price_sell", F.when(F.col("hour") % 4 == 0, F.col("price_buy") + 0.01).otherwise(F.col("price_sell")))
    schedule = storage.dispatch(days)
    for r in storage.dual_bound(schedule).collect():
        assert r["cost"] == pytest.approx(r["bound"], abs=1e-9)
    # a worse value of energy is still a bound, and a dearer schedule shows
    off = schedule.withColumn("energy_value", F.col("energy_value") * 0.5)
    assert all(r["bound"] < r["cost"] - 1e-6 for r in storage.dual_bound(off).collect())


def test_more_capacity_never_costs_more(spark):
    rows = problems(spark).drop("capacity_kwh")
    got = storage.capacity_sweep(rows, [5.0, 10.0, 15.0]).orderBy("scenario", "capacity_kwh").collect()
    assert len(got) == 6 and all(r["unsolved"] == 0 for r in got)


def test_savings_guard(spark):
    kpis = spark.createDataFrame([("a", "x", -1.0), ("a", "y", -2.0), ("b", "x", 4.0), ("b", "y", 1.0)], "series_id string, scenario string, total_cost double")
    got = {r["series_id"]: (r["saving"], r["saving_pct"]) for r in storage.scenario_savings(kpis, "x", "y").collect()}
    assert got == {"a": (1.0, None), "b": (3.0, 75.0)}
