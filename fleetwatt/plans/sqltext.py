"""SQL building blocks: the same derived tables as ``fixtures``, as common table expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence


def r(expr: str, digits: int = 8) -> str:
    """Eight digits, and zero without a sign."""
    return f"(round({expr}, {digits}) + 0.0)"


UP = "(partition by series_id order by timestamp rows between unbounded preceding and current row)"
DOWN = "(partition by series_id order by timestamp rows between current row and unbounded following)"


def interp(src: str, cols: Sequence[str], by: str = "time", both: bool = True, limit: int | None = None, keep: Sequence[str] = ()) -> str:
    """Linear interpolation of ``cols`` along ``timestamp`` per ``series_id``."""
    x = "epoch(timestamp)" if by == "time" else "rn::double"
    kept = "".join(f", {c}" for c in keep)
    neighbours, values = [], []
    for i, c in enumerate(cols):
        neighbours += [
            f"last_value({c} ignore nulls) over {UP} as pv{i}",
            f"last_value(case when {c} is not null then {x} end ignore nulls) over {UP} as px{i}",
            f"last_value(case when {c} is not null then rn end ignore nulls) over {UP} as pr{i}",
            f"first_value({c} ignore nulls) over {DOWN} as nv{i}",
            f"first_value(case when {c} is not null then {x} end ignore nulls) over {DOWN} as nx{i}",
            f"first_value(case when {c} is not null then rn end ignore nulls) over {DOWN} as nr{i}",
        ]
        edge = f"nv{i}" if both else "null"
        line = f"pv{i} + (nv{i} - pv{i}) * ((x - px{i}) / (nx{i} - px{i}))"
        value = f"case when {c} is not null then {c} when px{i} is null then {edge} when nx{i} is null then pv{i} else {line} end"
        if limit is not None:
            near = f"least(rn - pr{i}, nr{i} - rn)" if both else f"rn - pr{i}"
            value = f"case when {near} <= {limit} then {value} end"
        values.append(f"{value} as {c}")
    return (
        f"select series_id, timestamp{kept}, {', '.join(values)} from (select *, {x} as x, {', '.join(neighbours)} from "
        f"(select *, row_number() over (partition by series_id order by timestamp) as rn from {src}) q0) q1"
    )


def ffill(src: str, cols: Sequence[str], limit: int | None = None, back: bool = False, keep: Sequence[str] = ()) -> str:
    kept = "".join(f", {c}" for c in keep)
    inner, values = [], []
    for i, c in enumerate(cols):
        inner += [
            f"last_value({c} ignore nulls) over {UP} as pv{i}",
            f"last_value(case when {c} is not null then rn end ignore nulls) over {UP} as pr{i}",
            f"first_value({c} ignore nulls) over {DOWN} as nv{i}",
        ]
        value = f"case when rn - pr{i} <= {limit} then pv{i} end" if limit is not None else f"pv{i}"
        values.append(f"coalesce({value}, nv{i}) as {c}" if back else f"{value} as {c}")
    return (
        f"select series_id, timestamp{kept}, {', '.join(values)} from (select *, {', '.join(inner)} from "
        f"(select *, row_number() over (partition by series_id order by timestamp) as rn from {src}) q0) q1"
    )


def calendar(src: str, unit: str = "hour") -> str:
    return (
        f"select series_id, unnest(generate_series(min(timestamp), max(timestamp), interval 1 {unit})) as timestamp "
        f"from {src} group by series_id"
    )


WIDE_COLS = ['"Demand"', "pv", "pv_mod1", '"Price"', '"Temperature"', "radiation"]

# in order of dependence
TABLES: dict[str, str] = {
    "L": "select event_type as series_id, date_trunc('hour', ts)::timestamp as timestamp, sum(value) as value from events group by 1, 2",
    "U": "select user_id::varchar as series_id, date_trunc('hour', ts)::timestamp as timestamp, sum(value) as value from events group by 1, 2",
    "D": "select o_orderpriority as series_id, o_orderdate::timestamp as timestamp, sum(o_totalprice) as value from orders group by 1, 2",
    "LC": f"select c.series_id, c.timestamp, L.value from ({calendar('L')}) c left join L on L.series_id = c.series_id and L.timestamp = c.timestamp",
    "LF": interp("LC", ["value"]),
    "WB": """select concat('house_', (user_id % 2)::varchar) as series_id, date_trunc('hour', ts)::timestamp as timestamp,
        avg(value) filter (event_type = 'purchase') / 100 as "Demand", avg(value) filter (event_type = 'view') / 100 as pv,
        avg(value) filter (event_type = 'click') / 100 as pv_mod1, avg(value) filter (event_type = 'signup') / 1000 as "Price",
        avg(value) filter (event_type = 'error') - 30 as "Temperature", count(*) * 10.0::double as radiation from events group by 1, 2""",
    "W": f"""select c.series_id, c.timestamp, {', '.join('b.' + c for c in WIDE_COLS)} from ({calendar('WB')}) c
        left join WB b on b.series_id = c.series_id and b.timestamp = c.timestamp""",
    "WF": ffill("W", WIDE_COLS, back=True),
    "FOLDS": """select series_id, day as start, (max(back) over (partition by series_id) - back + 1)::int as fold from (
        select series_id, day, row_number() over (partition by series_id order by day desc) as back
        from (select distinct series_id, date_trunc('day', timestamp)::timestamp as day from LF) d) e where back <= 7""",
    "P": """select f.series_id, m.model_name, f.fold, t.timestamp, t.value as y_true,
        case m.model_name when 'naive_24h' then d.value else coalesce(w.value, d.value) end as y_pred
        from LF t join FOLDS f on f.series_id = t.series_id and f.start = date_trunc('day', t.timestamp)
        left join LF d on d.series_id = t.series_id and d.timestamp = t.timestamp - interval 24 hour
        left join LF w on w.series_id = t.series_id and w.timestamp = t.timestamp - interval 7 day
        cross join (values ('naive_24h'), ('naive_7d')) m(model_name)""",
    "M": f"""select series_id, model_name, fold, avg(abs(y_pred - y_true)) as "MAE", sqrt(avg((y_pred - y_true) ** 2)) as "RMSE",
        sqrt(avg((y_pred - y_true) ** 2)) / nullif(max(y_true) - min(y_true), 0) as "nRMSE" from P group by 1, 2, 3""",
    "S": """select series_id, day, hour, demand, price_buy, price_sell, scenario, pv from (
        select d.series_id, d.day, h.hour::int as hour, "Demand" as demand, pv * 0.3 as pv_low, pv as pv_high, "Price" as price_buy, "Price" * 0.5 as price_sell
        from (select distinct series_id, date_trunc('day', timestamp)::timestamp as day from WF) d cross join range(24) h(hour)
        left join WF on WF.series_id = d.series_id and WF.timestamp = d.day + h.hour * interval 1 hour) w
        cross join (values ('PV_low'), ('PV_high')) s(scenario), lateral (select case scenario when 'PV_low' then pv_low else pv_high end as pv) v""",
    "TIMER": """select *, greatest(net, 0.0) as grid_import, greatest(-net, 0.0) as grid_export from (select *, demand - pv + charge - discharge as net,
        5.0::double + 0.475::double * least(hour, 6) - 0.475::double * least(greatest(hour - 17, 0), 6) as soc, 5.0::double as soc_end, 10.0::double as capacity_kwh
        from (select *, case when hour < 6 then 0.5::double else 0 end as charge, case when hour between 17 and 22 then 0.45125::double else 0 end as discharge from S) a) b""",
    "C": """select series_id, timestamp, value, trend, seasonal, lft - seasonal as resid from (
        select *, avg(lft) over (partition by series_id, hour(timestamp)) as seasonal from (
        select *, value - trend as lft from (
        select *, avg(value) over (partition by series_id, date_trunc('day', timestamp)) as trend from LF) a) b) c""",
}


def sql(body: str, **local: str) -> str:
    """``body`` with the tables it names in front; ``local`` adds tables of this query."""
    known = TABLES | local
    needed: list[str] = []

    def visit(text: str) -> None:
        bare = re.sub(r"'[^']*'", "", text)
        for name in known:
            if name not in needed and known[name] != text and re.search(rf"\b{name}\b", bare):
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    parts = [f"{n} as ({known[n]})" for n in needed]
    return f"with recursive {', '.join(parts)} {body}" if parts else body
