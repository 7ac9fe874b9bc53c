"""Features, profiles, distributions and key figures."""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.functions.quantiles import exact_quantiles
from fleetwatt.operators import features, metrics, profile, storage
from fleetwatt.operators.grid import resample
from fleetwatt.plans import fixtures as fx
from fleetwatt.plans.registry import query
from fleetwatt.plans.sqltext import calendar, r, sql
from fleetwatt.session import materialise

CYCLE = f"hour(timestamp) * {2 * math.pi / 24!r}::double"
SIX = ['"Demand"', "pv", '"Price"', '"Temperature"', "radiation", "pv_mod1"]
SIX_NAMES = [c.strip('"') for c in SIX]


@query(
    "calendar_features",
    sql(
        """select series_id, timestamp, hour(timestamp)::int as hour, (isodow(timestamp) - 1)::int as dayofweek, dayname(timestamp) as day_name,
        month(timestamp)::int as month, monthname(timestamp) as month_name, strftime(timestamp, '%b') as month_abbr,
        date_trunc('day', timestamp)::timestamp as day, (isodow(timestamp) >= 6)::int as is_weekend from D"""
    ),
)
def calendar_features(spark, sf):
    return features.calendar_features(fx.daily(spark, sf)).drop("value")


@query("cyclic_features", sql(f"select series_id, timestamp, {r(f'sin({CYCLE})')} as hour_sin, {r(f'cos({CYCLE})')} as hour_cos from U"))
def cyclic_features(spark, sf):
    return features.cyclic_features(fx.fleet(spark, sf)).drop("value")


_DEGREES = f"""{r('case when "Temperature" - 18 < 0 then 0 else "Temperature" - 18 end')} as cooling_degree,
    {r('case when 18 - "Temperature" < 0 then 0 else 18 - "Temperature" end')} as heating_degree,
    {r('"Temperature" * radiation')} as temp_irradiance_interaction"""


@query("degree_features", sql(f"select series_id, timestamp, {_DEGREES} from W"))
def degree_features(spark, sf):
    cols = ["cooling_degree", "heating_degree", "temp_irradiance_interaction"]
    return features.degree_features(fx.wide(spark, sf)).select(KEY, TIME, *cols)


@query(
    "lag_features",
    sql(
        "select series_id, timestamp, "
        + ", ".join(f"{r(f'lag(value, {k}) over (partition by series_id order by timestamp)')} as value_lag_{k}" for k in features.LAGS)
        + " from UC",
        UC=f"select c.series_id, c.timestamp, U.value from ({calendar('U')}) c left join U on U.series_id = c.series_id and U.timestamp = c.timestamp",
    ),
)
def lag_features(spark, sf):
    rows = resample(fx.fleet(spark, sf), {"value": ("value", "mean")})
    return features.lag_features(rows, "value").drop("value")


@query(
    "first_difference",
    sql(
        f"""select series_id, timestamp, {r('d')} as value from (
        select series_id, timestamp, value - lag(value) over (partition by series_id order by timestamp) as d from LF) x where d is not null"""
    ),
)
def first_difference(spark, sf):
    return features.first_difference(fx.long_filled(spark, sf))


@query(
    "feature_table",
    sql(
        f"""select series_id, timestamp, {r('"Demand"')} as "Demand", {r(f'sin({CYCLE})')} as hour_sin, {r(f'cos({CYCLE})')} as hour_cos,
        (isodow(timestamp) >= 6)::int as is_weekend, {_DEGREES}, {r('pv')} as pv, {r('"Price"')} as "Price", {r('radiation')} as radiation from WF"""
    ),
)
def feature_table(spark, sf):
    return features.feature_table(fx.wide_filled(spark, sf), "Demand", ["pv", "Price", "radiation"])


@query("tariffs", sql(f"""select series_id, timestamp, {r('"Price"')} as price_buy, {r('"Price" * 0.5')} as price_sell from W"""))
def tariffs(spark, sf):
    return features.tariffs(fx.wide(spark, sf)).select(KEY, TIME, "price_buy", "price_sell")


@query(
    "feature_category",
    f"""select category, count(*) as n, {r('avg(value)')} as mean from (
        select case when contains(name, 'demand_lag') then 'Autoregressive' when name in ('hour', 'dayofweek', 'is_weekend', 'hour_sin', 'hour_cos') then 'Time' else 'Exogenous' end as category, value
        from (select case event_type when 'view' then 'demand_lag_24' when 'click' then 'hour_sin' when 'signup' then 'is_weekend' else event_type end as name, value from events) e) x group by 1""",
)
def feature_category(spark, sf):
    e = F.col("event_type")
    name = F.when(e == "view", F.lit("demand_lag_24")).when(e == "click", F.lit("hour_sin")).when(e == "signup", F.lit("is_weekend")).otherwise(e)
    rows = fx.events(spark, sf).select(features.feature_category(name).alias("category"), "value")
    return rows.groupBy("category").agg(F.count("*").alias("n"), F.avg("value").alias("mean"))


@query(
    "format_kpis",
    sql(
        """select series_id, coalesce(printf('%.2f', value) || ' kWh', '--') as shown, coalesce(printf('%.1f', value) || '%', '--') as share,
        span, regexp_replace(lower(series_id || ' Demand (kWh)/total'), '[ /()]+', '_', 'g') as name, timestamp from (
        select *, strftime(min(timestamp) over (partition by series_id), '%Y-%m-%d') || ' → ' || strftime(max(timestamp) over (partition by series_id), '%Y-%m-%d') as span from LC) x"""
    ),
)
def format_kpis(spark, sf):
    rows = fx.long_grid(spark, sf)
    spans = rows.groupBy(KEY).agg(features.show_date_range(F.min(TIME), F.max(TIME)).alias("span"))
    return rows.join(spans, KEY).select(
        KEY,
        TIME,
        features.show_number("value", 2, " kWh").alias("shown"),
        features.show_number("value", 1, percent=True).alias("share"),
        "span",
        features.safe_name(F.concat(F.col(KEY), F.lit(" Demand (kWh)/total"))).alias("name"),
    )


@query(
    "ml_dataset",
    sql(f"""select series_id, timestamp, {r('"Demand"')} as label, {r('pv')} as f0, {r('"Temperature"')} as f1 from W
        where "Demand" is not null and pv is not null and "Temperature" is not null"""),
)
def ml_dataset(spark, sf):
    rows = features.ml_dataset(fx.wide(spark, sf), "demand", ["pv", "Temperature"])
    return rows.withColumn("_a", vector_to_array("features")).select(KEY, TIME, "label", F.col("_a")[0].alias("f0"), F.col("_a")[1].alias("f1"))


_GRID = [-1.0, -0.5, 0.0, 0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 2.5, 3.0]
_YJ = """case when x >= 0 then case when "lambda" = 0 then ln(1 + x) else (pow(x + 1, "lambda") - 1) / "lambda" end
    when x < 0 then case when "lambda" = 2 then -ln(1 - x) else -(pow(1 - x, 2 - "lambda") - 1) / (2 - "lambda") end end"""


@query(
    "yeo_johnson",
    sql(
        f"""select variable, "lambda", {r('count(y) * -0.5 * ln(var_pop(y)) + (max("lambda") - 1) * sum(sign(x) * ln(1 + abs(x)))', 6)} as score from (
        select *, {_YJ} as y from (select variable, x, unnest([{', '.join(f'{g}::double' for g in _GRID)}]) as "lambda" from (
        select 'Demand' as variable, "Demand" as x from W union all select 'Temperature', "Temperature" from W) a where x is not null) b) c group by 1, 2"""
    ),
)
def yeo_johnson(spark, sf):
    scores = features.yeo_johnson_scores(fx.wide(spark, sf), ["Demand", "Temperature"], _GRID)
    return scores.withColumn("score", F.round("score", 6))


@query(
    "yeo_johnson_transform",
    sql(f"""select series_id, timestamp, {r('y')} as value from (select *, {_YJ} as y from (select series_id, timestamp, "Temperature" as x, 0.5::double as "lambda" from W) a) b"""),
)
def yeo_johnson_transform(spark, sf):
    return fx.wide(spark, sf).select(KEY, TIME, features.yeo_johnson("Temperature", 0.5).alias("value"))


@query(
    "thousands_separator",
    f"""select o_orderpriority as series_id, format('{{:,}}', count(*)) as shown from orders group by 1""",
)
def thousands_separator(spark, sf):
    rows = fx.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias(KEY)).agg(F.count("*").alias("n"))
    return rows.select(KEY, features.show_thousands("n").alias("shown"))


_LONG6 = " union all ".join(f"select '{n}' as variable, {c} as value from W" for c, n in zip(SIX, SIX_NAMES))


@query(
    "describe",
    sql(
        f"""select variable, count(value) as count, {r('avg(value)')} as mean, {r('stddev_samp(value)')} as std, {r('min(value)')} as min, {r('max(value)')} as max,
        {r('quantile_cont(value, 0.25)')} as q25, {r('quantile_cont(value, 0.5)')} as q50, {r('quantile_cont(value, 0.75)')} as q75 from X group by 1""",
        X=_LONG6,
    ),
)
def describe(spark, sf):
    return profile.describe(materialise(fx.wide(spark, sf)), SIX_NAMES)


@query(
    "event_quantiles",
    " union all ".join(
        f"select event_type, {p}::double as prob, {r(f'quantile_cont(value, {p})')} as quantile from events group by 1" for p in (0.01, 0.5, 0.9, 0.99)
    ),
)
def event_quantiles(spark, sf):
    return exact_quantiles(fx.events(spark, sf), ["event_type"], "value", [0.01, 0.5, 0.9, 0.99])


@query(
    "moments",
    sql(
        f"""select variable, {r('avg(value)')} as mean, {r('stddev_samp(value)')} as std, {r('min(value)')} as min, {r('max(value)')} as max,
        {r('skewness(value)')} as skewness, {r('kurtosis(value)')} as kurtosis from X group by 1""",
        X=_LONG6,
    ),
)
def moments(spark, sf):
    return profile.moments_table(fx.wide(spark, sf), SIX_NAMES)


@query("hourly_profile", sql(f"""select hour(timestamp)::int as hour, {r('avg("Demand")')} as "Demand", {r('avg(pv)')} as pv from W group by 1"""))
def hourly_profile(spark, sf):
    return profile.hourly_profile(fx.wide(spark, sf), ["Demand", "pv"])


@query(
    "daytype_profile",
    sql(
        f"""select w.is_weekend, h.hour::int as hour, {r('avg(value)')} as mean from (values (false), (true)) w(is_weekend) cross join range(24) h(hour)
        left join LF on (isodow(LF.timestamp) >= 6) = w.is_weekend and hour(LF.timestamp) = h.hour group by 1, 2"""
    ),
)
def daytype_profile(spark, sf):
    return profile.daytype_profile(fx.long_filled(spark, sf), "value")


_HOURS = ", ".join(f"{r(f'avg(value) filter (hour(timestamp) = {h})')} as h{h:02d}" for h in range(24))


@query("month_hour_pivot", sql(f"select month(timestamp)::int as month, {_HOURS} from L group by 1"))
def month_hour_pivot(spark, sf):
    return profile.month_hour_pivot(fx.long(spark, sf), "value")


@query(
    "weekday_hour_pivot",
    sql(
        f"""select d.position::int as position, d.day_name, {_HOURS} from (values (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'),
        (5, 'Saturday'), (6, 'Sunday')) d(position, day_name) left join L on dayname(L.timestamp) = d.day_name group by 1, 2"""
    ),
)
def weekday_hour_pivot(spark, sf):
    return profile.weekday_hour_pivot(fx.long(spark, sf), "value")


@query(
    "monthly_stats",
    sql(
        """select month, mean, std, min, max, round(max - min, 8) + 0.0 as amplitude from (
        select month(timestamp)::int as month, round(avg(value), 3) as mean, round(stddev_samp(value), 3) as std, round(min(value), 3) as min, round(max(value), 3) as max
        from D group by 1) x"""
    ),
)
def monthly_stats(spark, sf):
    return profile.monthly_stats(fx.daily(spark, sf), "value")


@query(
    "corr_matrix",
    sql(
        " union all ".join(
            f"select '{a}' as x, '{b}' as y, {r(f'corr({p}, {q})')} as corr from W"
            for p, a in zip(SIX, SIX_NAMES)
            for q, b in zip(SIX, SIX_NAMES)
        )
    ),
)
def corr_matrix(spark, sf):
    return profile.corr_matrix(fx.wide(spark, sf), SIX_NAMES)


@query(
    "corr_target",
    sql(
        " union all ".join(
            f"""select '{n}' as feature, {r(f'avg({c})')} as mean, {r(f'stddev_samp({c})')} as std, {r(f'corr({c}, "Demand")')} as correlation from W"""
            for c, n in zip(SIX[1:], SIX_NAMES[1:])
        )
    ),
)
def corr_target(spark, sf):
    return profile.corr_target(fx.wide(spark, sf), "Demand", SIX_NAMES[1:])


_HIST = {
    "STATS": "select min(value) as lo, max(value) as hi, count(value) as n, stddev_samp(value) as sd from events",
    "BINS": """select b.bin, lo + b.bin * ((hi - lo) / 50) as left_edge, lo + (b.bin + 1) * ((hi - lo) / 50) as right_edge,
        coalesce(c.c, 0) as count, n, lo, hi, sd from STATS cross join range(50) b(bin) left join (
        select least(floor((value - lo) / ((hi - lo) / 50)), 49)::int as bin, count(*) as c from events, STATS where value is not null group by 1) c on c.bin = b.bin""",
}


@query(
    "histogram",
    sql(
        f"select bin::int as bin, {r('left_edge')} as left_edge, {r('right_edge')} as right_edge, count, {r('count / (n * ((hi - lo) / 50))')} as density from BINS",
        **_HIST,
    ),
)
def histogram(spark, sf):
    return profile.histogram(fx.events(spark, sf), "value")


@query(
    "kde",
    sql(
        f"""select point::int as point, {r('x')} as x, {r('sum(count * exp(-0.5 * pow((x - (left_edge + right_edge) / 2) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))')} as density from (
        select g.point, BINS.*, sd * pow(n, -0.2) as h, lo - 3 * sd * pow(n, -0.2) + ((hi + 3 * sd * pow(n, -0.2)) - (lo - 3 * sd * pow(n, -0.2))) * g.point / 199 as x
        from BINS cross join range(200) g(point)) q group by point, x""",
        **_HIST,
    ),
)
def kde(spark, sf):
    return profile.kde(fx.events(spark, sf), "value")


@query(
    "boxplot_by_hour",
    f"""select hour::int as hour, {r('q25')} as q25, {r('median')} as median, {r('q75')} as q75,
        {r('min(value) filter (value >= q25 - 1.5 * (q75 - q25) and value <= q75 + 1.5 * (q75 - q25))')} as whisker_low,
        {r('max(value) filter (value >= q25 - 1.5 * (q75 - q25) and value <= q75 + 1.5 * (q75 - q25))')} as whisker_high,
        count(*) filter (not (value >= q25 - 1.5 * (q75 - q25) and value <= q75 + 1.5 * (q75 - q25))) as outliers
        from (select hour(ts) as hour, value from events) e join (select hour(ts) as hour, quantile_cont(value, 0.25) as q25, quantile_cont(value, 0.5) as median,
        quantile_cont(value, 0.75) as q75 from events group by 1) q using (hour) where value is not null group by hour, q25, median, q75""",
)
def boxplot_by_hour(spark, sf):
    return profile.boxplot_by_hour(fx.events(spark, sf), "value", "ts")


@query(
    "qq_ranks",
    f"""select row_number() over (order by value) as rank, {r('value')} as ordered from events where value is not null""",
)
def qq_ranks(spark, sf):
    return profile.qq_points(fx.events(spark, sf), "value").select("rank", "ordered")


def _poly(coefficients, x: str) -> str:
    out = repr(coefficients[0])
    for k in coefficients[1:]:
        out = f"({out} * {x} + {k!r}::double)"
    return out


def inverse_normal(p: str) -> str:
    a, b, c, d = profile.INVERSE_NORMAL
    tail = lambda q: f"{_poly(c, q)} / ({_poly(d, q)} * {q} + 1)"
    low, high, mid = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - {p}))", f"({p} - 0.5::double)"
    return f"""case when {p} < 0.02425 then {tail(low)} when {p} > 1 - 0.02425::double then -({tail(high)})
        else {_poly(a, f'({mid} * {mid})')} * {mid} / ({_poly(b, f'({mid} * {mid})')} * ({mid} * {mid}) + 1) end"""


_QQ = {
    "MEDIANS": """select i, value, case when i = 1 then 1 - pow(0.5::double, 1 / n::double) when i = n then pow(0.5::double, 1 / n::double)
        else (i - 0.3175::double) / (n + 0.365::double) end as p from (
        select row_number() over (order by value) as i, count(*) over () as n, value::double as value from events where value is not null) x""",
    "QQ": f"select i as rank, {inverse_normal('p')} as theoretical, value as ordered from MEDIANS",
}


@query("qq_points", sql(f"select rank, {r('theoretical')} as theoretical, {r('ordered')} as ordered from QQ", **_QQ))
def qq_points(spark, sf):
    return profile.qq_points(fx.events(spark, sf), "value")


@query(
    "qq_line",
    sql(
        f"""select {r('regr_slope(ordered, theoretical)')} as slope, {r('regr_intercept(ordered, theoretical)')} as intercept,
        {r('corr(ordered, theoretical)')} as r, count(*) as points from QQ""",
        **_QQ,
    ),
)
def qq_line(spark, sf):
    return profile.qq_line(profile.qq_points(fx.events(spark, sf), "value"))


_RANGE = "strftime(min(timestamp), '%Y-%m-%d') || ' → ' || strftime(max(timestamp), '%Y-%m-%d')"


@query(
    "totals",
    sql(
        f"""select count(*) as rows, min(timestamp) as start, max(timestamp) as "end", {_RANGE} as date_range,
        {r('coalesce(sum("Demand"), 0)')} as demand_sum, {r('coalesce(sum(pv), 0) + coalesce(sum(pv_mod1), 0)')} as pv_sum from W"""
    ),
)
def totals(spark, sf):
    return profile.totals(fx.wide(spark, sf))


def _argmax(part: str, name: str) -> str:
    return f"""(select {part} as {name}, avg("Demand") as {name}_mean from W group by 1 having avg("Demand") is not null order by 2 desc, 1 limit 1) {name}_t"""


_KPI_PARTS = [("hour(timestamp)", "peak_hour"), ("month(timestamp)", "top_month"), ("isodow(timestamp) - 1", "top_weekday")]
_MID = "filter (hour(timestamp) between 10 and 16)"
_KPIS = {
    "BASE": f"""select avg("Demand") as mean_demand, sum(pv) / nullif(sum("Demand"), 0) * 100 as pv_share_pct,
        sum(pv) {_MID} / nullif(sum("Demand") {_MID}, 0) * 100 as midday_pv_share_pct from W""",
    "KPIS": f"""select *, ['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'][top_weekday + 1] as top_weekday_name
        from BASE, {', '.join(_argmax(p, n) for p, n in _KPI_PARTS)}""",
}


@query(
    "energy_kpis",
    sql(
        f"""select {r('mean_demand')} as mean_demand, {r('pv_share_pct')} as pv_share_pct, {r('midday_pv_share_pct')} as midday_pv_share_pct,
        {', '.join(f'{n}::int as {n}, {r(n + "_mean")} as {n}_mean' for _, n in _KPI_PARTS)}, top_weekday_name from KPIS""",
        **_KPIS,
    ),
)
def energy_kpis(spark, sf):
    return profile.energy_kpis(fx.wide(spark, sf))


_OVERVIEW = {
    "SUMMARY": """select model_name, avg("RMSE") as rmse_mean, avg("nRMSE") as nrmse_mean from M group by 1""",
    "COSTS": "select scenario, sum(price_buy * grid_import - price_sell * grid_export) as total_cost from TIMER group by 1",
}


@query(
    "overview_kpis",
    sql(
        f"""select b.model_name as best_model, {r('b.rmse_mean')} as best_model_rmse, {r('(select avg(rmse_mean) from SUMMARY)')} as average_rmse,
        {r('(select case when count(total_cost) >= 2 then max(total_cost) - min(total_cost) end from COSTS)')} as cost_savings,
        {r('greatest(0.0, 100 - b.nrmse_mean * 100)')} as forecast_accuracy from SUMMARY b order by b.rmse_mean, b.model_name limit 1""",
        **_OVERVIEW,
    ),
)
def overview_kpis(spark, sf):
    scored = metrics.forecast_metrics(fx.predicted(spark, sf), [KEY, "model_name", "fold"])
    means = scored.groupBy("model_name").agg(F.avg("RMSE").alias("RMSE_mean"), F.avg("nRMSE").alias("nRMSE_mean"))
    costs = storage.dispatch_kpis(fx.timer_schedule(spark, sf), ["scenario"])
    return profile.overview_kpis(means, costs)


@query("distinct_models", sql("select distinct model_name from P"))
def distinct_models(spark, sf):
    return profile.distinct_sorted(fx.predicted(spark, sf), "model_name")


@query(
    "insights",
    sql(
        f"""select priority::int as priority, kind, subject, {r('value')} as value, unit from (
        select 1 as priority, 'forecast_gain' as kind, null::varchar as subject, gain as value, '%' as unit from (
          select max((a."nRMSE" - b."nRMSE") / nullif(a."nRMSE", 0) * 100) as gain from M a join M b on b.series_id = a.series_id and b.fold = a.fold
          where a.model_name = 'naive_24h' and b.model_name = 'naive_7d') x where gain > 0
        union all select 2, 'scenario_cost', 'PV_high', c, '€' from (select sum(total_cost) as c from COSTS where scenario = 'PV_high') x where c is not null
        union all select 3, 'peak_hour', null, peak_hour, 'hour' from KPIS
        union all select 4, 'mean_demand', null, mean_demand, 'kWh' from KPIS
        union all select 5, 'pv_share', null, pv_share_pct, '%' from KPIS
        union all select 6, 'missing', null, ({' + '.join(f'count(*) filter ({c} is null)' for c in ('series_id', 'timestamp', '"Demand"', 'pv', 'pv_mod1', '"Price"', '"Temperature"', 'radiation'))}
          ) * 100.0::double / (count(*) * 8), '%' from W
        union all select 7, 'top_correlation', feature, c, null from (
          select feature, c from (select 'pv' as feature, corr(pv, "Demand") as c from W union all select 'Temperature', corr("Temperature", "Demand") from W) y order by c desc limit 1) z
        union all select 8, 'midday_pv_share', null, midday_pv_share_pct, '%' from KPIS where midday_pv_share_pct <> 0
        union all select 9, 'top_weekday', top_weekday_name, null, null from KPIS) f where value is not null or subject is not null""",
        **_KPIS,
        **_OVERVIEW,
    ),
)
def insights(spark, sf):
    """All nine kinds of fact."""
    meter = fx.wide(spark, sf)
    costs = storage.dispatch_kpis(fx.timer_schedule(spark, sf), ["scenario"])
    scored = metrics.forecast_metrics(fx.predicted(spark, sf), [KEY, "model_name", "fold"])
    facts = [
        profile.improvement_fact(metrics.improvement_pct(scored, "naive_24h", "naive_7d", [KEY, "fold"])),
        profile.cost_fact(costs, "PV_high"),
        profile.demand_facts(meter),
        profile.correlation_fact(profile.corr_target(meter, "Demand", ["pv", "Temperature"])),
    ]
    return profile.insights(facts, limit=9)
