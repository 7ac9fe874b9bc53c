"""Autocorrelation, tests, decomposition and feature ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.operators import decompose, grid, impute, profile, stats
from fleetwatt.plans import fixtures as fx
from fleetwatt.plans.feature_queries import inverse_normal
from fleetwatt.plans.registry import query
from fleetwatt.plans.sqltext import interp, r, sql
from fleetwatt.session import materialise

_CENTRED = """select series_id, value - avg(value) over (partition by series_id) as d, count(*) over (partition by series_id) as n,
    row_number() over (partition by series_id order by timestamp) as i from LF"""


def _sums(lags: int) -> str:
    return f"""select a.series_id, k.lag, max(a.n) as n, sum(a.d * b.d) as s from CENTRED a cross join range({lags + 1}) k(lag)
    join CENTRED b on b.series_id = a.series_id and b.i = a.i - k.lag group by 1, 2"""


@query(
    "acf",
    sql(
        f"""select series_id, lag::int as lag, {r('s / max(s) filter (lag = 0) over (partition by series_id)')} as acf, {r('1.96 / sqrt(n)')} as band from SUMS""",
        CENTRED=_CENTRED,
        SUMS=_sums(48),
    ),
)
def acf(spark, sf):
    return stats.acf(materialise(fx.long_filled(spark, sf)), 48)


@query(
    "acf_fleet",
    sql(
        f"""select series_id, lag::int as lag, {r('s / nullif(max(s) filter (lag = 0) over (partition by series_id), 0)')} as acf, {r('1.96 / sqrt(n)')} as band from SUMS""",
        CENTRED="""select series_id, value - avg(value) over (partition by series_id) as d, count(*) over (partition by series_id) as n,
            row_number() over (partition by series_id order by timestamp) as i from UF""",
        SUMS=_sums(24),
        UF=interp("UC", ["value"]),
        UC="""select c.series_id, c.timestamp, U.value from (select series_id, unnest(generate_series(min(timestamp), max(timestamp), interval 1 hour)) as timestamp
            from U group by 1) c left join U on U.series_id = c.series_id and U.timestamp = c.timestamp""",
    ),
)
def acf_fleet(spark, sf):
    rows = grid.resample(fx.fleet(spark, sf), {"value": ("value", "mean")})
    return stats.acf(materialise(impute.interpolate(rows, ["value"])), 24)


@query(
    "pacf",
    sql(
        f"""select series_id, lag::int as lag, {r('pacf')} as pacf from (
        select series_id, 0 as lag, 1.0::double as pacf from RHO union all select series_id, k, phi[k] from DL) x""",
        CENTRED=_CENTRED,
        SUMS=_sums(48),
        RHO="""select series_id, list(s / s0 order by lag) filter (lag > 0) as rho from (
            select *, max(s) filter (lag = 0) over (partition by series_id) as s0 from SUMS) q group by 1""",
        DL="""select series_id, rho, 1 as k, [rho[1]] as phi from RHO union all
            select series_id, rho, k + 1, list_append([phi[j] - last * phi[k + 1 - j] for j in range(1, k + 1)], last) from (
            select *, (rho[k + 1] - list_dot_product(phi, list_reverse(rho[1:k]))) / (1 - list_dot_product(phi, rho[1:k])) as last from DL where k < 48) z""",
    ),
)
def pacf(spark, sf):
    return stats.pacf(materialise(fx.long_filled(spark, sf)), 48)


_KPSS = {
    "CENTRED": _CENTRED,
    "SUMS": _sums(120),
    "WIDTH": """select series_id, any_value(n) as n, least(floor(1.1447 * pow(pow(sum(lag * share) / sum(share0), 2), 1 / 3::double) * pow(any_value(n), 1 / 3::double)), any_value(n) - 1)::int as used_lag from (
        select series_id, n, lag, case when lag = 0 then s / n else s / (n / 2::double) end as share0, case when lag = 0 then 0 else s / (n / 2::double) end as share
        from SUMS where lag <= floor(pow(n, 2 / 9::double))) q group by 1""",
    "LONGRUN": """select SUMS.series_id, sum(case when lag = 0 then s / SUMS.n when lag <= used_lag then 2 * (1 - lag / (used_lag + 1.0::double)) * s / SUMS.n else 0 end) as s2
        from SUMS join WIDTH using (series_id) group by 1""",
    "ETA": "select series_id, sum(w * w) / max(n * n::double) as eta from (select series_id, n, sum(d) over (partition by series_id order by i) as w from CENTRED) q group by 1",
    "STAT": "select series_id, eta / s2 as statistic, used_lag from ETA join LONGRUN using (series_id) join WIDTH using (series_id)",
}


@query(
    "kpss",
    sql(
        f"""select series_id, {r('statistic')} as statistic, used_lag, {r('''case when statistic <= 0.347 then 0.1
        when statistic <= 0.463 then 0.1 - 0.05 * (statistic - 0.347) / (0.463 - 0.347) when statistic <= 0.574 then 0.05 - 0.025 * (statistic - 0.463) / (0.574 - 0.463)
        when statistic <= 0.739 then 0.025 - 0.015 * (statistic - 0.574) / (0.739 - 0.574) else 0.01 end''')} as p_value, 0.463::double as critical_5 from STAT""",
        **_KPSS,
    ),
)
def kpss(spark, sf):
    return stats.kpss(materialise(fx.long_filled(spark, sf)))


@query("adf")
def adf(spark, sf):
    return stats.adf(materialise(fx.long_filled(spark, sf)))


@query("stationarity")
def stationarity(spark, sf):
    return stats.stationarity(materialise(fx.long_filled(spark, sf)))


@query("stl")
def stl(spark, sf):
    """Daily season of the hourly series."""
    return decompose.stl(fx.long_filled(spark, sf), 24)


@query("stl_weekly")
def stl_weekly(spark, sf):
    """Weekly season of the daily series."""
    rows = grid.daily_mean(fx.daily(spark, sf))
    return decompose.stl(impute.interpolate(rows, ["value"], unit="year"), 7)


@query("stl_strength")
def stl_strength(spark, sf):
    """Season and trend strength of both decompositions."""
    by_day = decompose.stl(fx.long_filled(spark, sf), 24).withColumn("period", F.lit("24h"))
    rows = impute.interpolate(grid.daily_mean(fx.daily(spark, sf)), ["value"], unit="year")
    by_week = decompose.stl(rows, 7).withColumn("period", F.lit("7d"))
    both = by_day.unionByName(by_week)
    return stats.seasonality_strength(both, [KEY, "period"]).withColumn("value", F.round("value", 3))


_STRENGTH = {
    "ST": " union all ".join(
        f"""select series_id, '{c}' as strength_type, case when var_pop(resid + {c}) > 1e-8 then least(greatest(1 - var_pop(resid) / var_pop(resid + {c}), 0), 1) end as value
        from C group by 1"""
        for c in ("seasonal", "trend")
    )
}


@query("seasonality_strength", sql(f"select series_id, strength_type, {r('value')} as value from ST where value is not null", **_STRENGTH))
def seasonality_strength(spark, sf):
    return stats.seasonality_strength(fx.components(spark, sf), [KEY])


_ORDER = ["view", "click", "purchase", "signup", "error", "refund"]


@query(
    "strength_pivot",
    sql(
        f"""select o.position::int as position, o.series_id, {r("coalesce(max(value) filter (strength_type = 'seasonal'), 0)")} as seasonal,
        {r("coalesce(max(value) filter (strength_type = 'trend'), 0)")} as trend from (values {', '.join(f"({i}, '{n}')" for i, n in enumerate(_ORDER))}) o(position, series_id)
        left join ST using (series_id) group by 1, 2""",
        **_STRENGTH,
    ),
)
def strength_pivot(spark, sf):
    return stats.strength_pivot(stats.seasonality_strength(fx.components(spark, sf), [KEY]), KEY, _ORDER)


@query("normality")
def normality(spark, sf):
    return stats.normality(fx.wide(spark, sf), ["Demand", "Temperature", "radiation"], [KEY, TIME])


_FRANCIA = """select variable, n, w as statistic, case when w >= 1 then 1.0 when z >= 0 then tail else 1 - tail end as p_value from (
    select *, exp(-z * z / 2) / sqrt(2 * pi()) * (0.319381530 * t - 0.356563782 * t ** 2 + 1.781477937 * t ** 3 - 1.821255978 * t ** 4 + 1.330274429 * t ** 5) as tail from (
    select *, 1 / (1 + 0.2316419 * abs(z)) as t from (
    select variable, n, w, (ln(1 - w) - (-1.2725 + 1.0521 * (ln(ln(n)) - ln(n)))) / (1.0308 - 0.26758 * (ln(ln(n)) + 2.0 / ln(n))) as z from (
    select variable, count(*) as n, corr(value, score) ** 2 as w from SCORED group by 1) a) b) c) d"""
_SCORED = f"""select variable, value, {inverse_normal('p')} as score from (
    select variable, value, (row_number() over (partition by variable order by value) - 0.375) / (count(*) over (partition by variable) + 0.25)::double as p from (
    select 'Demand' as variable, "Demand" as value from W union all select 'Temperature', "Temperature" from W union all select 'radiation', radiation from W) x
    where value is not null) y"""


@query("shapiro_francia", sql(f"select variable, n, {r('statistic')} as statistic, {r('p_value')} as p_value, p_value > 0.05 as normal from FRANCIA", SCORED=_SCORED, FRANCIA=_FRANCIA))
def shapiro_francia(spark, sf):
    """Normality of three signals over all their rows."""
    return stats.shapiro_francia(fx.wide(spark, sf), ["Demand", "Temperature", "radiation"])


_FEATURES = ["pv", "Price", "Temperature", "radiation", "hour"]
_MI = {
    "MX": " union all ".join(
        f"""select '{f}' as feature, {c}::double as x, "Demand" as y from W where {c} is not null and "Demand" is not null"""
        for f, c in zip(_FEATURES, ["pv", '"Price"', '"Temperature"', "radiation", "hour(timestamp)"])
    ),
    "PLACED": """select feature, case when x1 > x0 then least(floor((x - x0) / (x1 - x0) * 16), 15) else 0 end::int as bx,
        case when y1 > y0 then least(floor((y - y0) / (y1 - y0) * 16), 15) else 0 end::int as b_y from (
        select *, min(x) over f as x0, max(x) over f as x1, min(y) over f as y0, max(y) over f as y1 from MX window f as (partition by feature)) q""",
    "JOINT": "select feature, bx, b_y, count(*)::double as c from PLACED group by 1, 2, 3",
    "MI": """select feature, sum(c / n * ln(c * n / (cx * cy))) as mi from (select *, sum(c) over (partition by feature, bx) as cx,
        sum(c) over (partition by feature, b_y) as cy, sum(c) over (partition by feature) as n from JOINT) q group by 1""",
}


def _mi(spark, sf):
    return stats.mutual_information(fx.wide(spark, sf).withColumn("hour", F.hour(TIME)), "Demand", _FEATURES)


@query("mutual_information", sql(f"select feature, {r('mi')} as mutual_information from MI", **_MI))
def mutual_information(spark, sf):
    return _mi(spark, sf)


@query("permutation_importance")
def permutation_importance(spark, sf):
    rows = materialise(fx.wide_filled(spark, sf).withColumn("hour", F.hour(TIME)))
    return stats.permutation_importance(rows, "Demand", _FEATURES, [KEY, TIME])


@query(
    "ranking_combined",
    sql(
        f"""select coalesce(m.feature, k.feature) as feature, {r('mi')} as mutual_information, {r('correlation')} as correlation from MI m full join (
        select 'pv' as feature, corr(pv, "Demand") as correlation from W union all select 'pv_mod1', corr(pv_mod1, "Demand") from W) k on k.feature = m.feature""",
        **_MI,
    ),
)
def ranking_combined(spark, sf):
    second = profile.corr_target(fx.wide(spark, sf), "Demand", ["pv", "pv_mod1"]).select("feature", "correlation")
    return stats.ranking_combined(_mi(spark, sf), second)
