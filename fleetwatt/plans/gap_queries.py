"""Calendars, gaps, imputation and missingness."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.operators import decompose, grid, impute, missing
from fleetwatt.plans import fixtures as fx
from fleetwatt.plans.registry import query
from fleetwatt.plans.sqltext import WIDE_COLS, calendar, ffill, interp, r, sql

VALUE = r("value")
W_NAMES = [KEY, TIME, *fx.WIDE]


@query("resample_hourly", sql(f"select series_id, timestamp, {VALUE} as value from LC"))
def resample_hourly(spark, sf):
    return fx.long_grid(spark, sf)


@query(
    "resample_fleet",
    sql(f"select c.series_id, c.timestamp, {r('u.value')} as value from ({calendar('U')}) c left join U u on u.series_id = c.series_id and u.timestamp = c.timestamp"),
)
def resample_fleet(spark, sf):
    return grid.resample(fx.fleet(spark, sf), {"value": ("value", "mean")})


@query(
    "resample_daily",
    sql(
        f"""select c.series_id, c.timestamp, {r('coalesce(sum(pv), 0)')} as pv_total, {r('coalesce(sum("Demand"), 0)')} as demand_total,
        {r('avg("Price")')} as price_mean from (select series_id, unnest(generate_series(min(d), max(d), interval 1 day)) as timestamp from WD group by 1) c
        left join WD w on w.series_id = c.series_id and w.d = c.timestamp group by 1, 2""",
        WD="select *, date_trunc('day', timestamp)::timestamp as d from W",
    ),
)
def resample_daily(spark, sf):
    how = {"pv_total": ("pv", "sum"), "demand_total": ("Demand", "sum"), "price_mean": ("Price", "mean")}
    return grid.resample(fx.wide(spark, sf), how, freq="day")


@query(
    "resample_daily_gaps",
    sql(f"select c.series_id, c.timestamp, {r('coalesce(D.value, 0)')} as total, {r('D.value')} as mean from ({calendar('D', 'day')}) c left join D on D.series_id = c.series_id and D.timestamp = c.timestamp"),
)
def resample_daily_gaps(spark, sf):
    """Days without orders: a zero sum, a null mean."""
    return grid.resample(fx.daily(spark, sf), {"total": ("value", "sum"), "mean": ("value", "mean")}, freq="day")


@query("interp_time_both", sql(f"select series_id, timestamp, {VALUE} as value from LF"))
def interp_time_both(spark, sf):
    return fx.long_filled(spark, sf)


@query(
    "interp_time_fwd",
    sql(f"select series_id, timestamp, {r('pv_mod1')} as pv_mod1 from F1", F1=interp("W", ["pv_mod1"], both=False)),
)
def interp_time_fwd(spark, sf):
    return impute.interpolate(fx.wide(spark, sf), ["pv_mod1"], both=False).select(KEY, TIME, "pv_mod1")


@query(
    "interp_limit4",
    sql(f"select series_id, timestamp, {VALUE} as value from F1", F1=interp("UC", ["value"], limit=4),
        UC=f"select c.series_id, c.timestamp, U.value from ({calendar('U')}) c left join U on U.series_id = c.series_id and U.timestamp = c.timestamp"),
)
def interp_limit4(spark, sf):
    rows = grid.resample(fx.fleet(spark, sf), {"value": ("value", "mean")})
    return impute.interpolate(rows, ["value"], limit=4)


@query(
    "interp_pos",
    sql("select series_id, timestamp, " + ", ".join(f"{r(c)} as {c}" for c in WIDE_COLS) + " from F1", F1=interp("W", WIDE_COLS, by="position")),
)
def interp_pos(spark, sf):
    return impute.interpolate(fx.wide(spark, sf), fx.WIDE, by="position").select(*W_NAMES)


@query(
    "ffill_limit3",
    sql(f"select series_id, timestamp, {r(WIDE_COLS[0])} as {WIDE_COLS[0]} from F1", F1=ffill("W", WIDE_COLS[:1], limit=3)),
)
def ffill_limit3(spark, sf):
    return impute.forward_fill(fx.wide(spark, sf), ["Demand"], limit=3).select(KEY, TIME, "Demand")


@query("ffill_bfill", sql("select series_id, timestamp, " + ", ".join(f"{r(c)} as {c}" for c in WIDE_COLS) + " from WF"))
def ffill_bfill(spark, sf):
    return fx.wide_filled(spark, sf).select(*W_NAMES)


@query("impute_stl")
def impute_stl(spark, sf):
    return decompose.impute_stl(fx.wide(spark, sf), "pv_mod1", 24)


_KNN_COVARIATES = ["pv", "Temperature", "radiation", "Price"]
_KNN_NAMES = ["pv", '"Temperature"', "radiation", '"Price"']
_GAPS = [f"(d.{c} - g.{c})" for c in _KNN_NAMES]
_KNN = {
    "PAIRS": f"""select g.series_id, g.timestamp, d.timestamp as dt, d.pv_mod1 as dv,
        {' + '.join(f'(case when {x} is not null then 1 else 0 end)' for x in _GAPS)} as present,
        {' + '.join(f'coalesce({x} * {x}, 0.0)' for x in _GAPS)} as total
        from W g join W d on d.series_id = g.series_id and hour(d.timestamp) = hour(g.timestamp) and d.pv_mod1 is not null where g.pv_mod1 is null""",
    "NEAR": """select *, row_number() over (partition by series_id, timestamp order by dist, dt) as rn from (
        select *, sqrt(5.0::double / present * total) as dist from PAIRS where present > 0) p""",
    "VOTES": """select series_id, timestamp, case when min(dist) = 0 then avg(dv) filter (dist = 0)
        else sum(dv / nullif(dist, 0)) / sum(1 / nullif(dist, 0)) end as vote from NEAR where rn <= 5 group by 1, 2""",
}


@query(
    "impute_knn",
    sql(
        f"""select W.series_id, W.timestamp, {r('coalesce(W.pv_mod1, v.vote, avg(W.pv_mod1) over (partition by W.series_id))')} as pv_mod1
        from W left join VOTES v on v.series_id = W.series_id and v.timestamp = W.timestamp""",
        **_KNN,
    ),
)
def impute_knn(spark, sf):
    return impute.knn_impute(fx.wide(spark, sf), "pv_mod1", _KNN_COVARIATES).select(KEY, TIME, "pv_mod1")


_METHODS = {
    "F1": interp("W", ["pv_mod1"], both=False),
    "F2": ffill("W", ["pv_mod1"], back=True),
    "WIDEMETHODS": """select W.series_id, W.timestamp, W.pv_mod1 as original, F1.pv_mod1 as linear, F2.pv_mod1 as carried from W
        join F1 on F1.series_id = W.series_id and F1.timestamp = W.timestamp join F2 on F2.series_id = W.series_id and F2.timestamp = W.timestamp""",
    "METHODS": """select 'original' as method, original as value from WIDEMETHODS union all select 'linear', linear from WIDEMETHODS
        union all select 'carried', carried from WIDEMETHODS""",
}


def _methods(spark, sf):
    rows = fx.wide(spark, sf).withColumns({"original": F.col("pv_mod1"), "linear": F.col("pv_mod1"), "carried": F.col("pv_mod1")})
    rows = impute.interpolate(rows, ["linear"], both=False)
    return impute.forward_fill(rows, ["carried"], then_back=True)


@query(
    "imputation_summary",
    sql(
        f"""select method, {r('avg(value)')} as mean, {r('stddev_samp(value)')} as std, {r('min(value)')} as min, {r('max(value)')} as max,
        {r('avg((value is null)::int) * 100')} as missing_pct from METHODS group by 1""",
        **_METHODS,
    ),
)
def imputation_summary(spark, sf):
    return impute.imputation_summary(_methods(spark, sf), ["original", "linear", "carried"])


@query(
    "imputation_profile",
    sql(f"select hour(timestamp)::int as hour, {r('avg(original)')} as before, {r('avg(linear)')} as after from WIDEMETHODS group by 1", **_METHODS),
)
def imputation_profile(spark, sf):
    return impute.imputation_profile(_methods(spark, sf), "original", "linear")


_ALL = ["series_id", "timestamp", *WIDE_COLS]


@query(
    "missing_summary",
    sql(
        " union all ".join(
            f"""select '{c.strip('"')}' as "column", count(*) filter ({c} is null) as missing_count, {r(f'avg(({c} is null)::int) * 100')} as missing_pct,
            count(*) as total_rows, {r('(' + ' + '.join(f'count(*) filter ({x} is null)' for x in _ALL) + f')::double / (count(*) * {len(_ALL)}) * 100')} as overall_missing_pct from W"""
            for c in _ALL
        )
    ),
)
def missing_summary(spark, sf):
    return missing.missing_summary(fx.wide(spark, sf).select(*W_NAMES))


@query(
    "missing_runs",
    sql(
        f"""select series_id, min(timestamp) as start, coalesce(min(nxt), max(timestamp)) as "end",
        {r('(epoch(coalesce(min(nxt), max(timestamp))) - epoch(min(timestamp))) / 3600.0')} as length_hours from (
        select *, sum((pv_mod1 is not null)::int) over (partition by series_id order by timestamp) as island,
        first_value(case when pv_mod1 is not null then timestamp end ignore nulls) over (partition by series_id order by timestamp rows between current row and unbounded following) as nxt
        from W) w where pv_mod1 is null group by series_id, island"""
    ),
)
def missing_runs(spark, sf):
    return missing.missing_runs(fx.wide(spark, sf), "pv_mod1")


@query(
    "missing_by_hour",
    sql(f"select hour(timestamp)::int as hour, {r('avg((pv_mod1 is null)::int) * 100')} as missing_pct from W group by 1"),
)
def missing_by_hour(spark, sf):
    return missing.missing_by_hour(fx.wide(spark, sf), "pv_mod1")


@query(
    "missing_heatmap",
    sql(
        " union all ".join(
            f"""select date_trunc('day', timestamp)::timestamp as period, '{c.strip('"')}' as "column", {r(f'avg(({c} is null)::int) * 100')} as missing_pct from W group by 1"""
            for c in WIDE_COLS
        )
    ),
)
def missing_heatmap(spark, sf):
    return missing.missing_heatmap(fx.wide(spark, sf), fx.WIDE)


_TYPES = {"series_id": "string", "timestamp": "timestamp_ntz"}


@query(
    "schema_profile",
    sql(
        " union all ".join(
            f"""select '{c.strip('"')}' as "column", '{_TYPES.get(c, 'double')}' as dtype, {r(f'avg(({c} is null)::int) * 100')} as missing_pct,
            {'true' if c == '"Demand"' else 'false'} as selected from W"""
            for c in _ALL
        )
    ),
)
def schema_profile(spark, sf):
    return missing.schema_profile(fx.wide(spark, sf).select(*W_NAMES), ["Demand"])


@query(
    "gap_stats",
    sql(
        " union all ".join(
            f"""select '{c}' as "column", {r(f'avg(({c} is null)::int) * 100')} as missing_pct, {r(f'avg(case when {c} = 0 then 1.0 else 0.0 end) * 100')} as zero_pct,
            {r(f'avg({c})')} as mean, {r(f'stddev_samp({c})')} as std, count(*) filter ({c} > 0) as nonzero_hours, count(*) as total_rows from W"""
            for c in ["pv", "pv_mod1"]
        )
    ),
)
def gap_stats(spark, sf):
    return missing.gap_stats(fx.wide(spark, sf), ["pv", "pv_mod1"])


@query(
    "quality_kpis",
    sql(
        f"""select {r('(' + ' + '.join(f'count(*) filter ({x} is null)' for x in _ALL) + f')::double / (count(*) * {len(_ALL)})')} as missing_ratio,
        count(*) as raw_rows, count(*) filter ("Demand" is not null) as clean_rows, {r('(count(*) filter ("Demand" is not null))::double / count(*)')} as kept_ratio,
        7::bigint as feature_count, min(timestamp) as start_date, max(timestamp) as end_date from W"""
    ),
)
def quality_kpis(spark, sf):
    raw = fx.wide(spark, sf).select(*W_NAMES)
    return missing.quality_kpis(raw, raw.where("Demand IS NOT NULL"))
