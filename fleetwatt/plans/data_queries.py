"""Sources, typing, filtering and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.operators import clean, coerce
from fleetwatt.plans import fixtures as fx
from fleetwatt.plans.registry import query
from fleetwatt.plans.sqltext import ffill, interp, r, sql
from fleetwatt.session import materialise, shared_path
from fleetwatt.sources import readers, schemas, writers


@query("scan_projection", f"select event_id, event_type, {r('value')} as value from events")
def scan_projection(spark, sf):
    schema = fx.events(spark, sf).schema
    return readers.scan_parquet_safe(spark, f"{sf}/events.parquet", schema, ["event_id", "event_type", "value"])


@query("csv_roundtrip", sql(f"select series_id, timestamp, {r('value')} as value from L"))
def csv_roundtrip(spark, sf):
    path = shared_path(spark, "long-csv")
    writers.write_csv(fx.long(spark, sf), path)
    return readers.read_csv(spark, path, schemas.SERIES, times=[TIME])


@query("scan_csv_safe", sql(f"select series_id, timestamp, {r('value')} as value from L"))
def scan_csv_safe(spark, sf):
    """An absent file adds no rows; the written one keeps all of its own."""
    path = shared_path(spark, "long-csv")
    writers.write_csv(fx.long(spark, sf), path)
    absent = readers.scan_csv_safe(spark, f"{path}-absent", schemas.SERIES, times=[TIME])
    return readers.scan_csv_safe(spark, path, schemas.SERIES, times=[TIME]).unionByName(absent)


@query(
    "parquet_sink",
    sql(
        f"""select series_id, timestamp, {r('"Demand"')} as "Demand", strftime(timestamp, '%Y-%m') as month
        from WF"""
    ),
)
def parquet_sink(spark, sf):
    path = shared_path(spark, "features")
    writers.write_feature_table(fx.wide_filled(spark, sf), path)
    return spark.read.parquet(path).select(KEY, TIME, "Demand", F.date_format(TIME, "yyyy-MM").alias("month"))


@query("first_nonempty", sql(f"select series_id, timestamp, {r('value')} as value from D"))
def first_nonempty(spark, sf):
    absent = readers.scan_parquet_safe(spark, f"{sf}/no_such_table.parquet", schemas.SERIES)
    return readers.first_nonempty([absent, fx.daily(spark, sf), fx.long(spark, sf)])


@query(
    "alias_normalise",
    f"select p_type as variable, count(*) as n, {r('avg(p_retailprice)')} as importance from part group by 1",
)
def alias_normalise(spark, sf):
    ranked = fx.table(spark, sf, "part").groupBy("p_type").agg(F.count("*").alias("n"), F.avg("p_retailprice").alias("Importance"))
    return readers.rename_aliases(ranked, {"importance": ["Importance", "gain"]}, first="variable")


@query(
    "drop_empty_rows",
    sql(f"""select {r('"Demand"')} as "Demand", {r('pv')} as pv, {r('"Price"')} as "Price" from W
        where not ("Demand" is null and pv is null and "Price" is null)"""),
)
def drop_empty_rows(spark, sf):
    return coerce.drop_empty_rows(fx.wide(spark, sf).select("Demand", "pv", "Price"))


@query(
    "ts_normalise",
    """select event_id, ts as timestamp from (select event_id, try_cast(case when event_id % 10 = 3 then 'bad' else ts::varchar end as timestamp) as ts
    from events) e where ts is not null""",
)
def ts_normalise(spark, sf):
    text = F.when(F.col("event_id") % 10 == 3, F.lit("bad")).otherwise(F.col("ts").cast("string"))
    return coerce.normalise_time(fx.events(spark, sf).select("event_id", text.alias(TIME)))


@query(
    "coerce_numeric",
    f"""select event_id, {r("try_cast(case when event_type = 'error' then 'n/a' else value::varchar end as double)")} as value from events""",
)
def coerce_numeric(spark, sf):
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    rows = fx.events(spark, sf).select("event_id", "event_type", text.alias("value"))
    found = coerce.text_columns_with_numbers(rows, skip=["event_id"])
    return coerce.coerce_numeric(rows, found).select("event_id", "value")


@query(
    "select_columns",
    sql(f"""select series_id, timestamp, {r('pv')} as pv, {r('pv_mod1')} as pv_mod1, {r('"Demand"')} as "Demand" from W"""),
)
def select_columns(spark, sf):
    """Signals found by a keyword, a target found whatever its case."""
    rows = fx.wide(spark, sf)
    return rows.select(KEY, TIME, *coerce.columns_like(rows, ["PV", "pv_mod"]), coerce.resolve_target(rows, "demand"))


@query(
    "clip_negative",
    sql(f"""select series_id, timestamp, {r('case when "Temperature" < 0 then 0.0 else "Temperature" end')} as value,
        count(*) filter ("Temperature" < 0) over (partition by series_id) as clipped from W"""),
)
def clip_negative(spark, sf):
    rows = fx.wide(spark, sf)
    counts = rows.groupBy(KEY).agg(F.count_if(F.col("Temperature") < 0).alias("clipped"))
    return rows.select(KEY, TIME, coerce.clip_negative("Temperature").alias("value")).join(counts, KEY)


@query(
    "drop_null_rows",
    sql(f"""select series_id, timestamp, {r('"Demand"')} as "Demand", {r('pv')} as pv from W where "Demand" is not null and pv is not null"""),
)
def drop_null_rows(spark, sf):
    return coerce.drop_null_rows(fx.wide(spark, sf), ["Demand", "pv"]).select(KEY, TIME, "Demand", "pv")


@query(
    "dedup_first",
    f"""select event_type as series_id, date_trunc('hour', ts)::timestamp as timestamp, event_id, {r('value')} as value from (
        select *, row_number() over (partition by event_type, date_trunc('hour', ts) order by event_id) as rn from events) e where rn = 1""",
)
def dedup_first(spark, sf):
    e = fx.events(spark, sf)
    rows = e.select(F.col("event_type").alias(KEY), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias(TIME), "event_id", "value")
    return coerce.dedup_first(rows, ["event_id"])


@query(
    "filter_time_range",
    f"""select event_id, ts, {r('value')} as value from events where ts >= timestamp '2024-01-08 06:00:00' and ts <= timestamp '2024-01-21 18:30:00'""",
)
def filter_time_range(spark, sf):
    rows = fx.events(spark, sf).select("event_id", "ts", "value")
    return coerce.time_range(rows, "2024-01-08 06:00:00", "2024-01-21 18:30:00", time="ts")


@query(
    "slice_dates",
    f"""select event_id, ts, {r('value')} as value from events where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-15'""",
)
def slice_dates(spark, sf):
    return coerce.date_slice(fx.events(spark, sf).select("event_id", "ts", "value"), "2024-01-08", "2024-01-14", time="ts")


@query(
    "last_n_days",
    sql(
        f"""select series_id, timestamp, {r('value')} as value from (select *, max(timestamp) over (partition by series_id) as m from D) d
        where timestamp >= m - interval 90 day"""
    ),
)
def last_n_days(spark, sf):
    return coerce.last_days(fx.daily(spark, sf), 90)


@query(
    "filter_fallback",
    sql(f"""select series_id, model_name, fold, timestamp, {r('y_true')} as y_true, {r('y_pred')} as y_pred from P where model_name = 'naive_7d'"""),
)
def filter_fallback(spark, sf):
    """The wanted model has no rows, so the second choice is shown."""
    return coerce.with_fallback(fx.predicted(spark, sf), "model_name", ["GBT", "naive_7d", "naive_24h"])


@query(
    "sample_head",
    sql("""select series_id, timestamp, round(value, 3) + 0.0 as value from L order by timestamp, series_id limit 10"""),
)
def sample_head(spark, sf):
    return coerce.sample_head(fx.long(spark, sf), [KEY, TIME, "value"], 10, 3, [TIME, KEY])


@query(
    "quality_checks",
    """select user_id::varchar as series_id, count(*) as rows, count(*) filter (ts <= prev) as not_increasing from (
    select user_id, ts, lag(ts) over (partition by user_id order by event_id) as prev from (
    select user_id, event_id, case when event_id % 7 = 0 then ts - interval 2 day else ts end as ts from events) a) b group by 1""",
)
def quality_checks(spark, sf):
    """Every seventh event is stamped two days late, which the check must find."""
    late = F.when(F.col("event_id") % 7 == 0, F.col("ts") - F.expr("INTERVAL 2 DAY")).otherwise(F.col("ts"))
    rows = fx.events(spark, sf).select(F.col("user_id").cast("string").alias(KEY), "event_id", late.alias(TIME))
    return coerce.quality_checks(rows, "event_id")


@query(
    "raw_vs_clean",
    sql(
        f"""select series_id, timestamp, variable, {r('value')} as value, source from (
        select series_id, timestamp, 'Demand' as variable, "Demand" as value, 'raw' as source from W union all
        select series_id, timestamp, 'pv', pv, 'raw' from W union all
        select series_id, timestamp, 'Demand', "Demand", 'cleaned' from WF union all
        select series_id, timestamp, 'pv', pv, 'cleaned' from WF) x
        where timestamp >= timestamp '2024-01-03' and timestamp <= timestamp '2024-01-24 12:00:00'"""
    ),
)
def raw_vs_clean(spark, sf):
    return coerce.raw_vs_clean(
        fx.wide(spark, sf), fx.wide_filled(spark, sf), ["Demand", "pv"], start="2024-01-03", end="2024-01-24 12:00:00"
    )


@query(
    "tail_n",
    sql(f"""select series_id, timestamp, {r('value')} as value from (
        select *, row_number() over (partition by series_id order by timestamp desc) as rn from U) u where rn <= 48"""),
)
def tail_n(spark, sf):
    return coerce.last_rows(fx.fleet(spark, sf), 48)


@query("null_rows", sql("select series_id, timestamp from W where pv_mod1 is null"))
def null_rows(spark, sf):
    return coerce.null_rows(fx.wide(spark, sf), "pv_mod1").select(KEY, TIME)


_RAW = f"""select series_id, timestamp, "Demand" - 0.2 as "Demand", pv - 0.1 as pv, pv_mod1, "Price" from W"""
_CLEAN = {
    "RAW": _RAW,
    "STEP1": interp("RAW", ["pv", "pv_mod1"], limit=4, keep=['"Demand"', '"Price"']),
    "STEP2": ffill("STEP1", ['"Demand"'], limit=3, keep=["pv", "pv_mod1", '"Price"']),
}


def _raw_meter(spark: SparkSession, sf: str) -> DataFrame:
    """The wide table as text-and-number input with negative readings."""
    rows = fx.wide(spark, sf).select(
        KEY,
        F.col(TIME).cast("string").alias(TIME),
        (F.col("Demand") - 0.2).cast("string").alias("Demand"),
        (F.col("pv") - 0.1).alias("pv"),
        "pv_mod1",
        "Price",
    )
    # cleaning looks at its input several times
    return materialise(rows)


@query(
    "clean_dataset",
    sql(
        f"""select series_id, timestamp, {r('greatest("Demand", 0)')} as "Demand", {r('case when pv < 0 then 0 else pv end')} as pv,
        {r('case when pv_mod1 < 0 then 0 else pv_mod1 end')} as pv_mod1, {r('"Price"')} as "Price" from STEP2 where "Demand" is not null""",
        **_CLEAN,
    ),
)
def clean_dataset(spark, sf):
    return clean.clean_dataset(_raw_meter(spark, sf)).data


_LOG_ROWS = [("drop invalid timestamps", "timestamp", "0")]
for _c in ["pv", "pv_mod1"]:
    _LOG_ROWS.append(("interpolated pv", _c, f"(select count(*) from RAW where {_c} is null) - (select count(*) from STEP1 where {_c} is null)"))
_LOG_ROWS.append(
    ("forward-filled demand", "Demand", '(select count(*) from RAW where "Demand" is null) - (select count(*) from STEP2 where "Demand" is null)')
)
for _c, _q in [("pv", "pv"), ("pv_mod1", "pv_mod1"), ("Demand", '"Demand"')]:
    _LOG_ROWS.append(("clipped negatives", _c, f"(select count(*) from STEP2 where {_q} < 0)"))
    _LOG_ROWS.append(("missing before", _c, f"(select count(*) from RAW where {_q} is null)"))
_LOG_ROWS.append(("rows without a series", "series_id", "0"))
_LOG_ROWS.append(("dropped rows with long demand gaps", "*", '(select count(*) from STEP2 where "Demand" is null)'))


@query(
    "clean_log",
    sql(" union all ".join(f"select '{s}' as step, '{c}' as \"column\", ({n})::bigint as count" for s, c, n in _LOG_ROWS), **_CLEAN),
)
def clean_log(spark, sf):
    return clean.clean_dataset(_raw_meter(spark, sf)).log


@query("sample_n")
def sample_n(spark, sf):
    """2,000 rows without replacement, the same ones on every run."""
    return coerce.sample_rows(fx.fleet(spark, sf), 2000, [KEY, TIME])
