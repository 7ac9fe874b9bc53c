"""Queries that hold operators without a plain SQL form to what must be true of their results."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.operators.features import ml_dataset
from fleetwatt.operators import arima, clean, coerce, decompose, features, folds, stats, storage, trees
from fleetwatt.plans import fixtures as fx
from fleetwatt.plans.forecast_queries import LEAF_ROWS, _gbt, _once, _stopped, rolling_days_2_7, rolling_forecast
from fleetwatt.plans.registry import query
from fleetwatt.plans.sqltext import sql
from fleetwatt.session import materialise


@query(
    "sample_check",
    sql("select least(count(*), 2000) as rows, least(count(*), 2000) as members, least(count(*), 2000) as different from U"),
)
def sample_check(spark, sf):
    """A sample has the asked size, its rows are rows of the input, and none comes twice."""
    rows = materialise(fx.fleet(spark, sf))
    drawn = coerce.sample_rows(rows, 2000, [KEY, TIME])
    found = drawn.join(rows.select(KEY, TIME, F.col("value").alias("_v")), [KEY, TIME], "left")
    same = F.col("value").eqNullSafe(F.col("_v"))
    return found.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(same).alias("members"), F.count_distinct(KEY, TIME).alias("different")
    )


@query(
    "unkeyed_rows_kept",
    sql(
        """select count(*) as rows_in, 0::bigint as unaccounted, count(*) filter (day(timestamp) = 3) as unkeyed,
        count(*) filter (day(timestamp) = 3) as unkeyed_logged from W"""
    ),
)
def unkeyed_rows_kept(spark, sf):
    """Cleaning with the key of a day unknown: every row comes out or is counted in the log."""
    meter = fx.wide(spark, sf).withColumn(KEY, F.when(F.dayofmonth(TIME) != 3, F.col(KEY)))
    meter = materialise(meter.withColumn(TIME, F.col(TIME).cast("string")))
    done = clean.clean_dataset(meter)
    steps = {r["step"]: r["count"] for r in done.log.where("column in ('*', 'series_id', 'timestamp')").collect()}
    lost = steps.get("dropped rows with long demand gaps", 0) + steps["drop invalid timestamps"]
    out = done.data.agg(F.count(F.lit(1)).alias("_out"))
    rows = meter.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col(KEY).isNull()).alias("unkeyed"))
    return rows.join(out).select(
        "rows_in", (F.col("rows_in") - F.col("_out") - lost).alias("unaccounted"), "unkeyed", F.lit(steps["rows without a series"]).cast("long").alias("unkeyed_logged")
    )


@query(
    "adf_short_series",
    sql("select series_id, case when series_id = 'view' then 'too short' else 'tested' end as status from LF group by 1"),
)
def adf_short_series(spark, sf):
    """One series cut to its first three hours still has a row, with its reason."""
    rows = fx.long_filled(spark, sf)
    first = rows.groupBy(KEY).agg(F.min(TIME).alias("_start"))
    late = (F.col(KEY) == "view") & (F.col(TIME) >= F.col("_start") + F.expr("INTERVAL 3 HOUR"))
    kept = rows.join(first, KEY).where(~late).drop("_start")
    return stats.adf(materialise(kept)).select(KEY, "status")


@query(
    "recursive_missing_history",
    sql(
        """select series_id, case when series_id = (select min(series_id) from W) then 'missing_history' else 'forecast' end as status,
        24::bigint as steps, case when series_id = (select min(series_id) from W) then 0 else 24 end::bigint as known from W group by 1"""
    ),
)
def recursive_missing_history(spark, sf):
    """A series whose last hour is unknown keeps its 24 rows, without a forecast."""
    meter = materialise(fx.wide_filled(spark, sf))
    model, _ = _stopped(spark, sf)
    ends = meter.groupBy(KEY).agg(F.max(TIME).alias("_end"))
    one = meter.agg(F.min(KEY).alias("_one"))
    gap = (F.col(TIME) == F.col("_end")) & (F.col(KEY) == F.col("_one"))
    holed = meter.join(ends, KEY).join(one).withColumn("Demand", F.when(~gap, F.col("Demand"))).drop("_end", "_one")
    out = trees.recursive_forecast(model, holed)
    return out.groupBy(KEY, "status").agg(F.count(F.lit(1)).alias("steps"), F.count("y_pred").alias("known"))


def _seasonal(spark, sf):
    """The filled wide table with a daily course in its demand, and a model stopped early on it."""

    def build():
        course = 2.0 * F.stddev_pop("Demand").over(Window.partitionBy(KEY)) * F.sin(F.hour(TIME) * (2 * math.pi / 24))
        rows = trees.ar_frame(fx.wide_filled(spark, sf).withColumn("Demand", F.col("Demand") + course))
        features = trees.AR_FEATURES + trees.TIME_FEATURES
        train, test = trees.split_by_end(materialise(ml_dataset(rows.na.drop(subset=["Demand", *features]), "Demand", features)))
        return trees.fit_gbt(trees.with_tail(train), 600, validation="in_tail", leaf_rows=LEAF_ROWS), train, test

    return _once("seasonal", spark, sf, build)


@query("gbt_skill", sql("select series_id, true as complete, true as beats_mean from W group by 1"))
def gbt_skill(spark, sf):
    """With a daily course to learn, every hour of the test days is predicted, better than by the training mean of the series."""
    model, train, test = _seasonal(spark, sf)
    mean = train.groupBy(KEY).agg(F.avg("label").alias("_mean"))
    scored = trees.predict(model, test, "GBT").join(mean, KEY)
    return scored.groupBy(KEY).agg(
        (F.count("y_pred") == F.count("y_true")).alias("complete"),
        (F.avg(F.pow(F.col("y_pred") - F.col("y_true"), F.lit(2.0))) < F.avg(F.pow(F.col("_mean") - F.col("y_true"), F.lit(2.0)))).alias("beats_mean"),
    )


@query("gbt_halves_error", sql("select series_id, true as halves_error from W group by 1"))
def gbt_halves_error(spark, sf):
    """On the daily course the model's squared error over the test days is less than half that of the training mean."""
    model, train, test = _seasonal(spark, sf)
    mean = train.groupBy(KEY).agg(F.avg("label").alias("_mean"))
    scored = trees.predict(model, test, "GBT").join(mean, KEY)
    gap = [F.avg(F.pow(F.col(c) - F.col("y_true"), F.lit(2.0))) for c in ("y_pred", "_mean")]
    return scored.groupBy(KEY).agg((2 * gap[0] < gap[1]).alias("halves_error"))


@query("early_stop_check", "select true as kept_some, true as best_of_curve, true as falls_until_kept")
def early_stop_check(spark, sf):
    """The validation error falls with every kept round, so the last one is the best, of at most 600."""
    model, train, _ = _seasonal(spark, sf)
    tail = trees.with_tail(train).where("in_tail")
    errors = model.evaluateEachIteration(tail, "squared")  # one number per kept round
    falls = all(b < a for a, b in zip(errors, errors[1:]))
    kept = model.getNumTrees
    return spark.createDataFrame([(0 < kept <= 600, min(errors) == errors[-1], falls)], "kept_some boolean, best_of_curve boolean, falls_until_kept boolean")


_ROLLING = """select m.model_name, f.fold, count(*) as rows, count(*) as known, 0::bigint as outside
    from FOLDS f join LF on LF.series_id = f.series_id and date_trunc('day', LF.timestamp) = f.start cross join (select unnest([{}]) as model_name) m {} group by 1, 2"""


def _coverage(rows, days):
    placed = rows.join(days.select(KEY, "fold", "start"), [KEY, "fold"])
    outside = (F.col(TIME) < F.col("start")) | (F.col(TIME) >= F.col("start") + F.expr("INTERVAL 1 DAY"))
    return placed.groupBy("model_name", "fold").agg(
        F.count(F.lit(1)).alias("rows"), F.count("y_pred").alias("known"), F.count_if(outside).alias("outside")
    )


@query("rolling_members", sql(_ROLLING.format("'ARIMA(2,1,2)', 'GBT', 'naive_24h', 'naive_7d'", "")))
def rolling_members(spark, sf):
    """All four members forecast every hour of each fold's own day, and none else."""
    days = materialise(folds.daily_folds(fx.long_filled(spark, sf)))
    return _coverage(rolling_forecast(spark, sf), days)


@query("rolling_members_2_7", sql(_ROLLING.format("'SARIMA(1,1,1)(1,1,1,24)', 'GBT', 'naive_flat', 'naive_tile'", "where f.fold >= 2")))
def rolling_members_2_7(spark, sf):
    days = materialise(folds.daily_folds(fx.long_filled(spark, sf)))
    return _coverage(rolling_days_2_7(spark, sf), days)


@query("learning_curve_check", "select 600::bigint as rounds, true as falls, true as never_rises")
def learning_curve_check(spark, sf):
    """One row per boosting round; the training error falls from the first to the last, and hardly ever rises."""
    model, train, test, _ = _gbt(spark, sf)
    curve = trees.learning_curve(model, train, test)
    before = curve.select((F.col("iteration") + 1).alias("iteration"), F.col("training_rmse").alias("_before"))
    ends = curve.agg(F.max_by("training_rmse", "iteration").alias("_last"), F.min_by("training_rmse", "iteration").alias("_first"), F.count(F.lit(1)).alias("rounds"))
    steps = curve.join(before, "iteration").agg(F.avg((F.col("training_rmse") > F.col("_before") * 1.001).cast("double")).alias("_rises"))
    return ends.join(steps).select("rounds", (F.col("_last") < 0.8 * F.col("_first")).alias("falls"), (F.col("_rises") < 0.05).alias("never_rises"))


@query("stl_check", sql("select series_id, count(*) as rows, true as adds_up, true as season_is_centred from LF group by 1"))
def stl_check(spark, sf):
    """Trend, season and rest add up to the value; the season of each day is near zero on average."""
    parts = decompose.stl(fx.long_filled(spark, sf), 24)
    gap = F.max(F.abs(F.col("value") - F.col("trend") - F.col("seasonal") - F.col("resid")))
    return parts.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("rows"),
        (gap < 1e-8).alias("adds_up"),
        (F.abs(F.avg("seasonal")) <= 0.05 * F.stddev_pop("value")).alias("season_is_centred"),
    )


@query("impute_stl_check", sql("select series_id, count(*) as rows, 0::bigint as changed, 0::bigint as left_empty from W group by 1"))
def impute_stl_check(spark, sf):
    """Readings stay as they are and every gap is filled."""
    rows = materialise(fx.wide(spark, sf))
    filled = decompose.impute_stl(rows, "pv_mod1", 24).select(KEY, TIME, F.col("pv_mod1").alias("_new"))
    both = rows.select(KEY, TIME, "pv_mod1").join(filled, [KEY, TIME], "left")
    return both.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("pv_mod1").isNotNull() & ~F.col("pv_mod1").eqNullSafe(F.col("_new"))).alias("changed"),
        F.count_if(F.col("_new").isNull()).alias("left_empty"),
    )


@query(
    "incomplete_day_status",
    sql(
        """select series_id, count(*) filter (day(day) <> 5 and known = 24) as solvable, count(*) filter (day(day) = 5 or known < 24) as missing_input
        from (select series_id, day, count(demand) filter (pv is not null and price_buy is not null) as known from S where scenario = 'PV_low' group by 1, 2) x group by 1"""
    ),
)
def incomplete_day_status(spark, sf):
    """Days with an hour taken out are kept and say so."""
    rows = fx.wide_filled(spark, sf).where(~((F.dayofmonth(TIME) == 5) & (F.hour(TIME) == 7)))
    rows = rows.withColumns({"pv_low": F.col("pv") * 0.3, "pv_high": F.col("pv")})
    days = storage.scenario_unpivot(storage.dispatch_input(rows)).where("scenario = 'PV_low'")
    planned = storage.dispatch(storage.with_capacities(days, [storage.CAPACITY_KWH])).where("hour = 0")
    return planned.groupBy(KEY).agg(
        F.count_if(F.col("status") != "missing_input").alias("solvable"), F.count_if(F.col("status") == "missing_input").alias("missing_input")
    )


@query(
    "fold_leakage",
    sql(
        """select f.series_id, count(*) as rows, 0::bigint as moved from FOLDS f
        join LF on LF.series_id = f.series_id and LF.timestamp >= f.start and LF.timestamp < f.start + interval 24 hour
        where f.start = (select max(g.start) from FOLDS g where g.series_id = f.series_id) group by 1"""
    ),
)
def fold_leakage(spark, sf):
    """Forecasts of the last day do not move when the readings of that day do."""
    rows = materialise(fx.long_filled(spark, sf))
    days = materialise(folds.daily_folds(rows))
    last = days.groupBy(KEY).agg(F.max("start").alias("_start"))
    other = rows.join(last, KEY).withColumn("value", F.col("value") + F.when(F.col(TIME) >= F.col("_start"), 1000.0).otherwise(0.0)).drop("_start")
    spec = [arima.Spec((2, 1, 2))]
    first = arima.walk_forward(rows, days, spec, window=720).join(last, KEY).where(F.col(TIME) >= F.col("_start"))
    second = arima.walk_forward(materialise(other), days, spec, window=720).select(KEY, TIME, "fold", F.col("y_pred").alias("_again"))
    return first.join(second, [KEY, "fold", TIME], "left").groupBy(KEY).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("y_pred").eqNullSafe(F.col("_again"))).alias("moved")
    )


@query(
    "yeo_johnson_fitted",
    sql(
        """select variable, count(x) as values, true as likeliest, 0::bigint as out_of_order from (
        select 'Demand' as variable, "Demand" as x from W union all select 'Temperature', "Temperature" from W) a group by 1"""
    ),
)
def yeo_johnson_fitted(spark, sf):
    """The fitted lambda is likelier than its neighbours and than no transform; the transform keeps the order of the values."""
    rows = materialise(fx.wide(spark, sf).select("Demand", "Temperature"))
    cols = ["Demand", "Temperature"]
    best = features.yeo_johnson_lambda(rows, cols)
    near = {c: [v, v - 0.05, v + 0.05, 1.0] for c, v in best.items()}
    fitted = F.lit(None).cast("double")
    for c, v in best.items():
        fitted = F.when(F.col("variable") == c, F.lit(float(v))).otherwise(fitted)
    scored = features.yeo_johnson_scores(rows, cols, near).withColumn("_fitted", F.col("lambda") == fitted)
    top = scored.groupBy("variable").agg(
        (F.max(F.when(F.col("_fitted"), F.col("score"))) >= F.max("score") - 1e-6).alias("likeliest")
    )
    long = rows.unpivot([], cols, "variable", "x").where("x IS NOT NULL").withColumn("_y", features.yeo_johnson("x", fitted))
    same = long.groupBy("variable", "x").agg(F.count(F.lit(1)).alias("_n"), F.max("_y").alias("_y"))
    cell = F.floor(F.col("x") / 5.0)  # ordered within cells of the value and from cell to cell
    edges = same.groupBy("variable", cell.alias("_cell")).agg(
        F.sum("_n").alias("_n"), F.min("_y").alias("_low"), F.max("_y").alias("_high"), F.corr("x", "_y").alias("_r")
    )
    after = edges.select("variable", (F.col("_cell") + 1).alias("_cell"), F.col("_high").alias("_before"))
    joined = edges.join(after, ["variable", "_cell"], "left")
    return joined.join(top, "variable").groupBy("variable", "likeliest").agg(
        F.sum("_n").alias("values"), F.count_if((F.col("_before") >= F.col("_low")) | (F.col("_r") < 0)).alias("out_of_order")
    )
