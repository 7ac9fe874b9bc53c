"""Splits, baselines, fitted forecasts and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.operators import arima, baselines, folds, metrics, trees
from fleetwatt.operators.features import feature_category, ml_dataset
from fleetwatt.plans import fixtures as fx
from fleetwatt.plans.registry import query
from fleetwatt.plans.sqltext import r, sql
from fleetwatt.session import materialise

P_COLS = f"series_id, model_name, fold, timestamp, {r('y_true')} as y_true, {r('y_pred')} as y_pred"
M_COLS = f"""{r('"MAE"')} as "MAE", {r('"RMSE"')} as "RMSE", {r('"nRMSE"')} as "nRMSE\""""
SCORES = f"""{r('avg(abs(y_pred - y_true))')} as "MAE", {r('sqrt(avg((y_pred - y_true) ** 2))')} as "RMSE",
    {r('sqrt(avg((y_pred - y_true) ** 2)) / nullif(max(y_true) - min(y_true), 0)')} as "nRMSE\""""


def _filled(spark, sf):
    return materialise(fx.long_filled(spark, sf))


def _folds(rows):
    return materialise(folds.daily_folds(rows))


def _scored(spark, sf):
    return metrics.forecast_metrics(fx.predicted(spark, sf), [KEY, "model_name", "fold"])


@query(
    "holdout_split",
    sql(
        f"""select series_id, timestamp, {r('value')} as value, case when timestamp < cut then 'train' else 'test' end as split,
        timestamp >= cut and timestamp < cut + interval 24 hour as in_validation from (select *, max(timestamp) over (partition by series_id) - interval 7 day as cut from LF) x"""
    ),
)
def holdout_split(spark, sf):
    return folds.holdout_split(fx.long_filled(spark, sf))


@query("last_7_days", sql("select series_id, fold, start, start + interval 23 hour as \"end\" from FOLDS"))
def last_7_days(spark, sf):
    return folds.daily_folds(fx.long_filled(spark, sf))


_FLEET_FOLDS = """select series_id, day as start, (max(back) over (partition by series_id) - back + 1)::int as fold from (
    select series_id, day, row_number() over (partition by series_id order by day desc) as back
    from (select distinct series_id, date_trunc('day', timestamp)::timestamp as day from U) d) e where back <= 7"""
_FLEET = {
    "UFOLDS": _FLEET_FOLDS,
    "UTEST": "select U.series_id, f.fold, f.start, U.timestamp, U.value from U join UFOLDS f on f.series_id = U.series_id and f.start = date_trunc('day', U.timestamp)",
    "UBACK": """select U.series_id, f.fold, U.value, row_number() over (partition by U.series_id, f.fold order by U.timestamp desc) as back
        from U join UFOLDS f on f.series_id = U.series_id and U.timestamp < f.start""",
}


@query(
    "naive_flat",
    sql(
        f"""select t.series_id, 'naive_flat' as model_name, t.fold, t.timestamp, {r('t.value')} as y_true, {r('b.value')} as y_pred
        from UTEST t join UBACK b on b.series_id = t.series_id and b.fold = t.fold and b.back = 1""",
        **_FLEET,
    ),
)
def naive_flat(spark, sf):
    rows = materialise(fx.fleet(spark, sf))
    return baselines.naive_flat(rows, _folds(rows))


@query(
    "naive_tile",
    sql(
        f"""select t.series_id, 'naive_tile' as model_name, t.fold, t.timestamp, {r('t.value')} as y_true, {r('b.value')} as y_pred
        from UTEST t join (select *, max(back) over (partition by series_id, fold) as n from UBACK where back <= 24) b
        on b.series_id = t.series_id and b.fold = t.fold and b.back = b.n - (hour(t.timestamp) % b.n)""",
        **_FLEET,
    ),
)
def naive_tile(spark, sf):
    rows = materialise(fx.fleet(spark, sf))
    return baselines.naive_tile(rows, _folds(rows))


@query(
    "naive_24h",
    sql(
        f"""select t.series_id, 'naive_24h' as model_name, t.fold, t.timestamp, {r('t.value')} as y_true, {r('coalesce(d.value, b.value)')} as y_pred
        from UTEST t left join U d on d.series_id = t.series_id and d.timestamp = t.timestamp - interval 24 hour
        left join UBACK b on b.series_id = t.series_id and b.fold = t.fold and b.back = 24 - hour(t.timestamp)""",
        **_FLEET,
    ),
)
def naive_24h(spark, sf):
    rows = materialise(fx.fleet(spark, sf))
    return baselines.naive_24h(rows, _folds(rows))


@query(
    "naive_7d",
    sql(
        f"""select t.series_id, 'naive_7d' as model_name, t.fold, t.timestamp, {r('t.value')} as y_true, {r('coalesce(w.value, d.value, b.value)')} as y_pred
        from UTEST t left join U w on w.series_id = t.series_id and w.timestamp = t.timestamp - interval 7 day
        left join U d on d.series_id = t.series_id and d.timestamp = t.timestamp - interval 24 hour
        left join UBACK b on b.series_id = t.series_id and b.fold = t.fold and b.back = 1""",
        **_FLEET,
    ),
)
def naive_7d(spark, sf):
    rows = materialise(fx.fleet(spark, sf))
    return baselines.naive_7d(rows, _folds(rows))


@query(
    "rolling_baselines",
    sql(
        f"""select {P_COLS} from (
        select t.series_id, 'naive_flat' as model_name, f.fold, t.timestamp, t.value as y_true, (select arg_max(h.value, h.timestamp) from LF h where h.series_id = f.series_id and h.timestamp < f.start) as y_pred
        from LF t join FOLDS f on f.series_id = t.series_id and f.start = date_trunc('day', t.timestamp) where f.fold >= 2
        union all
        select t.series_id, 'naive_tile', f.fold, t.timestamp, t.value, d.value from LF t join FOLDS f on f.series_id = t.series_id and f.start = date_trunc('day', t.timestamp)
        join LF d on d.series_id = t.series_id and d.timestamp = t.timestamp - interval 24 hour where f.fold >= 2) x"""
    ),
)
def rolling_baselines(spark, sf):
    """Days 2 to 7; on a complete grid the tile is the day before."""
    rows = _filled(spark, sf)
    return baselines.rolling_baselines(rows, _folds(rows), skip_first=True)


@query("rolling_oos_baselines", sql(f"select {P_COLS} from P"))
def rolling_oos_baselines(spark, sf):
    return fx.predicted(spark, sf)


def _ar_rows(meter):
    rows = trees.ar_frame(meter)
    features = trees.AR_FEATURES + trees.TIME_FEATURES
    return materialise(rows.na.drop(subset=["Demand", *features])), features


#: Least rows in a leaf of the models that stop early.
LEAF_ROWS = 20

_FITTED: dict[tuple[str, str], tuple] = {}


def _gbt(spark, sf):
    """All 600 rounds, as the learning curve shows them, fitted once per session and table."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _FITTED:
        rows, features = _ar_rows(fx.wide_filled(spark, sf))
        train, test = trees.split_by_end(materialise(ml_dataset(rows, "Demand", features)))
        _FITTED[at] = (trees.fit_gbt(train, 600), train, test, features)
    return _FITTED[at]


def _once(kind: str, spark, sf, build):
    """What several queries read, fitted once per session and table."""
    at = (kind, spark.sparkContext.applicationId, sf)
    if at not in _FITTED:
        _FITTED[at] = build()
    return _FITTED[at]


def _stopped(spark, sf):
    """Up to 600 rounds, stopped on the newest days before the test days."""

    def build():
        rows, features = _ar_rows(fx.wide_filled(spark, sf))
        train, test = trees.split_by_end(materialise(ml_dataset(rows, "Demand", features)))
        return trees.fit_gbt(trees.with_tail(train), 600, validation="in_tail", leaf_rows=LEAF_ROWS), test

    return _once("stopped", spark, sf, build)


@query("gbt_forecast")
def gbt_forecast(spark, sf):
    model, test = _stopped(spark, sf)
    return trees.predict(model, test, "GBT")


@query("learning_curve")
def learning_curve(spark, sf):
    model, train, test, _ = _gbt(spark, sf)
    return trees.learning_curve(model, train, test)


@query("feature_importance")
def feature_importance(spark, sf):
    model, train, _, features = _gbt(spark, sf)
    ranked = metrics.top_features(trees.feature_importance(model, features, train), 15)
    return ranked.withColumn("category", feature_category("feature"))


@query("exog_comparison")
def exog_comparison(spark, sf):
    rows = materialise(fx.wide_filled(spark, sf))
    return trees.exog_comparison(rows, "Demand", ["Temperature", "Price", "radiation"])


@query("recursive_forecast")
def recursive_forecast(spark, sf):
    meter = materialise(fx.wide_filled(spark, sf))
    model, _ = _stopped(spark, sf)
    return trees.recursive_forecast(model, meter)


@query(
    "ar1_fit",
    sql(
        f"""select series_id, {r('regr_slope(value, back)')} as phi, {r('regr_intercept(value, back)')} as intercept, count(*) as n from (
        select *, lag(value) over (partition by series_id order by timestamp) as back from LF) x where back is not null and value is not null group by 1"""
    ),
)
def ar1_fit(spark, sf):
    return arima.ar1(fx.long_filled(spark, sf))


_AR1 = """select f.series_id, f.fold, f.start, regr_slope(x.value, x.back) as phi, regr_intercept(x.value, x.back) as c,
    arg_max(x.value, x.timestamp) as last from FOLDS f join (select *, lag(value) over (partition by series_id order by timestamp) as back from LF) x
    on x.series_id = f.series_id and x.timestamp < f.start group by 1, 2, 3"""


@query(
    "ar1_walk_forward",
    sql(
        f"""select s.series_id, s.fold, s.timestamp, {r('y')} as y_pred, {r('t.value')} as y_true from (
        select series_id, fold, start + h * interval 1 hour as timestamp, pow(phi, h + 1) * last + c * (1 - pow(phi, h + 1)) / (1 - phi) as y
        from AR1 cross join range(24) g(h)) s join LF t on t.series_id = s.series_id and t.timestamp = s.timestamp""",
        AR1=_AR1,
    ),
)
def ar1_walk_forward(spark, sf):
    """ARIMA(1,0,0) refitted before each of the last seven days."""
    rows = _filled(spark, sf)
    out = arima.walk_forward(rows, _folds(rows), [arima.Spec((1, 0, 0))])
    return out.select(KEY, "fold", TIME, "y_pred", "y_true")


@query("arima_forecast")
def arima_forecast(spark, sf):
    """ARIMA(2,1,2) on the last 720 hours before each day."""
    rows = _filled(spark, sf)
    return arima.walk_forward(rows, _folds(rows), [arima.Spec((2, 1, 2))], window=720)


@query("sarima_forecast")
def sarima_forecast(spark, sf):
    rows = _filled(spark, sf)
    return arima.walk_forward(rows, _folds(rows), [arima.Spec((2, 1, 1), (0, 1, 1, 24))])


@query("arimax_forecast")
def arimax_forecast(spark, sf):
    rows = materialise(fx.wide_filled(spark, sf))
    spec = arima.Spec((2, 1, 2), exog=("Temperature", "Price", "radiation"))
    return arima.walk_forward(rows, _folds(rows), [spec], value="Demand")


@query("walk_forward")
def walk_forward(spark, sf):
    """Fold metrics of the candidate models."""
    rows = _filled(spark, sf)
    specs = [arima.Spec((2, 1, 2)), arima.Spec((1, 1, 1), (1, 1, 1, 24))]
    return metrics.forecast_metrics(arima.walk_forward(rows, _folds(rows), specs), [KEY, "model_name", "fold"])


def _fold_table(rows, days):
    lags = trees.ar_frame(rows, "value")
    features = [c for c in lags.columns if c.startswith("value_lag_")] + trees.TIME_FEATURES
    return materialise(trees.fold_table(ml_dataset(lags, "value", features), days))


def _fold_trees(spark, sf):
    def build():
        rows = _filled(spark, sf)
        days = _folds(rows)
        pred, rounds = trees.fold_forecasts(_fold_table(rows, days), range(1, 8), leaf_rows=LEAF_ROWS)
        return rows, days, materialise(pred), rounds

    return _once("folds", spark, sf, build)


@query(
    "fold_training_rows",
    sql(
        """select f.series_id, f.fold, count(*) as rows, max(x.timestamp) as newest, count(*) filter (x.timestamp >= f.start - interval 4 day) as tail_rows
        from FOLDS f join (select *, row_number() over (partition by series_id order by timestamp) as i from LF) x
        on x.series_id = f.series_id and x.timestamp < f.start where x.i > 48 group by 1, 2"""
    ),
)
def fold_training_rows(spark, sf):
    """Each fold of the tree member learns from all rows before its day that have their lags, and from none after."""
    rows = _filled(spark, sf)
    return trees.fold_training_rows(_fold_table(rows, _folds(rows)))


@query("rolling_forecast")
def rolling_forecast(spark, sf):
    """Fitted and naive members over the same seven days, every model refitted before each."""
    rows, days, boosted, _ = _fold_trees(spark, sf)
    fitted = arima.walk_forward(rows, days, [arima.Spec((2, 1, 2))], window=720).drop("status")
    naive = baselines.rolling_baselines(rows, days, members=["naive_24h", "naive_7d"])
    return fitted.unionByName(boosted).unionByName(naive)


@query("rolling_days_2_7")
def rolling_days_2_7(spark, sf):
    """Seasonal ARIMA, trees, the last value and the last day over days two to seven."""
    rows, days, boosted, _ = _fold_trees(spark, sf)
    late = days.where("fold >= 2")
    fitted = arima.walk_forward(rows, late, [arima.Spec((1, 1, 1), (1, 1, 1, 24))]).drop("status")
    naive = baselines.rolling_baselines(rows, days, skip_first=True)
    return fitted.unionByName(boosted.where("fold >= 2")).unionByName(naive)


@query(
    "align_join",
    sql(
        f"""select t.series_id, t.timestamp, {r('t.value')} as y_true, {r('d.value')} as y_pred from L t join D2 d on d.series_id = t.series_id and d.timestamp = t.timestamp""",
        D2="select series_id, timestamp + interval 24 hour as timestamp, value from L",
    ),
)
def align_join(spark, sf):
    rows = fx.long(spark, sf)
    ahead = rows.select(KEY, (F.col(TIME) + F.expr("INTERVAL 24 HOUR")).alias(TIME), F.col("value").alias("y_pred"))
    return metrics.align_join(rows.withColumnRenamed("value", "y_true"), ahead)


@query("forecast_metrics", sql(f"select series_id, model_name, {SCORES} from P group by 1, 2"))
def forecast_metrics(spark, sf):
    return metrics.forecast_metrics(fx.predicted(spark, sf))


@query(
    "metrics_train_range",
    sql(
        f"""select p.series_id, p.model_name, p.fold, {r('mae')} as "MAE", {r('rmse')} as "RMSE", {r('rmse / nullif(hi - lo, 0)')} as "nRMSE" from (
        select series_id, model_name, fold, avg(abs(y_pred - y_true)) as mae, sqrt(avg((y_pred - y_true) ** 2)) as rmse from P group by 1, 2, 3) p
        join (select f.series_id, f.fold, min(value) as lo, max(value) as hi from FOLDS f join LF on LF.series_id = f.series_id and LF.timestamp < f.start group by 1, 2) q
        on q.series_id = p.series_id and q.fold = p.fold"""
    ),
)
def metrics_train_range(spark, sf):
    rows = _filled(spark, sf)
    days = _folds(rows)
    pred = baselines.rolling_baselines(rows, days, members=["naive_24h", "naive_7d"])
    return metrics.metrics_train_range(pred, folds.train_range(rows, days, "value"))


def _summary_sql(std: str) -> str:
    parts = []
    for m in metrics.METRICS:
        parts += [
            f"""{r(f'avg("{m}")')} as "{m}_mean\"""",
            f"""{r(f'{std}("{m}")')} as "{m}_std\"""",
            f"""{r(f'quantile_cont("{m}", 0.5)')} as "{m}_median\"""",
        ]
    return sql(f"select series_id, model_name, {', '.join(parts)} from M group by 1, 2")


@query("metrics_summary", _summary_sql("stddev_samp"))
def metrics_summary(spark, sf):
    return metrics.metrics_summary(_scored(spark, sf))


@query("metrics_summary_pop", _summary_sql("stddev_pop"))
def metrics_summary_pop(spark, sf):
    return metrics.metrics_summary(_scored(spark, sf), ddof=0)


_LABELS = ("Whole-train split", "Walk-forward (mean)")
_UNION = {
    "MU": f"""select model_name, sqrt(avg((y_pred - y_true) ** 2)) as "RMSE", avg(abs(y_pred - y_true)) as "MAE",
        sqrt(avg((y_pred - y_true) ** 2)) / (max(y_true) - min(y_true)) as "nRMSE", '{_LABELS[0]}' as evaluation from P group by 1
        union all select model_name, avg("RMSE"), avg("MAE"), avg("nRMSE"), '{_LABELS[1]}' from M group by 1"""
}


def _union(spark, sf):
    pred = materialise(fx.predicted(spark, sf))
    walk = metrics.forecast_metrics(pred, [KEY, "model_name", "fold"])
    return metrics.metrics_union(metrics.forecast_metrics(pred, ["model_name"]), walk, _LABELS)


@query("metrics_union", sql(f"select model_name, evaluation, {M_COLS} from MU", **_UNION))
def metrics_union(spark, sf):
    return _union(spark, sf)


@query(
    "metrics_pivot",
    sql(
        "select model_name, "
        + ", ".join(f"""{r(f'''max("nRMSE") filter (evaluation = '{e}')''')} as "{e}\"""" for e in _LABELS)
        + " from MU group by 1",
        **_UNION,
    ),
)
def metrics_pivot(spark, sf):
    return metrics.metrics_pivot(_union(spark, sf), _LABELS)


@query(
    "pred_wide",
    sql(
        f"""select series_id, timestamp, {r('max(y_true)')} as "Actual", {r("avg(y_pred) filter (model_name = 'naive_24h')")} as naive_24h,
        {r("avg(y_pred) filter (model_name = 'naive_7d')")} as naive_7d from P group by 1, 2"""
    ),
)
def pred_wide(spark, sf):
    return metrics.pred_wide(fx.predicted(spark, sf), ["naive_24h", "naive_7d"])


@query(
    "metrics_melt",
    sql(
        " union all ".join(
            f"""select series_id, model_name, fold, '{m}' as metric, {r(f'"{m}"')} as value from M""" for m in metrics.METRICS
        )
    ),
)
def metrics_melt(spark, sf):
    return metrics.metrics_melt(_scored(spark, sf), [KEY, "model_name", "fold"])


@query(
    "best_model",
    sql(f"""select series_id, fold, arg_min(model_name, "nRMSE") as model_name, {r('min("nRMSE")')} as "nRMSE" from M group by 1, 2"""),
)
def best_model(spark, sf):
    return metrics.best_model(_scored(spark, sf), [KEY, "fold"])


@query(
    "improvement_pct",
    sql(
        "select a.series_id, a.fold, "
        + ", ".join(f"""{r(f'(a."{m}" - b."{m}") / nullif(a."{m}", 0) * 100')} as {m.lower()}_improvement_pct""" for m in ("MAE", "nRMSE"))
        + " from M a join M b on b.series_id = a.series_id and b.fold = a.fold where a.model_name = 'naive_24h' and b.model_name = 'naive_7d'"
    ),
)
def improvement_pct(spark, sf):
    return metrics.improvement_pct(_scored(spark, sf), "naive_24h", "naive_7d", [KEY, "fold"])


@query(
    "ordered_models",
    sql(f"""select o.position::int as position, model_name, series_id, fold, {M_COLS} from M join (values (0, 'naive_7d'), (1, 'naive_24h')) o(position, model_name) using (model_name)
        where "nRMSE" is not null"""),
)
def ordered_models(spark, sf):
    return metrics.ordered_models(_scored(spark, sf), ["naive_7d", "naive_24h"])


@query("residuals", sql(f"select {P_COLS}, {r('y_pred - y_true')} as residual from P where y_true is not null and y_pred is not null"))
def residuals(spark, sf):
    return metrics.residuals(fx.predicted(spark, sf))


@query(
    "daily_rmse",
    sql(f"""select series_id, model_name, date_trunc('day', timestamp)::timestamp as forecast_day, {r('sqrt(avg((y_pred - y_true) ** 2))')} as "RMSE" from P group by 1, 2, 3"""),
)
def daily_rmse(spark, sf):
    return metrics.daily_rmse(fx.predicted(spark, sf))


@query(
    "history_context",
    sql(
        f"""select LF.series_id, LF.timestamp, {r('LF.value')} as value from LF join (select series_id, min(start) as first from FOLDS group by 1) f using (series_id)
        where LF.timestamp >= first - interval 3 day and LF.timestamp < first"""
    ),
)
def history_context(spark, sf):
    rows = _filled(spark, sf)
    test = folds.fold_rows(rows, _folds(rows))
    return folds.history_context(rows, test)


@query(
    "stat_vs_ml",
    sql(
        f"""select series_id, model_name, {SCORES} from (
        select p.* from P p where (model_name = 'naive_24h' and hour(timestamp) >= 6 or model_name = 'naive_7d' and hour(timestamp) < 20) and hour(timestamp) between 6 and 19) x group by 1, 2"""
    ),
)
def stat_vs_ml(spark, sf):
    """Two prediction sets that cover different hours, scored on the shared ones."""
    pred = materialise(fx.predicted(spark, sf))
    first = pred.where((F.col("model_name") == "naive_24h") & (F.hour(TIME) >= 6))
    second = pred.where((F.col("model_name") == "naive_7d") & (F.hour(TIME) < 20))
    return metrics.compare_on_overlap(first, second)


@query(
    "last_day",
    sql(
        f"""select series_id, timestamp, {r('value')} as value from (select *, max(timestamp) over (partition by series_id) as m from U) x
        where timestamp >= date_trunc('day', m)"""
    ),
)
def last_day(spark, sf):
    return folds.last_day(fx.fleet(spark, sf))
