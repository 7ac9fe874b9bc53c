"""Gradient-boosted trees on MLlib, trained over the whole fleet."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import as_column, is_weekend, later
from fleetwatt.functions.ordered import newest
from fleetwatt.operators.features import LAGS, cyclic_features, lag_features, ml_dataset
from fleetwatt.operators.folds import with_end
from fleetwatt.operators.metrics import forecast_metrics, improvement_pct
from fleetwatt.session import ensure_checkpoint_dir

AR_FEATURES = [f"demand_lag_{k}" for k in LAGS]
TIME_FEATURES = ["hour_sin", "hour_cos", "is_weekend"]
ROWS_PER_TASK = 50_000
#: Newest days of each series' training rows that tell when to stop boosting.
TAIL_DAYS = 4
#: Model fits that run at a time.
WORKERS = 4


def fit_gbt(
    rows: DataFrame,
    trees: int = 500,
    rate: float = 0.05,
    depth: int = 6,
    subsample: float = 0.8,
    columns: float = 0.8,
    seed: int = 42,
    validation: str | None = None,
    leaf_rows: int = 1,
) -> GBTRegressionModel:
    """Squared-error boosting on ``label`` and ``features``.

    ``validation`` names a boolean column; its rows are not fitted but tell when to stop:
    the boosting ends after the first round that does not lower their error, and the model
    is the one of the best round (``model.getNumTrees``), at most ``trees``.  Both kinds of
    rows must be there.  The first tree counts in full and there is no L2 term on leaves,
    so on few rows ``leaf_rows``, the least rows of a leaf, decides how far it fits noise.  Long boosting runs cut their lineage in the checkpoint folder of the session.  Each level
    of each tree is a job over the cached rows, so they are held in partitions of
    ``ROWS_PER_TASK`` rows: a small table then costs no more than one short task a level.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    held = F.count_if(F.col(validation)) if validation else F.lit(0)
    count, tail = rows.agg(F.count(F.lit(1)), held).first()
    if validation and not 0 < tail < count:
        raise ValueError(f"{tail} of {count} rows are there to stop the boosting")
    rows = rows.repartition(max(1, math.ceil(count / ROWS_PER_TASK))).persist(StorageLevel.MEMORY_AND_DISK)
    gbt = GBTRegressor(
        maxIter=trees,
        stepSize=rate,
        maxDepth=depth,
        subsamplingRate=subsample,
        featureSubsetStrategy=str(columns),
        seed=seed,
        checkpointInterval=10,
        cacheNodeIds=False,  # a few levels are walked faster than a table of node ids is kept for each
        validationTol=0.0,
        minInstancesPerNode=leaf_rows,
    )
    try:
        return (gbt.setValidationIndicatorCol(validation) if validation else gbt).fit(rows)
    finally:
        rows.unpersist()


def predict(model: GBTRegressionModel, rows: DataFrame, name: str, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    return model.transform(rows).select(
        *keys, F.lit(name).alias("model_name"), time, F.col("label").alias("y_true"), F.col("prediction").alias("y_pred")
    )


def learning_curve(model: GBTRegressionModel, train: DataFrame, test: DataFrame) -> DataFrame:
    """RMSE after every boosting round on both sets (one number per round)."""
    pairs = zip(model.evaluateEachIteration(train, "squared"), model.evaluateEachIteration(test, "squared"))
    rows = [(i, float(a) ** 0.5, float(b) ** 0.5) for i, (a, b) in enumerate(pairs)]
    return train.sparkSession.createDataFrame(rows, "iteration int, training_rmse double, validation_rmse double")


def feature_importance(model: GBTRegressionModel, names: Sequence[str], rows: DataFrame) -> DataFrame:
    """One row per feature of the set the model was fitted on."""
    scored = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return rows.sparkSession.createDataFrame(scored, "feature string, importance double")


def ar_frame(df: DataFrame, target: str = "Demand", keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """Lag and clock features on a complete grid."""
    rows = lag_features(df, target, LAGS, keys, time)
    return cyclic_features(rows, time).withColumn("is_weekend", is_weekend(time).cast("int"))


def split_by_end(df: DataFrame, days: int = 7, keys: Sequence[str] = (KEY,), time: str = TIME) -> tuple[DataFrame, DataFrame]:
    marked = with_end(df, keys, time)
    cut = F.col("_end") - F.expr(f"INTERVAL {int(days)} DAY")
    return marked.where(F.col(time) < cut).drop("_end"), marked.where(F.col(time) >= cut).drop("_end")


def with_tail(train: DataFrame, days: int = TAIL_DAYS, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """Add ``in_tail``: whether a row is of the newest ``days`` of its series, for early stopping."""
    cut = F.col("_end") - F.expr(f"INTERVAL {int(days)} DAY")
    return with_end(train, keys, time).withColumn("in_tail", F.col(time) > cut).drop("_end")


def fold_table(rows: DataFrame, folds: DataFrame, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """Rows with the folds as columns, so that all fits read one table.

    ``tested`` is the fold whose day a row is of, ``trains_from`` the first fold that may
    learn from it (both null for none): a row before the day of a fold is before the days
    of all later ones.  ``starts`` has the fold days of the series, oldest first.
    """
    days = folds.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("fold", "start"))).alias("starts"))  # a few days per series
    t = F.col(time)
    later_days = F.filter("starts", lambda s: s["start"] > t)
    same_day = F.filter("starts", lambda s: (s["start"] <= t) & (t < s["start"] + F.expr("INTERVAL 1 DAY")))
    return rows.join(days, list(keys)).withColumns({"trains_from": F.get(later_days, F.lit(0))["fold"], "tested": F.get(same_day, F.lit(0))["fold"]})


def _of_fold(table: DataFrame, fold: int, tail_days: int, time: str) -> DataFrame:
    """Training rows of a fold with ``in_tail``; series without that fold have none."""
    start = F.get(F.filter("starts", lambda s: s["fold"] == fold), F.lit(0))["start"]
    tail = F.col(time) >= start - F.expr(f"INTERVAL {int(tail_days)} DAY")
    return table.where((F.col("trains_from") <= fold) & start.isNotNull()).withColumn("in_tail", tail)


def fold_training_rows(table: DataFrame, tail_days: int = TAIL_DAYS, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """What each fold learns from, per series: its rows, the newest of them, and how many stop the boosting."""
    marked = table.select(*keys, time, "trains_from", F.explode("starts").alias("_f")).where(F.col("trains_from") <= F.col("_f.fold"))
    tail = F.col(time) >= F.col("_f.start") - F.expr(f"INTERVAL {int(tail_days)} DAY")
    return marked.groupBy(*keys, F.col("_f.fold").alias("fold")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(time).alias("newest"), F.count_if(tail).alias("tail_rows")
    )


def together(spark, jobs: Sequence[Callable[[], object]], workers: int = WORKERS) -> list:
    """Results of several model fits, at most ``workers`` at a time.

    Each fit runs small jobs one after the other; from threads of their own the jobs of
    several fits share the executors, evenly with ``spark.scheduler.mode`` FAIR.
    """

    def pooled(k: int, job: Callable[[], object]) -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{k % workers}")
        return job()

    with ThreadPoolExecutor(workers) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(lambda k=k, job=job: pooled(k, job))) for k, job in enumerate(jobs)]
        return [w.result() for w in waiting]


def fold_forecasts(
    table: DataFrame,
    numbers: Sequence[int],
    trees: int = 600,
    tail_days: int = TAIL_DAYS,
    name: str = "GBT",
    workers: int = WORKERS,
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
    **gbt,
) -> tuple[DataFrame, dict[int, int]]:
    """Walk-forward forecasts of a boosted model, refitted before every fold day of ``fold_table``.

    Returns ``keys, model_name, fold, time, y_true, y_pred`` and the boosting rounds that
    each fold kept.  A fold learns from the rows before its day, the newest ``tail_days`` of
    which only stop the boosting.  The fits read one table and run concurrently.
    """

    def fit(fold: int) -> GBTRegressionModel:
        return fit_gbt(_of_fold(table, fold, tail_days, time).select("label", "features", "in_tail"), trees, validation="in_tail", **gbt)

    models = together(table.sparkSession, [lambda f=f: fit(f) for f in numbers], workers)
    parts = [
        predict(m, table.where(F.col("tested") == f), name, [*keys, "tested"], time).withColumnRenamed("tested", "fold") for f, m in zip(numbers, models)
    ]
    out = reduce(DataFrame.unionByName, parts)
    return out.select(*keys, "model_name", "fold", time, "y_true", "y_pred"), {f: m.getNumTrees for f, m in zip(numbers, models)}


def exog_comparison(
    df: DataFrame,
    target: str,
    exog: Sequence[str],
    trees: int = 300,
    days: int = 7,
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
    **gbt,
) -> DataFrame:
    """Scores of the tree model on lag features alone and with exogenous signals."""
    rows = ar_frame(df, target, keys, time)
    base = [f"{target.lower()}_lag_{k}" for k in LAGS] + TIME_FEATURES
    wide = rows.na.drop(subset=[target, *base, *exog])
    sets = {"GBT (AR only)": base, "GBT (with exog)": [*base, *exog]}
    split = [split_by_end(ml_dataset(wide, target, features, keys, time), days, keys, time) for features in sets.values()]
    models = together(df.sparkSession, [lambda t=train: fit_gbt(t, trees, **gbt) for train, _ in split])
    parts = [forecast_metrics(predict(m, test, n, keys, time), ["model_name"]) for n, m, (_, test) in zip(sets, models, split)]
    scores = reduce(DataFrame.unionByName, parts)
    gain = improvement_pct(scores.withColumn("_one", F.lit(1)), "GBT (AR only)", "GBT (with exog)", ["_one"])
    return scores.withColumn("_one", F.lit(1)).join(F.broadcast(gain), "_one").drop("_one")


def recursive_forecast(
    model: GBTRegressionModel,
    history: DataFrame,
    horizon: int = 24,
    target: str = "Demand",
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
    lags: Sequence[int] = LAGS,
) -> DataFrame:
    """Hourly forecasts that feed on themselves, never below zero.

    The last hours of a series become one row with an array (newest first); each step
    predicts from it and puts its result in front.  All steps form one narrow stage over
    the fleet: no job, shuffle or checkpoint per hour.  A series with an unknown hour
    among those the lags reach, or with fewer hours, keeps its rows with a null forecast
    and the status ``missing_history``; the others have ``forecast``.
    """
    depth = max(lags)
    recent = newest(history.select(*keys, time, as_column(target).cast("double").alias("_v")), depth, keys, time)
    # `depth` numbers per series
    state = recent.groupBy(*keys).agg(
        F.transform(
            F.reverse(F.array_sort(F.collect_list(F.struct(F.col(time).alias("t"), F.col("_v").alias("v"))))), lambda p: p.getField("v")
        ).alias("_back"),
        F.max(time).alias("_last"),
        F.count("_v").alias("_known"),
    )
    short = state.where(F.col("_known") < depth).select(*keys, "_last")
    state = state.where(F.col("_known") == depth).drop("_known")
    for step in range(1, horizon + 1):
        at = later("_last", step * 3600)
        angle = F.hour(at) * F.lit(2 * math.pi / 24)
        clock = [F.sin(angle), F.cos(angle), is_weekend(at).cast("double")]
        vector = array_to_vector(F.array(*[F.element_at("_back", k) for k in lags], *clock))
        state = model.transform(state.select(*keys, "_last", "_back", vector.alias("features")))
        ahead = F.array(F.greatest(F.col("prediction"), F.lit(0.0)))
        state = state.select(*keys, "_last", F.concat(ahead, F.slice("_back", 1, depth + horizon)).alias("_back"))
    steps = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda i: F.struct(i.alias("step"), F.element_at("_back", horizon + 1 - i).alias("y_pred")))
    done = state.select(*keys, "_last", F.explode(steps).alias("_s")).select(
        *keys, "_last", F.col("_s.step").alias("step"), F.col("_s.y_pred").alias("y_pred"), F.lit("forecast").alias("status")
    )
    none = [F.lit(None).cast("double").alias("y_pred"), F.lit("missing_history").alias("status")]
    rest = short.select(*keys, "_last", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), *none)
    at = (F.col("_last") + F.make_dt_interval(hours=F.col("step"))).cast("timestamp_ntz")
    return done.unionByName(rest).select(*keys, at.alias(time), "step", "y_pred", "status")
