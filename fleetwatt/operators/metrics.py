"""Scoring forecasts and arranging the scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import as_column, naive
from fleetwatt.functions.quantiles import exact_quantiles
from fleetwatt.operators.profile import order_table

# The metric names and their order in reports.
METRICS = ("MAE", "RMSE", "nRMSE")


def align_join(truth: DataFrame, pred: DataFrame, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """Truth and prediction at the moments both have."""
    return truth.join(pred, [*keys, time], "inner")


def _errors(y_true: str, y_pred: str) -> tuple[Column, Column, Column]:
    both = as_column(y_true).isNotNull() & as_column(y_pred).isNotNull()
    gap = F.when(both, as_column(y_pred) - as_column(y_true))
    truth = F.when(both, as_column(y_true))
    return F.avg(F.abs(gap)), F.sqrt(F.avg(gap * gap)), F.max(truth) - F.min(truth)


def forecast_metrics(
    pred: DataFrame, by: Sequence[str] = (KEY, "model_name"), y_true: str = "y_true", y_pred: str = "y_pred"
) -> DataFrame:
    """MAE, RMSE and RMSE over the range of the scored truth (null for a flat truth)."""
    mae, rmse, width = _errors(y_true, y_pred)
    out = pred.groupBy(*by).agg(mae.alias("MAE"), rmse.alias("RMSE"), width.alias("_w"))
    return out.withColumn("nRMSE", F.when(F.col("_w") > 0, F.col("RMSE") / F.col("_w"))).drop("_w")


def metrics_train_range(
    pred: DataFrame, ranges: DataFrame, by: Sequence[str] = (KEY, "model_name", "fold"), on: Sequence[str] = (KEY, "fold")
) -> DataFrame:
    """As above with the range of the training data below."""
    scored = forecast_metrics(pred, by).drop("nRMSE").join(ranges, list(on), "left")
    width = F.col("train_max") - F.col("train_min")
    return scored.withColumn("nRMSE", F.when(width > 0, F.col("RMSE") / width)).drop("train_min", "train_max")


def metrics_summary(metrics: DataFrame, by: Sequence[str] = (KEY, "model_name"), ddof: int = 1, key: str = KEY) -> DataFrame:
    """Mean, std and median of each metric over the folds of a model.

    Within a series a group has one row per fold, so the median sorts a handful of
    numbers; a group that spans the fleet is ranked by counting instead.
    """
    spread = F.stddev_samp if ddof == 1 else F.stddev_pop
    small = key in by
    out = []
    for m in METRICS:
        out += [F.avg(m).alias(f"{m}_mean"), spread(m).alias(f"{m}_std")]
        out += [F.percentile(m, F.lit(0.5)).alias(f"{m}_median")] if small else []
    table = metrics.groupBy(*by).agg(*out)
    if small:
        return table
    long = metrics.unpivot(list(by), list(METRICS), "_metric", "_value")
    middle = exact_quantiles(long, [*by, "_metric"], "_value", [0.5])
    wide = middle.groupBy(*by).agg(*[F.max(F.when(F.col("_metric") == m, F.col("quantile"))).alias(f"{m}_median") for m in METRICS])
    return table.join(wide, list(by), "left")


def metrics_mean(metrics: DataFrame, label: str, by: Sequence[str] = ("model_name",)) -> DataFrame:
    return metrics.groupBy(*by).agg(*[F.avg(m).alias(m) for m in METRICS]).withColumn("evaluation", F.lit(label))


def metrics_union(single: DataFrame, walk: DataFrame, labels: tuple[str, str], by: Sequence[str] = ("model_name",)) -> DataFrame:
    """Single-split scores and mean walk-forward scores under one another."""
    one = single.select(*by, *METRICS).withColumn("evaluation", F.lit(labels[0]))
    return one.unionByName(metrics_mean(walk, labels[1], by))


def metrics_pivot(table: DataFrame, evaluations: Sequence[str], metric: str = "nRMSE", by: str = "model_name") -> DataFrame:
    return table.groupBy(by).pivot("evaluation", list(evaluations)).agg(F.avg(metric))


def pred_wide(pred: DataFrame, models: Sequence[str], keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """One column per model and the truth per moment."""
    truth = F.max("y_true").alias("Actual")
    picked = [F.avg(F.when(F.col("model_name") == m, F.col("y_pred"))).alias(m) for m in models]
    return pred.groupBy(*keys, time).agg(truth, *picked)


def metrics_melt(metrics: DataFrame, ids: Sequence[str] = ("model_name",)) -> DataFrame:
    return metrics.unpivot(list(ids), list(METRICS), "metric", "value")


def best_model(metrics: DataFrame, by: Sequence[str] = (KEY,), metric: str = "nRMSE") -> DataFrame:
    """The model with the lowest score per group; the first name on a tie."""
    ranked = F.struct(F.col(metric), F.col("model_name"))
    best = F.min(F.when(F.col(metric).isNotNull(), ranked))
    return metrics.groupBy(*by).agg(best.alias("_b")).select(
        *by, F.col("_b.model_name").alias("model_name"), F.col(f"_b.{metric}").alias(metric)
    )


def ordered_models(wide: DataFrame, order: Sequence[str], column: str = "model_name") -> DataFrame:
    """Rows of the listed models, in that order, without incomplete rows."""
    return order_table(wide, column, list(order)).join(wide, column, "inner").na.drop().orderBy("position")


def improvement_pct(
    metrics: DataFrame, base: str, variant: str, by: Sequence[str] = (KEY,), metrics_of: Sequence[str] = ("MAE", "nRMSE")
) -> DataFrame:
    """(base − variant) / base · 100 per metric."""

    def of(name: str, m: str) -> Column:
        return F.max(F.when(F.col("model_name") == name, F.col(m)))

    out = [(F.try_divide(of(base, m) - of(variant, m), of(base, m)) * 100).alias(f"{m.lower()}_improvement_pct") for m in metrics_of]
    return metrics.groupBy(*by).agg(*out)


def residuals(pred: DataFrame) -> DataFrame:
    rows = pred.where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    return rows.withColumn("residual", F.col("y_pred") - F.col("y_true"))


def daily_rmse(pred: DataFrame, by: Sequence[str] = (KEY, "model_name"), time: str = TIME) -> DataFrame:
    gap = F.col("y_pred") - F.col("y_true")
    out = pred.groupBy(*by, naive(F.date_trunc("day", F.col(time))).alias("forecast_day")).agg(F.sqrt(F.avg(gap * gap)).alias("RMSE"))
    return out.where("RMSE IS NOT NULL")


def compare_on_overlap(first: DataFrame, second: DataFrame, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """Score two prediction sets on the moments both cover."""
    on = [*keys, time]
    shared = first.select(*on).distinct().join(second.select(*on).distinct(), on, "inner")
    scored = [forecast_metrics(p.join(shared, on, "left_semi"), [*keys, "model_name"]) for p in (first, second)]
    return scored[0].unionByName(scored[1])


def top_features(importance: DataFrame, n: int = 15) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), "feature").limit(n)
