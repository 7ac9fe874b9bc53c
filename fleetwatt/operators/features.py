"""Calendar, weather and lag features, and display formatting."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import as_column, is_weekend, naive, weekday
from fleetwatt.functions.ordered import with_lags
from fleetwatt.operators.coerce import coerce_numeric, normalise_time, resolve_features, resolve_target

# The balance temperature of degree features, the lags of the
# autoregressive feature set, the tariff ratio and the feature groups.
BASE_TEMPERATURE = 18.0
LAGS = (1, 2, 3, 24, 48)
SELL_RATIO = 0.5
TIME_FEATURES = ("hour", "dayofweek", "is_weekend", "hour_sin", "hour_cos")


def calendar_features(df: DataFrame, time: str = TIME) -> DataFrame:
    return df.withColumns(
        {
            "hour": F.hour(time),
            "dayofweek": weekday(time),
            "day_name": F.date_format(time, "EEEE"),
            "month": F.month(time),
            "month_name": F.date_format(time, "MMMM"),
            "month_abbr": F.date_format(time, "MMM"),
            "day": naive(F.date_trunc("day", F.col(time))),
            "is_weekend": is_weekend(time).cast("int"),
        }
    )


def cyclic_features(df: DataFrame, time: str = TIME) -> DataFrame:
    angle = F.hour(time) * F.lit(2 * math.pi / 24)
    return df.withColumns({"hour_sin": F.sin(angle), "hour_cos": F.cos(angle)})


def degree_features(
    df: DataFrame, temperature: str = "Temperature", radiation: str = "radiation", base: float = BASE_TEMPERATURE
) -> DataFrame:
    t = as_column(temperature)

    def above_zero(e: Column) -> Column:
        return F.when(e < 0, F.lit(0.0)).otherwise(e)

    return df.withColumns(
        {
            "cooling_degree": above_zero(t - base),
            "heating_degree": above_zero(F.lit(base) - t),
            "temp_irradiance_interaction": t * as_column(radiation),
        }
    )


def lag_features(
    df: DataFrame, target: str, lags: Sequence[int] = LAGS, keys: Sequence[str] = (KEY,), time: str = TIME, freq: str = "hour"
) -> DataFrame:
    """``<target>_lag_<k>`` columns; needs a complete grid (see ``resample``)."""
    return with_lags(df, {f"{target.lower()}_lag_{k}": (target, k) for k in lags}, keys, time, freq)


def first_difference(
    df: DataFrame, value: str = "value", keys: Sequence[str] = (KEY,), time: str = TIME, freq: str = "hour"
) -> DataFrame:
    """The change from one slot to the next, without the first row."""
    rows = with_lags(df, {"_back": (value, 1)}, keys, time, freq)
    return rows.withColumn(value, F.col(value) - F.col("_back")).drop("_back").where(F.col(value).isNotNull())


def feature_table(
    df: DataFrame, target: str, raw: Sequence[str], keys: Sequence[str] = (KEY,), time: str = TIME, **weather: str
) -> DataFrame:
    """Target, six engineered columns and the raw signals."""
    rows = degree_features(cyclic_features(df, time), **weather).withColumn("is_weekend", is_weekend(time).cast("int"))
    return rows.select(
        *keys,
        time,
        as_column(target),
        "hour_sin",
        "hour_cos",
        "is_weekend",
        "cooling_degree",
        "heating_degree",
        "temp_irradiance_interaction",
        *[as_column(c) for c in raw],
    )


def tariffs(df: DataFrame, price: str = "Price", sell_ratio: float = SELL_RATIO) -> DataFrame:
    return df.withColumns({"price_buy": as_column(price), "price_sell": as_column(price) * sell_ratio})


def feature_category(c: str | Column) -> Column:
    c = as_column(c)
    return (
        F.when(c.contains("demand_lag"), F.lit("Autoregressive"))
        .when(c.isin(*TIME_FEATURES), F.lit("Time"))
        .otherwise(F.lit("Exogenous"))
    )


def _fixed_digits(digits: int):
    # the JVM formats the shortest decimal form half-up; text must round the stored
    # binary value instead, so 1.45 (stored just below) shows as 1.4
    @F.pandas_udf("string")
    def shown(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if pd.isna(v) else f"{v:.{digits}f}")

    return shown


def show_number(c: str | Column, digits: int = 2, suffix: str = "", percent: bool = False) -> Column:
    """Rounded text with a suffix, ``--`` for null."""
    text = _fixed_digits(digits)(as_column(c).cast("double"))
    return F.coalesce(F.concat(text, F.lit("%" if percent else suffix)), F.lit("--"))


def show_thousands(c: str | Column, digits: int = 0) -> Column:
    return F.coalesce(F.format_number(as_column(c).cast("double"), digits), F.lit("--"))


def show_date_range(lo: str | Column, hi: str | Column) -> Column:
    text = F.concat(F.date_format(as_column(lo), "yyyy-MM-dd"), F.lit(" → "), F.date_format(as_column(hi), "yyyy-MM-dd"))
    return F.coalesce(text, F.lit("--"))


def safe_name(c: str | Column) -> Column:
    """Lower case with blanks, slashes and brackets as underscores."""
    return F.regexp_replace(F.lower(as_column(c)), r"[ /()]+", "_")


def ml_dataset(
    df: DataFrame,
    target: str,
    features: Sequence[str] | None = None,
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
    drop_null: bool = True,
) -> DataFrame:
    """``keys, time, label, features`` (vector), numeric and null-free."""
    target = resolve_target(df, target)
    features = resolve_features(df, target, features)
    rows = coerce_numeric(normalise_time(df, time), [target, *features])
    rows = rows.select(*keys, time, as_column(target).alias("label"), *[as_column(c).alias(f"_f{i}") for i, c in enumerate(features)])
    names = [f"_f{i}" for i in range(len(features))]
    if drop_null:
        rows = rows.na.drop(subset=["label", *names])
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error")
    return assembler.transform(rows).select(*keys, time, "label", "features")


def yeo_johnson(c: str | Column, lam: float | Column) -> Column:
    """The power transform at a given lambda."""
    x = as_column(c)
    lam = F.lit(float(lam)) if isinstance(lam, (int, float)) else lam
    two = F.lit(2.0) - lam
    positive = F.when(lam == 0, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / lam)
    negative = F.when(lam == 2, -F.log1p(-x)).otherwise(-(F.pow(1 - x, two) - 1) / two)
    return F.when(x >= 0, positive).when(x < 0, negative)


def yeo_johnson_scores(df: DataFrame, cols: Sequence[str], grid: Sequence[float] | dict[str, Sequence[float]]) -> DataFrame:
    """``variable, lambda, score``: the profile log-likelihood on a lambda grid, one pass.

    ``grid`` may give each column its own points.
    """
    grids = grid if isinstance(grid, dict) else dict.fromkeys(cols, grid)
    points = F.lit(None).cast("array<double>")
    for c, values in grids.items():
        points = F.when(F.col("variable") == c, F.array(*[F.lit(float(g)) for g in values])).otherwise(points)
    long = df.unpivot([], list(cols), "variable", "_x").where("_x IS NOT NULL")
    tried = long.withColumn("lambda", F.explode(points))
    tried = tried.withColumn("_y", yeo_johnson("_x", F.col("lambda")))
    jacobian = F.signum("_x") * F.log1p(F.abs("_x"))
    return tried.groupBy("variable", "lambda").agg(
        (F.count("_y") * -0.5 * F.log(F.var_pop("_y")) + (F.max("lambda") - 1) * F.sum(jacobian)).alias("score")
    )


def yeo_johnson_lambda(df: DataFrame, cols: Sequence[str], lo: float = -3.0, hi: float = 3.0, steps: int = 25, passes: int = 3) -> dict[str, float]:
    """The likeliest lambda per column: a coarse grid, then finer ones around its best point.

    All columns are scored in the same pass; ``steps`` numbers a column come back.  A column
    without values has no entry.
    """
    best: dict[str, float] = {}
    spans = dict.fromkeys(cols, (lo, hi))
    for _ in range(passes):
        grids = {c: [a + (b - a) * i / (steps - 1) for i in range(steps)] for c, (a, b) in spans.items()}
        scored = yeo_johnson_scores(df, cols, grids).groupBy("variable").agg(F.max_by("lambda", "score").alias("lambda"))
        best = {r["variable"]: r["lambda"] for r in scored.collect() if r["lambda"] is not None}
        width = {c: (b - a) / (steps - 1) for c, (a, b) in spans.items()}
        spans = {c: (v - width[c], v + width[c]) for c, v in best.items()}
        cols = list(spans)
        if not cols:
            break
    return best
