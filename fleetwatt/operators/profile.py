"""Aggregate views: profiles, distributions, correlations and key figures."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import as_column, is_weekend, weekday
from fleetwatt.functions.quantiles import exact_quantiles
from fleetwatt.operators.coerce import columns_starting
from fleetwatt.operators.features import show_date_range
from fleetwatt.operators.missing import stack_row

# Calendar names in calendar order.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def order_table(like: DataFrame, column: str, values: Sequence) -> DataFrame:
    """A small table that fixes which values appear and in what order."""
    spark = like.sparkSession
    kind = "int" if isinstance(values[0], int) else "string"
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"position int, `{column}` {kind}")


def describe(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column."""
    long = df.select(*[as_column(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "variable", "value")
    base = [
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    if approximate:
        q = F.percentile_approx("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10000)
        out = long.groupBy("variable").agg(*base, q.alias("_q"))
        return out.select("*", *[F.col("_q")[i].alias(n) for i, n in enumerate(["q25", "q50", "q75"])]).drop("_q")
    quart = exact_quantiles(long, ["variable"], "value", [0.25, 0.5, 0.75])
    wide = quart.groupBy("variable").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]]
    )
    return long.groupBy("variable").agg(*base).join(wide, "variable", "left")


def sample_skewness(c: str | Column) -> Column:
    """Bias-corrected skewness."""
    n = F.count(as_column(c)).cast("double")
    return F.when(n > 2, F.skewness(as_column(c)) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(c: str | Column) -> Column:
    """Bias-corrected excess kurtosis."""
    n = F.count(as_column(c)).cast("double")
    return F.when(n > 3, ((n + 1) * F.kurtosis(as_column(c)) + 6) * (n - 1) / ((n - 2) * (n - 3)))


def moments_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    long = df.unpivot([], list(cols), "variable", "value")
    return long.groupBy("variable").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        sample_skewness("value").alias("skewness"),
        sample_kurtosis("value").alias("kurtosis"),
    )


def hourly_profile(df: DataFrame, cols: Sequence[str], time: str = TIME) -> DataFrame:
    return df.groupBy(F.hour(time).alias("hour")).agg(*[F.avg(as_column(c)).alias(c) for c in cols])


def daytype_profile(df: DataFrame, value: str, time: str = TIME) -> DataFrame:
    """Mean by weekend flag and hour, all 48 rows present."""
    means = df.groupBy(is_weekend(time).alias("is_weekend"), F.hour(time).alias("hour")).agg(
        F.avg(as_column(value)).alias("mean")
    )
    spark = df.sparkSession
    frame = spark.range(24).select(
        F.explode(F.array(F.lit(False), F.lit(True))).alias("is_weekend"), F.col("id").cast("int").alias("hour")
    )
    return frame.join(means, ["is_weekend", "hour"], "left")


def month_hour_pivot(df: DataFrame, value: str, time: str = TIME) -> DataFrame:
    rows = df.select(F.month(time).alias("month"), F.hour(time).alias("_h"), as_column(value).alias("_v"))
    wide = rows.groupBy("month").pivot("_h", list(range(24))).agg(F.avg("_v"))
    return wide.select("month", *[F.col(f"`{h}`").alias(f"h{h:02d}") for h in range(24)])


def weekday_hour_pivot(df: DataFrame, value: str, time: str = TIME) -> DataFrame:
    """Weekday names in calendar order against hours; days without data stay as null rows."""
    rows = df.select(F.date_format(time, "EEEE").alias("day_name"), F.hour(time).alias("_h"), as_column(value).alias("_v"))
    wide = rows.groupBy("day_name").pivot("_h", list(range(24))).agg(F.avg("_v"))
    wide = wide.select("day_name", *[F.col(f"`{h}`").alias(f"h{h:02d}") for h in range(24)])
    return order_table(df, "day_name", DAY_NAMES).join(wide, "day_name", "left").orderBy("position")


def monthly_stats(df: DataFrame, value: str, time: str = TIME, digits: int = 3) -> DataFrame:
    """Mean, std, min and max per month (rounded) and the rounded amplitude."""
    stats = df.groupBy(F.month(time).alias("month")).agg(
        F.round(F.avg(as_column(value)), digits).alias("mean"),
        F.round(F.stddev_samp(as_column(value)), digits).alias("std"),
        F.round(F.min(as_column(value)), digits).alias("min"),
        F.round(F.max(as_column(value)), digits).alias("max"),
    )
    return stats.withColumn("amplitude", F.col("max") - F.col("min"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation in long form, one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]

    def both(a: str, b: str) -> Column:
        known = as_column(a).isNotNull() & as_column(b).isNotNull()
        return F.corr(F.when(known, as_column(a)), F.when(known, as_column(b)))

    row = df.agg(*[both(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            entries.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"_{i}").alias("corr")))
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def corr_target(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Mean, std and correlation with the target per feature, strongest first."""
    table = stack_row(
        df,
        "feature",
        {
            c: {
                "mean": F.avg(as_column(c)),
                "std": F.stddev_samp(as_column(c)),
                "correlation": F.corr(
                    F.when(as_column(target).isNotNull(), as_column(c)), F.when(as_column(c).isNotNull(), as_column(target))
                ),
            }
            for c in features
        },
    )
    return table.orderBy(F.col("correlation").desc(), "feature")


def _range(df: DataFrame, value: str) -> DataFrame:
    return df.agg(
        F.min(as_column(value)).alias("_lo"),
        F.max(as_column(value)).alias("_hi"),
        F.count(as_column(value)).alias("_n"),
        F.stddev_samp(as_column(value)).alias("_sd"),
    ).withColumn("_one", F.lit(1))


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins with their count and density; empty bins included."""
    stats = _range(df, value)
    rows = df.select(as_column(value).alias("_v"), F.lit(1).alias("_one")).where("_v IS NOT NULL")
    width = (F.col("_hi") - F.col("_lo")) / bins
    # the joined side is a single row
    placed = rows.join(F.broadcast(stats), "_one").withColumn(
        "bin", F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("_c"))
    frame = stats.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    count = F.coalesce(F.col("_c"), F.lit(0))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("left_edge"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("right_edge"),
        count.alias("count"),
        (count / (F.col("_n") * width)).alias("density"),
    )


def kde(df: DataFrame, value: str, bins: int = 50, points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian density curve over binned data with Scott's bandwidth.

    The rows are reduced to ``bins`` weighted centres first; each grid point then
    sums one array of that fixed length.
    """
    hist = histogram(df, value, bins).withColumn("_one", F.lit(1))
    centre = (F.col("left_edge") + F.col("right_edge")) / 2
    centres = hist.groupBy("_one").agg(
        F.array_sort(F.collect_list(F.struct("bin", centre.alias("at"), F.col("count").alias("weight")))).alias("_bins")
    )
    grid = (
        _range(df, value)
        .withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
        .join(F.broadcast(centres), "_one")
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    )
    lo, hi = F.col("_lo") - cut * F.col("_h"), F.col("_hi") + cut * F.col("_h")
    grid = grid.withColumn("x", lo + (hi - lo) * F.col("point") / (points - 1))
    total = F.aggregate(
        "_bins",
        F.lit(0.0),
        lambda acc, b: acc
        + b.getField("weight") * F.exp(-0.5 * F.pow((F.col("x") - b.getField("at")) / F.col("_h"), F.lit(2.0))),
    )
    return grid.select("point", "x", (total / (F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi))).alias("density"))


def boxplot_by_hour(df: DataFrame, value: str, time: str = TIME, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the last points inside the fences and outlier count per hour."""
    rows = df.select(F.hour(time).alias("hour"), as_column(value).alias("_v")).where("_v IS NOT NULL")
    long = exact_quantiles(rows, ["hour"], "_v", [0.25, 0.5, 0.75])
    quart = long.groupBy("hour").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in [(0.25, "q25"), (0.5, "median"), (0.75, "q75")]]
    )
    iqr = F.col("q75") - F.col("q25")
    inside = (F.col("_v") >= F.col("q25") - reach * iqr) & (F.col("_v") <= F.col("q75") + reach * iqr)
    # 24 rows at most on the joined side
    fenced = rows.join(F.broadcast(quart), "hour")
    return fenced.groupBy("hour", "q25", "median", "q75").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def totals(df: DataFrame, demand: str = "Demand", pv_prefix: str = "pv", time: str = TIME) -> DataFrame:
    pv = [F.coalesce(F.sum(as_column(c)), F.lit(0.0)) for c in columns_starting(df, pv_prefix)]
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(time).alias("start"),
        F.max(time).alias("end"),
        show_date_range(F.min(time), F.max(time)).alias("date_range"),
        F.coalesce(F.sum(as_column(demand)), F.lit(0.0)).alias("demand_sum"),
        (sum(pv, F.lit(0.0))).alias("pv_sum"),
    )


def _argmax(df: DataFrame, part: Column, value: str) -> DataFrame:
    """One row: the part with the highest mean; the lowest part on a tie."""
    means = df.groupBy(part.alias("_k")).agg(F.avg(as_column(value)).alias("_m")).where("_m IS NOT NULL")
    best = means.select(F.struct(F.col("_m").alias("m"), (-F.col("_k")).alias("k")).alias("_b")).agg(F.max("_b").alias("_b"))
    return best.select((-F.col("_b.k")).alias("k"), F.col("_b.m").alias("m"))


def energy_kpis(df: DataFrame, demand: str = "Demand", pv: str = "pv", time: str = TIME) -> DataFrame:
    """One row of key figures: peak hour, strongest month and weekday, PV shares, mean demand."""
    d, p, h = as_column(demand), as_column(pv), F.hour(time)
    midday = h.between(10, 16)
    base = df.agg(
        F.avg(d).alias("mean_demand"),
        (F.try_divide(F.sum(p), F.sum(d)) * 100).alias("pv_share_pct"),
        (F.try_divide(F.sum(F.when(midday, p)), F.sum(F.when(midday, d))) * 100).alias("midday_pv_share_pct"),
    ).withColumn("_one", F.lit(1))
    out = base
    for name, part in [("peak_hour", h), ("top_month", F.month(time)), ("top_weekday", weekday(time))]:
        best = _argmax(df, part, demand).select(F.col("k").alias(name), F.col("m").alias(f"{name}_mean"), F.lit(1).alias("_one"))
        out = out.join(F.broadcast(best), "_one")
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return out.withColumn("top_weekday_name", names[F.col("top_weekday")]).drop("_one")


def overview_kpis(metrics: DataFrame, costs: DataFrame) -> DataFrame:
    """Best model by mean RMSE, average RMSE, cost spread and accuracy percent."""
    known = F.when(F.col("RMSE_mean").isNotNull(), F.struct("RMSE_mean", "model_name", "nRMSE_mean"))
    best = metrics.agg(F.min(known).alias("_b"), F.avg("RMSE_mean").alias("average_rmse")).withColumn("_one", F.lit(1))
    spread = costs.agg(
        F.when(F.count("total_cost") >= 2, F.max("total_cost") - F.min("total_cost")).alias("cost_savings")
    ).withColumn("_one", F.lit(1))
    return best.join(F.broadcast(spread), "_one").select(
        F.col("_b.model_name").alias("best_model"),
        F.col("_b.RMSE_mean").alias("best_model_rmse"),
        "average_rmse",
        "cost_savings",
        F.greatest(F.lit(0.0), 100 - F.col("_b.nRMSE_mean") * 100).alias("forecast_accuracy"),
    )


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(as_column(column)).where(as_column(column).isNotNull()).distinct().orderBy(column)


def model_columns(df: DataFrame, reserved: Sequence[str] = (TIME, KEY, "Actual")) -> list[str]:
    return [c for c in df.columns if c not in reserved]


def _fact(priority: int, kind: str, subject: Column, value: Column, unit: str | None) -> Column:
    return F.struct(
        F.lit(priority).alias("priority"),
        F.lit(kind).alias("kind"),
        subject.cast("string").alias("subject"),
        value.cast("double").alias("value"),
        F.lit(unit).cast("string").alias("unit"),
    )


def insights(facts: Sequence[DataFrame], limit: int = 6) -> DataFrame:
    """Facts (``priority, kind, subject, value, unit``) in order, each kind and subject once.

    Facts without a value and a subject are left out; if none is left there is one row of
    kind ``none``.  Wording is the caller's.
    """
    merged = facts[0]
    for f in facts[1:]:
        merged = merged.unionByName(f)
    known = merged.where("value IS NOT NULL OR subject IS NOT NULL")
    once = known.groupBy("kind", "subject").agg(F.min(F.struct("priority", "value", "unit")).alias("_f"))
    rows = once.select("_f.priority", "kind", "subject", "_f.value", "_f.unit")
    none = rows.agg(F.count(F.lit(1)).alias("_n")).where("_n = 0")
    none = none.select(F.inline(F.array(_fact(0, "none", F.lit(None), F.lit(None), None))))
    return rows.unionByName(none).orderBy("priority", "kind", "subject").limit(limit)


def improvement_fact(improvements: DataFrame, priority: int = 1) -> DataFrame:
    """The largest gain of a variant over its base, if there is any."""
    best = F.max("nrmse_improvement_pct")
    return improvements.agg(F.when(best > 0, best).alias("_g")).select(
        F.inline(F.array(_fact(priority, "forecast_gain", F.lit(None), F.col("_g"), "%")))
    )


def cost_fact(costs: DataFrame, scenario: str, priority: int = 2) -> DataFrame:
    """Cost of one storage scenario; a profit is negative."""
    total = costs.agg(F.max(F.when(F.col("scenario") == scenario, F.col("total_cost"))).alias("_c"))
    subject = F.when(F.col("_c").isNotNull(), F.lit(scenario))
    return total.select(F.inline(F.array(_fact(priority, "scenario_cost", subject, F.col("_c"), "€"))))


def demand_facts(df: DataFrame, demand: str = "Demand", pv: str = "pv", time: str = TIME, start: int = 3) -> DataFrame:
    """What the cleaned data itself shows; room is left for a correlation between its facts."""
    cells = sum((as_column(c).isNull().cast("int") for c in df.columns), F.lit(0))
    missing = df.agg((F.sum(cells) / (F.count(F.lit(1)) * len(df.columns)) * 100).alias("_missing"))
    # one row on both sides
    k = energy_kpis(df, demand, pv, time).join(F.broadcast(missing))
    midday = F.when(F.col("midday_pv_share_pct") != 0, F.col("midday_pv_share_pct"))
    none = F.lit(None)
    facts = [
        _fact(start, "peak_hour", none, F.col("peak_hour"), "hour"),
        _fact(start + 1, "mean_demand", none, F.col("mean_demand"), "kWh"),
        _fact(start + 2, "pv_share", none, F.col("pv_share_pct"), "%"),
        _fact(start + 3, "missing", none, F.col("_missing"), "%"),
        _fact(start + 5, "midday_pv_share", none, midday, "%"),
        _fact(start + 6, "top_weekday", F.col("top_weekday_name"), none, None),
    ]
    return k.select(F.inline(F.array(*facts)))


def correlation_fact(ranked: DataFrame, priority: int = 7) -> DataFrame:
    best = ranked.agg(F.max_by("feature", "correlation").alias("_f"), F.max("correlation").alias("_c"))
    return best.select(F.inline(F.array(_fact(priority, "top_correlation", F.col("_f"), F.col("_c"), None))))


# The published coefficients of Acklam's inverse normal.
INVERSE_NORMAL = (
    (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00),
    (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01),
    (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00),
    (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00),
)


def normal_quantile(p: Column) -> Column:
    """Inverse normal by Acklam's rational approximation, |relative error| < 1.2e-9."""
    a, b, c, d = INVERSE_NORMAL

    def poly(coef: Sequence[float], x: Column) -> Column:
        out = F.lit(coef[0])
        for k in coef[1:]:
            out = out * x + k
        return out

    def tail(q: Column) -> Column:
        return poly(c, q) / (poly(d, q) * q + 1)

    q = p - 0.5
    r = q * q
    return (
        F.when(p < 0.02425, tail(F.sqrt(-2 * F.log(p))))
        .when(p > 1 - 0.02425, -tail(F.sqrt(-2 * F.log(1 - p))))
        .otherwise(poly(a, r) * q / (poly(b, r) * r + 1))
    )


def value_ranks(df: DataFrame, value: str, cells: int = 1024) -> DataFrame:
    """``value, copies, total, before``: each distinct value with the rows below it.

    Equal values merge map-side.  Approximate quantiles (at most ``cells`` numbers) cut the
    value range into even cells; each is numbered on its own and shifted by the rows below.
    """
    rows = df.select(as_column(value).cast("double").alias("value")).where("value IS NOT NULL")
    rows = rows.groupBy("value").agg(F.count(F.lit(1)).alias("copies"))
    cuts = rows.stat.approxQuantile("value", [i / cells for i in range(1, cells)], 0.25 / cells)
    splits = [-math.inf, *(sorted(set(cuts)) or [0.0]), math.inf]  # no values, no cuts
    placed = Bucketizer(splits=splits, inputCol="value", outputCol="_cell").transform(rows)
    sizes = placed.groupBy("_cell").agg(F.sum("copies").alias("_rows"))
    # one row per cell: at most `cells` rows in these windows and in the broadcast
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_cell", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"), F.sum("_rows").over(Window.partitionBy()).alias("total")
    )
    inside = Window.partitionBy("_cell").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(F.broadcast(offsets), "_cell").select(
        "value", "copies", "total", (F.col("_off") + F.coalesce(F.sum("copies").over(inside), F.lit(0))).alias("before")
    )


def qq_points(df: DataFrame, value: str, step: int = 100_000) -> DataFrame:
    """``rank, theoretical, ordered``: every value against its normal order-statistic median."""
    ranks = value_ranks(df, value)
    # copies of one value are spread in runs of `step` before they are listed
    first, last = F.col("before") + 1, F.col("before") + F.col("copies")
    runs = ranks.withColumn("_from", F.explode(F.sequence(first, last, F.lit(step).cast("long"))))
    runs = runs.withColumn("_to", F.least(F.col("_from") + (step - 1), last)).repartition("_from")
    points = runs.withColumn("rank", F.explode(F.sequence("_from", "_to")))
    n, i = F.col("total").cast("double"), F.col("rank").cast("double")
    end = F.pow(F.lit(0.5), 1 / n)
    median = F.when(i == 1, 1 - end).when(i == n, end).otherwise((i - 0.3175) / (n + 0.365))
    return points.select("rank", normal_quantile(median).alias("theoretical"), F.col("value").alias("ordered"))


def qq_line(points: DataFrame) -> DataFrame:
    """The least-squares line through Q-Q points."""
    return points.agg(
        F.regr_slope("ordered", "theoretical").alias("slope"),
        F.regr_intercept("ordered", "theoretical").alias("intercept"),
        F.corr("ordered", "theoretical").alias("r"),
        F.count(F.lit(1)).alias("points"),
    )
