"""Autocorrelation, stationarity and normality tests, and feature ranking."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import as_column
from fleetwatt.functions.leastsq import moments, solve, stack_arrays, unpack
from fleetwatt.functions.ordered import hash_rank, running_total, with_lags
from fleetwatt.operators.coerce import sample_per_group
from fleetwatt.operators.features import first_difference
from fleetwatt.operators.profile import normal_quantile, value_ranks
from fleetwatt.session import materialise

# MacKinnon's (1994, 2010) response surfaces for a unit-root test with a
# constant, and the KPSS (1992) level critical values with their probabilities.
ADF_SWITCH = -1.61
ADF_TOP, ADF_BOTTOM = 2.74, -18.83
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_CRITICAL_5 = (-2.86154, -2.8903, -4.234, -40.040)
KPSS_CRITICAL = (0.347, 0.463, 0.574, 0.739)
KPSS_P = (0.10, 0.05, 0.025, 0.01)


def centred(df: DataFrame, value: str = "value", keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Add ``_d``, the distance to the series mean, and ``_n``, the length of the series."""
    stats = df.groupBy(*keys).agg(F.avg(as_column(value)).alias("_mean"), F.count(as_column(value)).alias("_n"))
    return df.join(materialise(stats), list(keys), "left").withColumn("_d", as_column(value) - F.col("_mean"))


def autocovariance_sums(
    df: DataFrame, max_lag: int, value: str = "value", keys: Sequence[str] = (KEY,), time: str = TIME, freq: str = "hour"
) -> DataFrame:
    """``keys, lag, s, n``: sums of d(t)·d(t-lag) around the series mean, on a complete grid."""
    rows = centred(df, value, keys).select(*keys, time, "_d", "_n")
    # one product column per lag, added up in one hash aggregate: no row is multiplied
    rows = with_lags(rows, {f"_l{k}": ("_d", k) for k in range(max_lag + 1)}, keys, time, freq)
    products = [F.coalesce(F.sum(F.col("_d") * F.col(f"_l{k}")), F.lit(0.0)) for k in range(max_lag + 1)]
    sums = rows.groupBy(*keys).agg(F.array(*products).alias("_s"), F.max("_n").alias("n"), F.count(F.lit(1)).alias("_rows"))
    each = sums.select(*keys, "n", "_rows", F.posexplode("_s").alias("lag", "s"))
    return each.where("lag < _rows").select(*keys, "lag", "s", "n")


def acf(df: DataFrame, nlags: int = 48, value: str = "value", keys: Sequence[str] = (KEY,), time: str = TIME, freq: str = "hour") -> DataFrame:
    """``keys, lag, acf, band``; the 95 % band is ±1.96/√n.

    A constant series has no autocorrelation: null.
    """
    sums = autocovariance_sums(df, nlags, value, keys, time, freq)
    # nlags + 1 rows per series in this window
    s0 = F.max(F.when(F.col("lag") == 0, F.col("s"))).over(Window.partitionBy(*keys))
    return sums.select(*keys, "lag", F.try_divide(F.col("s"), s0).alias("acf"), (1.96 / F.sqrt("n")).alias("band"))


def durbin_levinson(r: Sequence[float]) -> list[float]:
    """Partial autocorrelations from autocorrelations, lag 0 included."""
    out, phi = [1.0], np.zeros(0)
    for k in range(1, len(r)):
        past = np.asarray(r[1:k], float)
        top = r[k] - float(phi @ past[::-1])
        below = 1.0 - float(phi @ past)
        last = top / below if below else float("nan")
        phi = np.append(phi - last * phi[::-1], last)
        out.append(float(last))
    return out


def pacf(df: DataFrame, nlags: int = 48, **kw) -> DataFrame:
    """``keys, lag, pacf``: Yule-Walker partial autocorrelations from the ``nlags`` values per series."""
    keys = list(kw.get("keys", (KEY,)))
    rows = acf(df, nlags, **kw)
    # nlags + 1 numbers per series
    per_series = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("lag", "acf"))).alias("_r"))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def partial(r: pd.Series) -> pd.Series:
        return r.map(lambda v: durbin_levinson([np.nan if x is None else x for x in v]))

    flat = per_series.select(*keys, partial(F.transform("_r", lambda p: p.getField("acf"))).alias("_p"))
    return flat.select(*keys, F.posexplode("_p").alias("lag", "pacf"))


def _adf_p(stat: float) -> float:
    if stat > ADF_TOP:
        return 1.0
    if stat < ADF_BOTTOM:
        return 0.0
    z = sum(c * stat**i for i, c in enumerate(ADF_SMALL_P if stat <= ADF_SWITCH else ADF_LARGE_P))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def adf(df: DataFrame, value: str = "value", key: str = KEY, time: str = TIME, freq: str = "hour") -> DataFrame:
    """Augmented Dickey-Fuller test with a constant; the lag order minimises AIC.

    ``key, statistic, p_value, used_lag, nobs, critical_5, status``.  Needs a complete grid.
    Every series of the input has a row: ``tested``, or nulls and ``too short`` (its
    readings leave no freedom for a regression) or ``constant``.
    """
    lengths = df.groupBy(key).agg(F.count(as_column(value)).alias("_n"))
    ceiling = F.least(F.ceil(12.0 * F.pow(F.col("_n") / 100.0, F.lit(0.25))), F.floor(F.col("_n") / 2) - 2)
    every = materialise(lengths.withColumn("_m", ceiling.cast("int")))
    lengths = every.where("_m >= 0")
    reach = lengths.agg(F.max("_m")).first()[0]
    if reach is None:
        none = {"statistic": "double", "p_value": "double", "used_lag": "int", "nobs": "long", "critical_5": "double"}
        return every.select(key, *[F.lit(None).cast(t).alias(c) for c, t in none.items()], F.lit("too short").alias("status"))
    rows = with_lags(df.select(key, time, as_column(value).alias("_v")), {}, [key], time, freq, past={"_y": ("_v", reach + 1)})
    rows = rows.join(lengths, key).where(F.size("_y") >= F.col("_m") + 2).select(key, F.slice("_y", 1, F.col("_m") + 2).alias("_y"))
    rows = rows.where(~F.exists("_y", lambda v: v.isNull()))
    part = T.StructType([df.schema[key]])

    def wide(pdf: pd.DataFrame):
        for name, g in pdf.groupby(key, sort=False):
            y = stack_arrays(g["_y"])
            dy = y[:, :-1] - y[:, 1:]
            yield (name,), np.column_stack([np.ones(len(y)), y[:, 1], dy[:, 1:]]), dy[:, 0]

    @F.pandas_udf("int")
    def best_lag(moment: pd.Series) -> pd.Series:
        def pick(m: np.ndarray) -> int:
            xtx, xty, yty, n = unpack(m)
            scored = []
            for lag in range(len(xtx) - 1):
                k = lag + 2
                ssr = max(yty - float(solve(xtx[:k, :k], xty[:k]) @ xty[:k]), 1e-300)
                scored.append((n * (math.log(2 * math.pi * ssr / n) + 1) + 2 * k, lag))
            return min(scored)[1]

        return moment.map(pick)

    chosen = materialise(moments(rows, part, wide).select(key, best_lag("moment").alias("used_lag")))
    again = with_lags(df.select(key, time, as_column(value).alias("_v")), {}, [key], time, freq, past={"_y": ("_v", reach + 1)})
    again = again.join(chosen, key).where(F.size("_y") >= F.col("used_lag") + 2)
    again = again.select(key, F.slice("_y", 1, F.col("used_lag") + 2).alias("_y"))
    again = again.where(~F.exists("_y", lambda v: v.isNull()))

    @F.pandas_udf("statistic double, p_value double, used_lag int, nobs long, critical_5 double")
    def test(moment: pd.Series) -> pd.DataFrame:
        rows = []
        for m in moment:
            xtx, xty, yty, n = unpack(m)
            k = len(xtx)
            beta = solve(xtx, xty)
            ssr = max(yty - float(beta @ xty), 0.0)
            spread = np.linalg.pinv(xtx)[1, 1] * ssr / max(n - k, 1)
            stat = float(beta[1] / math.sqrt(spread)) if spread > 0 else None
            crit = sum(c / n**i for i, c in enumerate(ADF_CRITICAL_5))
            rows.append((stat, None if stat is None else _adf_p(stat), k - 2, n, crit))
        return pd.DataFrame(rows, columns=["statistic", "p_value", "used_lag", "nobs", "critical_5"])

    tested = moments(again, part, wide).select(key, test("moment").alias("_t")).select(F.col(key).alias("_key"), "_t.*")
    status = F.when(F.col("_key").isNull(), F.lit("too short")).when(F.col("statistic").isNull(), F.lit("constant")).otherwise(F.lit("tested"))
    found = every.join(tested, as_column(key).eqNullSafe(F.col("_key")), "left")
    return found.select(key, "statistic", "p_value", "used_lag", "nobs", "critical_5", status.alias("status"))


def kpss(
    df: DataFrame, value: str = "value", key: str = KEY, time: str = TIME, freq: str = "hour", lags: int | None = None
) -> DataFrame:
    """KPSS level test; without ``lags`` the Hobijn et al. automatic bandwidth.

    ``key, statistic, p_value, used_lag, critical_5``.
    """
    n = F.col("n").cast("double")
    if lags is None:
        longest = df.groupBy(key).count().agg(F.max("count")).first()[0] or 1
        first = autocovariance_sums(df, int(longest ** (2 / 9)), value, [key], time, freq)
        inside = (F.col("lag") >= 1) & (F.col("lag") <= F.floor(F.pow(n, F.lit(2 / 9))))
        share = F.when(inside, F.col("s") / (n / 2)).otherwise(F.lit(0.0))
        s0 = F.sum(F.when(F.col("lag") == 0, F.col("s") / n).otherwise(share))
        s1 = F.sum(F.col("lag") * share)
        width = first.groupBy(key).agg(F.max(n).alias("n"), F.try_divide(s1, s0).alias("_s"))
        gamma = 1.1447 * F.pow(F.col("_s") * F.col("_s"), F.lit(1 / 3))
        width = materialise(width.select(
            key, F.coalesce(F.least(F.floor(gamma * F.pow(n, F.lit(1 / 3))), n - 1), F.lit(0)).cast("int").alias("used_lag")
        ))
        most = width.agg(F.max("used_lag")).first()[0] or 0
    else:
        width = df.select(key).distinct().withColumn("used_lag", F.lit(lags))
        most = lags
    sums = autocovariance_sums(df, most, value, [key], time, freq).join(width, key)
    bartlett = 2 * (1 - F.col("lag") / (F.col("used_lag") + 1.0))
    weight = F.when(F.col("lag") == 0, 1.0).when(F.col("lag") <= F.col("used_lag"), bartlett).otherwise(0.0)
    long_run = sums.groupBy(key).agg(
        F.sum(weight * F.col("s") / n).alias("_s2"), F.max("used_lag").alias("used_lag"), F.max(n).alias("_n")
    )
    walked = running_total(centred(df, value, [key]), {"_walk": F.col("_d")}, [key], time)
    eta = walked.groupBy(key).agg(F.sum(F.col("_walk") * F.col("_walk")).alias("_eta"))
    stat = F.try_divide(F.col("_eta") / (F.col("_n") * F.col("_n")), F.col("_s2"))
    out = long_run.join(eta, key).select(key, stat.alias("statistic"), "used_lag")
    p: Column = F.when(F.col("statistic") <= KPSS_CRITICAL[0], KPSS_P[0])
    for (c0, p0), (c1, p1) in zip(zip(KPSS_CRITICAL, KPSS_P), zip(KPSS_CRITICAL[1:], KPSS_P[1:])):
        p = p.when(F.col("statistic") <= c1, p0 + (p1 - p0) * (F.col("statistic") - c0) / (c1 - c0))
    p = p.when(F.col("statistic").isNotNull(), KPSS_P[-1])
    return out.withColumns({"p_value": p, "critical_5": F.lit(KPSS_CRITICAL[1])})


def stationarity(df: DataFrame, value: str = "value", key: str = KEY, time: str = TIME, freq: str = "hour") -> DataFrame:
    """ADF and KPSS on the series and on its first difference, with a verdict each."""

    def both(rows: DataFrame, label: str) -> DataFrame:
        cols = [key, "statistic", "p_value", "critical_5"]
        a = adf(rows, value, key, time, freq).select(*cols, F.lit("ADF").alias("test"), (F.col("p_value") < 0.05).alias("_ok"))
        k = kpss(rows, value, key, time, freq).select(*cols, F.lit("KPSS").alias("test"), (F.col("p_value") > 0.05).alias("_ok"))
        return a.unionByName(k).withColumn("series", F.lit(label))

    out = both(df, "Original").unionByName(both(first_difference(df, value, [key], time, freq), "Differenced"))
    verdict = F.when(F.col("_ok"), F.lit("Stationary")).otherwise(F.lit("Non-Stationary"))
    return out.withColumn("conclusion", F.when(F.col("_ok").isNotNull(), verdict)).drop("_ok")


def seasonality_strength(df: DataFrame, by: Sequence[str], resid: str = "resid", components: Sequence[str] = ("seasonal", "trend")) -> DataFrame:
    """clip(1 − Var(R)/Var(R+C), 0, 1) per group and component; null where R+C is constant."""
    r = as_column(resid)
    aggregates = []
    for c in components:
        whole = F.var_pop(r + as_column(c))
        ratio = 1 - F.var_pop(r) / F.when(whole > 1e-8, whole)
        strength = F.when(ratio.isNotNull(), F.least(F.greatest(ratio, F.lit(0.0)), F.lit(1.0)))
        aggregates.append(strength.alias(c))
    wide = df.groupBy(*by).agg(*aggregates)
    return wide.unpivot(list(by), list(components), "strength_type", "value").where("value IS NOT NULL")


def strength_pivot(df: DataFrame, by: str, order: Sequence[str], types: Sequence[str] = ("seasonal", "trend")) -> DataFrame:
    """Groups in a fixed order against strength types, zero where there is none."""
    frame = df.sparkSession.createDataFrame([(i, p) for i, p in enumerate(order)], f"position int, `{by}` string")
    wide = df.groupBy(by).pivot("strength_type", list(types)).agg(F.avg("value"))
    return frame.join(wide, by, "left").na.fill(0.0, list(types)).orderBy("position")


#: Fixed value: the largest sample that the approximation of Shapiro-Wilk is made for.
SHAPIRO_WILK_MOST = 5000


def shapiro_wilk(x: np.ndarray) -> tuple[float | None, float | None]:
    """Royston's (1995) approximation for 3 to 5000 values."""
    x = np.sort(x)
    n = len(x)
    if n < 3 or x[0] == x[-1]:
        return None, None
    inv = NormalDist().inv_cdf
    m = np.array([inv((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    ss, u = float(m @ m), 1 / math.sqrt(n)
    # Royston's published polynomials, lowest power first.
    c1 = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
    c2 = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)

    def poly(c: Sequence[float], v: float) -> float:
        return float(sum(k * v**i for i, k in enumerate(c)))

    a = m / math.sqrt(ss)
    if n == 3:
        a = np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    else:
        outer = poly(c1, u) + m[-1] / math.sqrt(ss)
        if n > 5:
            second = poly(c2, u) + m[-2] / math.sqrt(ss)
            phi = (ss - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * outer**2 - 2 * second**2)
            a = m / math.sqrt(phi)
            a[1], a[-2] = -second, second
        else:
            phi = (ss - 2 * m[-1] ** 2) / (1 - 2 * outer**2)
            a = m / math.sqrt(phi)
        a[0], a[-1] = -outer, outer
    w = min(float(a @ x) ** 2 / float(((x - x.mean()) ** 2).sum()), 1.0)
    if n == 3:
        return w, max(6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))), 0.0)
    if w >= 1.0:
        return w, 1.0
    if n <= 11:
        g = -2.273 + 0.459 * n
        y = -math.log(g - math.log(1 - w)) if g > math.log(1 - w) else math.inf
        mu, sd = poly((0.5440, -0.39978, 0.025054, -6.714e-4), n), math.exp(poly((1.3822, -0.77857, 0.062767, -0.0020322), n))
    else:
        y, ln = math.log(1 - w), math.log(n)
        mu, sd = poly((-1.5861, -0.31082, -0.083751, 0.0038915), ln), math.exp(poly((-0.4803, -0.082676, 0.0030302), ln))
    return w, 0.5 * math.erfc((y - mu) / sd / math.sqrt(2))


def normality(df: DataFrame, cols: Sequence[str], identity: Sequence[str], sample: int = SHAPIRO_WILK_MOST, seed: int = 42) -> DataFrame:
    """Shapiro-Wilk per variable on a reproducible sample of at most ``sample`` values.

    The approximation holds up to 5,000 values; a larger sample is an error, for all rows
    see ``shapiro_francia``.
    """
    if sample > SHAPIRO_WILK_MOST:
        raise ValueError(f"Shapiro-Wilk takes at most {SHAPIRO_WILK_MOST} values, not {sample}; shapiro_francia takes all rows")
    long = df.unpivot(list(identity), list(cols), "variable", "value").where("value IS NOT NULL")
    drawn = sample_per_group(long, sample, ["variable"], [*identity, "variable"], seed)

    def run(name: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        w, p = shapiro_wilk(pdf["value"].to_numpy(float))
        return pd.DataFrame([(name[0], len(pdf), w, p)], columns=["variable", "n", "statistic", "p_value"])

    out = drawn.select("variable", "value").groupBy("variable").applyInPandas(
        run, "variable string, n long, statistic double, p_value double"
    )
    return out.withColumn("normal", F.col("p_value") > 0.05)


def mutual_information(df: DataFrame, target: str, features: Sequence[str], bins: int = 16) -> DataFrame:
    """Σ p·ln(p/(pₓ·p_y)) over equal-width bins, per feature, highest first.

    Only bin counts (``bins²`` per feature) are ever shuffled.
    """
    rows = df.select(as_column(target).cast("double").alias("_y"), *[as_column(c).cast("double").alias(c) for c in features])
    long = rows.unpivot(["_y"], list(features), "feature", "_x").where("_x IS NOT NULL AND _y IS NOT NULL")
    ranges = long.groupBy("feature").agg(
        F.min("_x").alias("_x0"), F.max("_x").alias("_x1"), F.min("_y").alias("_y0"), F.max("_y").alias("_y1")
    )

    def place(v: str, lo: str, hi: str) -> Column:
        share = (F.col(v) - F.col(lo)) / (F.col(hi) - F.col(lo))
        return F.when(F.col(hi) > F.col(lo), F.least(F.floor(share * bins), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")

    # one row per feature: bounded by the column count
    placed = long.join(F.broadcast(ranges), "feature")
    joint = placed.groupBy("feature", place("_x", "_x0", "_x1").alias("bx"), place("_y", "_y0", "_y1").alias("by")).agg(
        F.count(F.lit(1)).cast("double").alias("c")
    )
    mx = joint.groupBy("feature", "bx").agg(F.sum("c").alias("cx"))
    my = joint.groupBy("feature", "by").agg(F.sum("c").alias("cy"))
    all_ = joint.groupBy("feature").agg(F.sum("c").alias("n"))
    table = joint.join(mx, ["feature", "bx"]).join(my, ["feature", "by"]).join(all_, "feature")
    term = F.col("c") / F.col("n") * F.log(F.col("c") * F.col("n") / (F.col("cx") * F.col("cy")))
    return table.groupBy("feature").agg(F.sum(term).alias("mutual_information")).orderBy(
        F.col("mutual_information").desc(), "feature"
    )


def permutation_importance(
    df: DataFrame,
    target: str,
    features: Sequence[str],
    identity: Sequence[str],
    trees: int = 80,
    repeats: int = 3,
    depth: int = 8,
    seed: int = 42,
) -> DataFrame:
    """Mean drop in R² when one feature is shuffled, from a random forest.

    A repeat pairs every row with a random other row by joining two hash orders; each
    feature in turn is then taken from the partner, all in one pass.
    """
    cols = [*features, target]
    rows = df.select(*identity, *[as_column(c).cast("double").alias(c) for c in cols]).na.drop(subset=cols)
    rows = rows.withColumn("_x", F.array(*[as_column(c) for c in features]))
    forest = RandomForestRegressor(featuresCol="_vec", labelCol=target, numTrees=trees, maxDepth=depth, seed=seed)
    data = rows.withColumn("_vec", array_to_vector("_x"))
    model = forest.fit(data)
    moments_ = data.agg(F.avg(as_column(target)).alias("_my"))
    scored = model.transform(data).withColumn("_one", F.lit(1)).join(F.broadcast(moments_.withColumn("_one", F.lit(1))), "_one")
    y = as_column(target)
    base = scored.agg(
        (1 - F.sum(F.pow(y - F.col("prediction"), F.lit(2.0))) / F.sum(F.pow(y - F.col("_my"), F.lit(2.0)))).alias("_r2"),
        F.sum(F.pow(y - F.col("_my"), F.lit(2.0))).alias("_sst"),
    ).withColumn("_one", F.lit(1))
    drops = None
    for r in range(repeats):
        a = hash_rank(rows, F.xxhash64(F.lit(seed + 2 * r), *[as_column(c) for c in identity]), "_r")
        b = hash_rank(rows, F.xxhash64(F.lit(seed + 2 * r + 1), *[as_column(c) for c in identity]), "_r")
        pairs = a.select("_r", y.alias("_y"), "_x").join(b.select("_r", F.col("_x").alias("_z")), "_r")
        swapped = pairs.select(
            "_y",
            F.posexplode(
                F.array(
                    *[
                        F.array(*[(F.col("_z") if i == j else F.col("_x"))[j] for j in range(len(features))])
                        for i in range(len(features))
                    ]
                )
            ).alias("_f", "_swap"),
        ).withColumn("_vec", array_to_vector("_swap"))
        sse = model.transform(swapped).groupBy("_f").agg(F.sum(F.pow(F.col("_y") - F.col("prediction"), F.lit(2.0))).alias("_sse"))
        drops = sse if drops is None else drops.unionByName(sse)
    names = F.array(*[F.lit(c) for c in features])
    out = drops.withColumn("_one", F.lit(1)).join(F.broadcast(base), "_one")
    out = out.withColumn("_drop", F.col("_r2") - (1 - F.col("_sse") / F.col("_sst")))
    return out.groupBy(names[F.col("_f")].alias("feature")).agg(F.avg("_drop").alias("permutation")).orderBy(
        F.col("permutation").desc(), "feature"
    )


def ranking_combined(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two rankings side by side, every feature of either kept."""
    return first.join(second, "feature", "full_outer")


def shapiro_francia(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Shapiro-Francia test of every variable over all its rows: ``variable, n, statistic, p_value, normal``.

    The statistic is the squared correlation of the values with normal order-statistic
    scores of their ranks (i - 3/8) / (n + 1/4).  Equal values are one row with their
    number of copies up to the scores, whose sums over a run of copies are taken in
    pieces, so no value is listed in one task and no column is sorted in one.  The p value
    is Royston's (1993) normal approximation in log n.  Null values are left out; under
    five values, or equal ones only, there is no statistic.
    """
    parts = [_francia(df, c) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _francia(df: DataFrame, name: str, step: int = 100_000) -> DataFrame:
    ranks = value_ranks(df, name)
    first, last = F.col("before") + 1, F.col("before") + F.col("copies")
    runs = ranks.withColumn("_from", F.explode(F.sequence(first, last, F.lit(step).cast("long"))))
    runs = runs.withColumn("_to", F.least(F.col("_from") + (step - 1), last)).repartition("_from")
    scored = runs.withColumn("_i", F.explode(F.sequence("_from", "_to")))
    z = normal_quantile((F.col("_i") - 0.375) / (F.col("total") + 0.25))
    # var_pop of equal values can miss zero by rounding, so the range decides
    spread = F.when(F.max("value") > F.min("value"), F.var_pop("value") * F.var_pop("_z"))
    r2 = F.try_divide(F.pow(F.covar_pop("value", "_z"), F.lit(2.0)), spread)
    sums = scored.select("value", z.alias("_z")).agg(r2.alias("_r2"), F.count(F.lit(1)).alias("n"))
    n = F.col("n").cast("double")
    w = F.when((F.col("n") >= 5) & F.col("_r2").isNotNull() & ~F.isnan("_r2"), F.least("_r2", F.lit(1.0)))
    u = F.log(n)
    v = F.log(u)
    # Royston's published coefficients.
    mu = -1.2725 + 1.0521 * (v - u)
    sd = 1.0308 - 0.26758 * (v + 2.0 / u)
    z_of_w = (F.log(1 - F.col("statistic")) - mu) / sd
    out = sums.select(F.lit(name).alias("variable"), "n", w.alias("statistic"))
    out = out.withColumn("p_value", F.when(F.col("statistic") >= 1, F.lit(1.0)).otherwise(1 - normal_probability(z_of_w)))
    return out.withColumn("normal", F.col("p_value") > 0.05)


def normal_probability(z: Column) -> Column:
    """The standard normal distribution function, within 1e-7 (Abramowitz and Stegun 26.2.17)."""
    # The published coefficients, lowest power first.
    b = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    t = 1 / (1 + 0.2316419 * F.abs(z))
    tail = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * sum((k * F.pow(t, F.lit(float(i + 1))) for i, k in enumerate(b)), F.lit(0.0))
    return F.when(z >= 0, 1 - tail).otherwise(tail)
