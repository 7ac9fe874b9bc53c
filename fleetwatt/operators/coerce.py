"""Typing, filtering and selecting rows and columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import as_column, naive
from fleetwatt.functions.ordered import newest
from fleetwatt.session import materialise


def parse_time(c: str | Column) -> Column:
    """Text or timestamp to a naive UTC timestamp; null if unreadable."""
    return naive(F.try_to_timestamp(as_column(c).cast("string")))


def normalise_time(df: DataFrame, time: str = TIME) -> DataFrame:
    """Readable moments only, as naive UTC."""
    parsed = parse_time(time) if isinstance(df.schema[time].dataType, T.StringType) else naive(time)
    return df.withColumn(time, parsed).where(F.col(time).isNotNull())


def to_number(c: str | Column) -> Column:
    """A double, or null for text that is no number and for NaN."""
    return F.nanvl(as_column(c).try_cast("double"), F.lit(None).cast("double"))


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: to_number(c) for c in cols if c in df.columns})


def text_columns_with_numbers(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    """Text columns in which at least one value reads as a number (one aggregate)."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]
    if not text:
        return []
    row = df.agg(*[F.count(to_number(c)).alias(f"c{i}") for i, c in enumerate(text)]).first()
    return [c for i, c in enumerate(text) if row[i] > 0]


def numeric_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    skipped = set(skip)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skipped]


def columns_like(df: DataFrame, keywords: Sequence[str]) -> list[str]:
    """Columns whose name contains a keyword, keyword by keyword, each once."""
    found = [c for k in keywords for c in df.columns if k.lower() in c.lower()]
    return list(dict.fromkeys(found))


def columns_starting(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.lower().startswith(prefix.lower())]


def resolve_target(df: DataFrame, target: str) -> str:
    """The column of that name, else the one that differs only in case."""
    if target in df.columns:
        return target
    match = [c for c in df.columns if c.lower() == target.lower()]
    if not match:
        raise ValueError(f"no column {target!r} among {df.columns}")
    return match[0]


def resolve_features(
    df: DataFrame, target: str, wanted: Sequence[str] | None = None, also_in: DataFrame | None = None
) -> list[str]:
    """The wanted columns (all must exist), or every numeric column but the target,
    kept to those another table has as well."""
    if wanted is not None:
        missing = [c for c in wanted if c not in df.columns]
        if missing:
            raise ValueError(f"missing feature columns: {missing}")
        return list(wanted)
    found = numeric_columns(df, skip=[target])
    if also_in is not None:
        other = set(numeric_columns(also_in))
        found = [c for c in found if c in other]
    return found


def clip_negative(c: str | Column) -> Column:
    c = as_column(c)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(subset))


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop(how="all")


def dedup_first(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = (KEY,), time: str = TIME
) -> DataFrame:
    """One row per moment: the first in ``order``.

    A minimum over a struct merges map-side, so any number of copies of one
    moment reaches the reducer as one row per task.
    """
    group = [*keys, time]
    rest = [c for c in df.columns if c not in group and c not in order]
    picked = F.min_by(F.struct(*[as_column(c) for c in [*order, *rest]]), F.struct(*[as_column(c) for c in order]))
    merged = df.groupBy(*group).agg(picked.alias("_row"))
    return merged.select(
        *[as_column(c) if c in group else F.col("_row").getField(c).alias(c) for c in df.columns]
    )


def time_range(
    df: DataFrame, start: str | dt.datetime | None = None, end: str | dt.datetime | None = None, time: str = TIME
) -> DataFrame:
    """Closed range; either end may be open."""
    if start is not None:
        df = df.where(F.col(time) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(F.col(time) <= F.lit(end).cast("timestamp_ntz"))
    return df


def date_slice(df: DataFrame, first: str, last: str, time: str = TIME) -> DataFrame:
    """Whole days from ``first`` up to and including ``last``."""
    stop = dt.date.fromisoformat(last) + dt.timedelta(days=1)
    return df.where(
        (F.col(time) >= F.lit(first).cast("timestamp_ntz"))
        & (F.col(time) < F.lit(stop.isoformat()).cast("timestamp_ntz"))
    )


def last_days(df: DataFrame, days: int, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    """Rows not older than ``days`` before the newest row of their series."""
    ends = materialise(df.groupBy(*keys).agg(F.max(time).alias("_end")))
    return (
        df.join(ends, list(keys), "inner")
        .where(F.col(time) >= F.col("_end") - F.expr(f"INTERVAL {int(days)} DAY"))
        .drop("_end")
    )


def last_rows(df: DataFrame, n: int, keys: Sequence[str] = (KEY,), time: str = TIME) -> DataFrame:
    return newest(df, n, keys, time)


def with_fallback(df: DataFrame, column: str, choices: Sequence[str]) -> DataFrame:
    """Rows of the first choice that has any; every row if none has."""
    tier = F.lit(len(choices))
    for i, choice in reversed(list(enumerate(choices))):
        tier = F.when(F.col(column) == choice, F.lit(i)).otherwise(tier)
    ranked = df.withColumn("_tier", tier)
    best = ranked.agg(F.min("_tier").alias("_best"))
    # one row: the join only carries a scalar
    return ranked.join(F.broadcast(best), F.col("_tier") == F.col("_best"), "inner").drop("_tier", "_best")


def sample_head(
    df: DataFrame, cols: Sequence[str], n: int = 10, digits: int = 3, order: Sequence[str] = (TIME,)
) -> DataFrame:
    """The first rows of a table, for display."""
    shown = [
        F.round(as_column(c), digits).alias(c) if isinstance(df.schema[c].dataType, T.DoubleType) else as_column(c)
        for c in cols
    ]
    return df.orderBy(*order).limit(n).select(*shown)


def sample_rows(df: DataFrame, n: int, identity: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, the same ones on every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), *[as_column(c) for c in identity]), *identity).limit(n)


def sample_per_group(
    df: DataFrame, n: int, group: Sequence[str], identity: Sequence[str], seed: int = 42, salts: int = 256
) -> DataFrame:
    """``n`` rows of every group; each salted part of a group first keeps its own ``n``."""
    h = F.xxhash64(F.lit(seed), *[as_column(c) for c in identity])
    rows = df.withColumn("_h", h).withColumn("_salt", F.pmod(F.col("_h"), F.lit(salts)))
    order = ["_h", *identity]
    part = Window.partitionBy(*group, "_salt").orderBy(*order)
    whole = Window.partitionBy(*group).orderBy(*order)
    return (
        rows.withColumn("_rn", F.row_number().over(part))
        .where(F.col("_rn") <= n)
        .withColumn("_rn", F.row_number().over(whole))
        .where(F.col("_rn") <= n)
        .drop("_h", "_salt", "_rn")
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(as_column(column).isNull())


def raw_vs_clean(
    raw: DataFrame,
    clean: DataFrame,
    cols: Sequence[str],
    ids: Sequence[str] = (KEY, TIME),
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Both versions of the chosen signals in long form over one range."""

    def long(df: DataFrame, source: str) -> DataFrame:
        rows = time_range(df, start, end).select(*ids, *[as_column(c) for c in cols])
        return rows.unpivot(list(ids), list(cols), "variable", "value").withColumn("source", F.lit(source))

    return long(raw, "raw").unionByName(long(clean, "cleaned"))


def quality_checks(
    df: DataFrame, sequence: str, keys: Sequence[str] = (KEY,), time: str = TIME
) -> DataFrame:
    """Per series: rows, moments that do not increase in arrival order, rows without a value.

    ``sequence`` is the arrival number; arrival order is cut into runs of it, so
    no window holds a whole series.
    """
    run = F.floor(F.col(sequence) / 262144).alias("_run")
    rows = df.select(*keys, F.col(sequence).alias("_seq"), F.col(time).alias("_t"), run)
    back = F.lag("_t").over(Window.partitionBy(*keys, "_run").orderBy("_seq"))
    inside = rows.withColumn("_bad", F.when(F.col("_t") <= back, 1).otherwise(0))
    runs = inside.groupBy(*keys, "_run").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("_bad").alias("_bad"),
        F.min_by("_t", "_seq").alias("_first"),
        F.max_by("_t", "_seq").alias("_last"),
    )
    # second level in the same way: one row per run, joined to the run before it
    before = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_run"))
    seams = runs.withColumn("_seam", F.when(F.col("_first") <= before, 1).otherwise(0))
    return seams.groupBy(*keys).agg(
        F.sum("_rows").alias("rows"),
        F.sum(F.col("_bad") + F.col("_seam")).alias("not_increasing"),
    )


