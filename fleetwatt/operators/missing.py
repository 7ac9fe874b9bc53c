"""Where values are missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import as_column, epoch, floor_to
from fleetwatt.functions.ordered import with_neighbours


def _missing(c: str | Column) -> Column:
    return as_column(c).isNull().cast("int")


def stack_row(df: DataFrame, label: str, per_column: dict[str, dict[str, Column]]) -> DataFrame:
    """One aggregate pass over ``df``, then one output row per entry."""
    flat = {f"_{i}_{m}": e for i, measures in enumerate(per_column.values()) for m, e in measures.items()}
    row = df.agg(*[e.alias(n) for n, e in flat.items()])
    entries = [
        F.struct(F.lit(c).alias(label), *[F.col(f"_{i}_{m}").alias(m) for m in measures])
        for i, (c, measures) in enumerate(per_column.items())
    ]
    return row.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def missing_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and percent per column, and the overall percent in every row."""
    cols = list(cols or df.columns)
    rows = F.count(F.lit(1))
    total = sum((F.sum(_missing(c)) for c in cols), F.lit(0))
    return stack_row(
        df,
        "column",
        {
            c: {
                "missing_count": F.sum(_missing(c)),
                "missing_pct": F.avg(_missing(c)) * 100,
                "total_rows": rows,
                "overall_missing_pct": total / (rows * len(cols)) * 100,
            }
            for c in cols
        },
    )


def missing_runs(
    df: DataFrame, column: str, keys: Sequence[str] = (KEY,), time: str = TIME, unit: str = "month"
) -> DataFrame:
    """Runs of nulls: first missing moment, next known moment, hours between.

    A run that is still open ends at the last row of its series.  Rows of a run
    share their nearest known neighbours, so those name the run.
    """
    gaps = with_neighbours(df, [column], keys, time, unit).where(as_column(column).isNull())
    runs = gaps.groupBy(*keys, F.col("_prev_0.at").alias("_after"), F.col("_next_0.at").alias("_until")).agg(
        F.min(time).alias("start"), F.max(time).alias("_last")
    )
    stop = F.coalesce(F.col("_until"), F.col("_last"))
    return runs.select(
        *keys, "start", stop.alias("end"), ((epoch(stop) - epoch("start")) / 3600.0).alias("length_hours")
    )


def missing_by_hour(df: DataFrame, column: str, time: str = TIME) -> DataFrame:
    return df.groupBy(F.hour(time).alias("hour")).agg((F.avg(_missing(column)) * 100).alias("missing_pct"))


def missing_heatmap(df: DataFrame, cols: Sequence[str], time: str = TIME, freq: str = "day") -> DataFrame:
    """Percent missing per period and column, long form."""
    wide = df.groupBy(floor_to(freq, time).alias("period")).agg(
        *[(F.avg(_missing(c)) * 100).alias(c) for c in cols]
    )
    return wide.unpivot(["period"], list(cols), "column", "missing_pct")


def schema_profile(df: DataFrame, selected: Sequence[str] = ()) -> DataFrame:
    """Column, type and percent missing; selected columns first, then most missing."""
    types = dict(df.dtypes)
    table = stack_row(
        df,
        "column",
        {
            c: {
                "dtype": F.lit(types[c]),
                "missing_pct": F.avg(_missing(c)) * 100,
                "selected": F.lit(c in selected),
            }
            for c in df.columns
        },
    )
    return table.orderBy(F.col("selected").desc(), F.col("missing_pct").desc(), "column")


def gap_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return stack_row(
        df,
        "column",
        {
            c: {
                "missing_pct": F.avg(_missing(c)) * 100,
                "zero_pct": F.avg(F.when(as_column(c) == 0, 1.0).otherwise(0.0)) * 100,
                "mean": F.avg(as_column(c)),
                "std": F.stddev_samp(as_column(c)),
                "nonzero_hours": F.count_if(as_column(c) > 0),
                "total_rows": F.count(F.lit(1)),
            }
            for c in cols
        },
    )


def quality_kpis(raw: DataFrame, clean: DataFrame, time: str = TIME, fallback: DataFrame | None = None) -> DataFrame:
    """Missing share, rows before and after, signals and date span.

    The span comes from the raw table, or from ``fallback`` if that has no rows.
    """
    cells = sum((F.sum(_missing(c)) for c in raw.columns), F.lit(0))
    left = raw.agg(
        (cells / (F.count(F.lit(1)) * len(raw.columns))).alias("missing_ratio"),
        F.count(F.lit(1)).alias("raw_rows"),
        F.min(time).alias("_lo"),
        F.max(time).alias("_hi"),
    ).withColumn("_one", F.lit(1))
    right = clean.agg(F.count(F.lit(1)).alias("clean_rows")).withColumn("_one", F.lit(1))
    spare = (raw if fallback is None else fallback).agg(F.min(time).alias("_slo"), F.max(time).alias("_shi"))
    # one-row tables on a constant key
    both = left.join(F.broadcast(right), "_one").join(F.broadcast(spare.withColumn("_one", F.lit(1))), "_one")
    return both.select(
        "missing_ratio",
        "raw_rows",
        "clean_rows",
        F.try_divide(F.col("clean_rows"), F.col("raw_rows")).alias("kept_ratio"),
        F.lit(len([c for c in clean.columns if c != time])).cast("long").alias("feature_count"),
        F.coalesce("_lo", "_slo").alias("start_date"),
        F.coalesce("_hi", "_shi").alias("end_date"),
    )
