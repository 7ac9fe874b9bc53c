"""Ordered work along a series, cut into calendar slices.

A plain ``partitionBy(series)`` window puts a whole series into one task.  Here
every window covers one slice (a month of hours, a year of days) of one series.
What a slice must know about the others is carried in by a table with one row
per series and slice, or, for lags, by copying the few rows just before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import SLICE_OF, SLOT_SECONDS, as_column, later
from fleetwatt.session import materialise

SLICE = "_slice"
FROM_START = (Window.unboundedPreceding, Window.currentRow)
BEFORE = (Window.unboundedPreceding, -1)


def _slice(time: str | Column, unit: str) -> Column:
    return F.date_trunc(unit, as_column(time))


def _placed(keys: Sequence[str]) -> Column:
    """The row belongs to a series and has a moment."""
    known = F.col(SLICE).isNotNull()
    for c in keys:
        known = known & as_column(c).isNotNull()
    return known


def with_neighbours(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
    unit: str = "month",
    order: Sequence[str] = (),
) -> DataFrame:
    """Add ``_pos`` (1-based row position in the series) and, for each column,
    ``_prev_<i>`` / ``_next_<i>``: the nearest known reading at or before / at or
    after the row, as ``struct(at, pos, value)``, null where there is none.

    ``order`` breaks ties between rows of the same moment.  Rows without a series or a
    moment are kept; they have no position and no neighbours.
    """
    part = [*keys, SLICE]
    rows = df.withColumn(SLICE, _slice(time, unit))
    up = Window.partitionBy(*part).orderBy(time, *order)
    down = Window.partitionBy(*part).orderBy(F.col(time).desc(), *[F.col(c).desc() for c in order])
    rows = rows.withColumn("_pos", F.when(_placed(keys), F.row_number().over(up).cast("long")))
    known = {
        i: F.when(
            as_column(c).isNotNull() & _placed(keys),
            F.struct(F.col(time).alias("at"), F.col("_pos").alias("pos"), as_column(c).alias("value")),
        )
        for i, c in enumerate(cols)
    }
    rows = rows.select(
        "*", *[F.last(k, ignorenulls=True).over(up.rowsBetween(*FROM_START)).alias(f"_p{i}") for i, k in known.items()]
    ).select(
        "*", *[F.last(k, ignorenulls=True).over(down.rowsBetween(*FROM_START)).alias(f"_n{i}") for i, k in known.items()]
    )

    # plain columns instead of structs keep this a hash aggregate
    ends: list[Column] = []
    for i, c in enumerate(cols):
        at, pos = (F.when(as_column(c).isNotNull(), F.col(x)) for x in (time, "_pos"))
        ends += [F.max(at).alias(f"_la{i}"), F.max(pos).alias(f"_lp{i}"), F.max_by(as_column(c), pos).alias(f"_lv{i}")]
        ends += [F.min(at).alias(f"_fa{i}"), F.min(pos).alias(f"_fp{i}"), F.min_by(as_column(c), pos).alias(f"_fv{i}")]
    edges = rows.where(_placed(keys)).groupBy(*part).agg(F.count(F.lit(1)).alias("_rows"), *ends)
    for side in "lf":
        for i in known:
            found = F.struct(F.col(f"_{side}a{i}").alias("at"), F.col(f"_{side}p{i}").alias("pos"), F.col(f"_{side}v{i}").alias("value"))
            edges = edges.withColumn(f"_{side}{i}", F.when(F.col(f"_{side}p{i}").isNotNull(), found))
    along = Window.partitionBy(*keys).orderBy(SLICE)
    against = Window.partitionBy(*keys).orderBy(F.col(SLICE).desc())
    edges = edges.withColumn("_off", F.coalesce(F.sum("_rows").over(along.rowsBetween(*BEFORE)), F.lit(0)))

    def shifted(c: str) -> Column:
        return F.when(
            F.col(c).isNotNull(),
            F.struct(
                F.col(f"{c}.at").alias("at"),
                (F.col(f"{c}.pos") + F.col("_off")).alias("pos"),
                F.col(f"{c}.value").alias("value"),
            ),
        )

    edges = edges.select(
        *part,
        "_off",
        *[F.last(shifted(f"_l{i}"), ignorenulls=True).over(along.rowsBetween(*BEFORE)).alias(f"_cp{i}") for i in known],
        *[F.last(shifted(f"_f{i}"), ignorenulls=True).over(against.rowsBetween(*BEFORE)).alias(f"_cn{i}") for i in known],
    )
    # both branches share one shuffle; only rows without a series or a moment find no edges
    joined = rows.join(edges, part, "left")
    out = joined.select(
        *[as_column(c) for c in df.columns],
        (F.col("_pos") + F.col("_off")).alias("_pos"),
        *[F.when(F.col("_off").isNotNull(), F.coalesce(shifted(f"_p{i}"), F.col(f"_cp{i}"))).alias(f"_prev_{i}") for i in known],
        *[F.when(F.col("_off").isNotNull(), F.coalesce(shifted(f"_n{i}"), F.col(f"_cn{i}"))).alias(f"_next_{i}") for i in known],
    )
    return out


def running_total(
    df: DataFrame, cols: dict[str, Column], keys: Sequence[str] = (KEY,), time: str = TIME, unit: str = "month"
) -> DataFrame:
    """Add running sums along each series; nulls count as zero.

    Rows without a series or a moment are kept with null sums.
    """
    part = [*keys, SLICE]
    rows = df.withColumn(SLICE, _slice(time, unit))
    up = Window.partitionBy(*part).orderBy(time).rowsBetween(*FROM_START)
    rows = rows.select("*", *[F.sum(F.coalesce(e, F.lit(0))).over(up).alias(f"_in_{n}") for n, e in cols.items()])
    along = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(*BEFORE)
    carried = (
        rows.where(_placed(keys))
        .groupBy(*part)
        .agg(*[F.sum(F.coalesce(e, F.lit(0))).alias(f"_t_{n}") for n, e in cols.items()])
        .select(*part, *[F.coalesce(F.sum(f"_t_{n}").over(along), F.lit(0)).alias(f"_c_{n}") for n in cols])
    )
    return rows.join(carried, part, "left").select(
        *[as_column(c) for c in df.columns],
        *[(F.col(f"_in_{n}") + F.col(f"_c_{n}")).alias(n) for n in cols],
    )


def with_lags(
    df: DataFrame,
    lags: dict[str, tuple[str, int]],
    keys: Sequence[str] = (KEY,),
    time: str = TIME,
    freq: str = "hour",
    past: dict[str, tuple[str, int]] | None = None,
) -> DataFrame:
    """Add lag columns on a complete grid: ``{new: (column, slots back)}``.

    ``past`` adds arrays ``{new: (column, reach)}`` of the value now and up to ``reach``
    slots back, newest first; an array is shorter where the series begins.
    Rows close to the end of a slice are also copied to the slices that look
    back at them, so each slice is computed on its own.
    """
    past = past or {}
    reach = max([k for _, k in [*lags.values(), *past.values()]] + [0])
    unit, step = SLICE_OF[freq], SLOT_SECONDS[freq]
    home = _slice(time, unit)
    seen_by = F.sequence(home, _slice(later(time, reach * step), unit), F.expr(f"INTERVAL 1 {unit}"))
    rows = df.withColumn(SLICE, F.explode(seen_by))
    w = Window.partitionBy(*keys, SLICE).orderBy(time)
    out = rows.select(
        "*",
        *[F.lag(as_column(c), k).over(w).alias(n) if k else as_column(c).alias(n) for n, (c, k) in lags.items()],
        *[F.collect_list(F.struct(as_column(c).alias("v"))).over(w.rowsBetween(-k, 0)).alias(n) for n, (c, k) in past.items()],
    )
    newest_first = {n: F.transform(F.reverse(n), lambda p: p.getField("v")) for n in past}
    return out.where(F.col(SLICE) == home).drop(SLICE).withColumns(newest_first)


def newest(df: DataFrame, n: int, keys: Sequence[str], time: str = TIME, unit: str = "month") -> DataFrame:
    """The last ``n`` rows of each group.

    Counts per slice tell which slices can hold them; only those rows are numbered.  The
    counts are written out, so the planner knows their size.
    """
    rows = df.withColumn(SLICE, _slice(time, unit))
    counts = rows.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_rows"))
    after = F.sum("_rows").over(Window.partitionBy(*keys).orderBy(F.col(SLICE).desc()).rowsBetween(*BEFORE))
    first = materialise(
        counts.withColumn("_after", F.coalesce(after, F.lit(0)))
        .where(F.col("_after") < n)
        .groupBy(*keys)
        .agg(F.min(SLICE).alias("_first"))
    )
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(time).desc()))
    return (
        rows.join(first, list(keys))
        .where(F.col(SLICE) >= F.col("_first"))
        .withColumn("_rn", back)
        .where(F.col("_rn") <= n)
        .drop("_rn", "_first", SLICE)
    )


def hash_rank(df: DataFrame, by: Column, name: str, bits: int = 16) -> DataFrame:
    """Number rows 1..n in the order of a hash, without one global window.

    Rows fall into hash-range buckets, are numbered inside their bucket and
    shifted by the size of the buckets before it (a table of ``2**bits`` rows).
    """
    rows = df.withColumn("_h", by).withColumn("_b", F.shiftright(F.col("_h"), 64 - bits))
    sizes = rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per bucket: 65,536 rows at most, in the window and in the broadcast
    offsets = sizes.select(
        "_b", F.coalesce(F.sum("_rows").over(Window.orderBy("_b").rowsBetween(*BEFORE)), F.lit(0)).alias("_off")
    )
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_h"))
    return (
        rows.withColumn("_in", inside)
        .join(F.broadcast(offsets), "_b")
        .withColumn(name, (F.col("_in") + F.col("_off")).cast("long"))
        .drop("_h", "_b", "_in", "_off")
    )
