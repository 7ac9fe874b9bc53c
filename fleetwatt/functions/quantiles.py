"""Exact quantiles without sorting a whole group in one task.

``percentile`` keeps every distinct value of a group in one buffer.  Here a
group is counted into equal-width cells, the cell that holds the wanted rank is
counted again into finer cells, and only the values of the last cell are ranked.
Every count is a partial aggregate, so a hot group costs no more than a scan.
The count tables are written out: each pass then reads the rows once and the
planner knows the size of what it joins to them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt.functions.clock import as_column
from fleetwatt.session import materialise


def _cell(v: Column, lo: Column, hi: Column, cells: int) -> Column:
    """Infinite values get cells of their own below and above the finite range."""
    far = F.lit(1.7976931348623157e308)
    floor, top = F.greatest(lo, -far), F.least(hi, far)
    part = F.floor(((v / 2 - floor / 2) / (top / 2 - floor / 2)) * cells)
    inside = F.when(top > floor, F.least(part, F.lit(cells - 1)).cast("int")).otherwise(F.lit(0))
    return F.when(v == F.lit(-math.inf), F.lit(-1)).when(v == F.lit(math.inf), F.lit(cells)).otherwise(inside)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    probs: Sequence[float],
    cells: int = 1024,
    levels: int = 2,
) -> DataFrame:
    """``keys, prob, quantile`` with linear interpolation between order statistics."""
    keys = list(keys)
    rows = df.select(*keys, F.nanvl(as_column(value).cast("double"), F.lit(None).cast("double")).alias("_v")).where("_v IS NOT NULL")
    rows = rows.withColumn("_all", F.lit(1))
    path = [*keys, "_all"]
    whole = materialise(
        rows.groupBy(*path).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    )
    at = (F.col("_n") - 1) * F.col("prob")
    targets = (
        whole.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("_frac", at - F.floor(at))
        .withColumn("_side", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("_rank", F.least(F.floor(at) + F.col("_side"), F.col("_n") - 1))
        .select(*path, "prob", "_frac", "_side", "_rank")
    )
    bounds = whole.select(*path, "_lo", "_hi")
    for level in range(levels):
        cell = f"_c{level}"
        rows = rows.join(bounds, path, "inner").withColumn(
            cell, _cell(F.col("_v"), F.col("_lo"), F.col("_hi"), cells)
        ).drop("_lo", "_hi")
        counts = rows.groupBy(*path, cell).agg(
            F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
        )
        before = Window.partitionBy(*path).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        hit = (
            targets.join(counts, path, "inner")
            .where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
            .withColumn("_rank", F.col("_rank") - F.col("_before"))
        )
        path = [*path, cell]
        found = materialise(hit.select(*path, "prob", "_frac", "_side", "_rank", "_lo", "_hi"))
        targets = found.drop("_lo", "_hi")
        bounds = found.select(*path, "_lo", "_hi").distinct()
    # the last cell: equal values are counted together before they are ranked
    tail = rows.join(bounds.select(*path), path, "left_semi").groupBy(*path, "_v").agg(F.count("_v").alias("_n"))
    upto = Window.partitionBy(*path).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    tail = tail.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    found = (
        targets.join(tail, path, "inner")
        .where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
    )
    low, high, part = F.max(F.when(F.col("_side") == 0, F.col("_v"))), F.max(F.when(F.col("_side") == 1, F.col("_v"))), F.max("_frac")
    # an infinite neighbour has no share in an exact rank, and equal neighbours need none
    between = F.when((part == 0) | (low == high), low).otherwise(low * (1 - part) + high * part)
    return found.groupBy(*keys, "prob").agg(between.alias("quantile"))
