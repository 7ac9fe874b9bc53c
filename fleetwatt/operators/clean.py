"""The cleaning sequence with its audit log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import as_column
from fleetwatt.operators.coerce import (
    clip_negative,
    columns_like,
    parse_time,
    text_columns_with_numbers,
    to_number,
)
from fleetwatt.operators.impute import Fill, fill

# Name parts that mark a signal, and how many rows a fill may cross.
PV_WORDS = ("pv", "photovoltaic")
DEMAND_WORDS = ("demand",)
PV_LIMIT = 4
DEMAND_LIMIT = 3

#: Raw readings are ordered within one day of a series at a time, however long it is.
RAW_SLICE = "day"


@dataclass(frozen=True)
class Cleaned:
    data: DataFrame
    log: DataFrame


def clean_dataset(df: DataFrame, key: str = KEY, time: str = TIME, order: tuple[str, ...] = ()) -> Cleaned:
    """Readable times, numbers, short gaps filled, no negatives, no demand gaps.

    PV columns are interpolated up to four rows from a reading, demand columns are
    carried forward up to three rows, negatives become zero, and rows whose demand is
    still unknown go.  Rows without a series are kept, but have no neighbours to be filled
    from.  ``log`` has one row per (step, column) with the rows it touched.
    """
    timed = df.withColumn("_time", parse_time(time))
    unreadable = timed.agg(F.count_if(F.col("_time").isNull()).alias("count"))
    work = timed.withColumn(time, F.col("_time")).drop("_time").where(F.col(time).isNotNull())

    numeric_text = text_columns_with_numbers(work, skip=(key, time, *order))
    work = work.withColumns({c: to_number(c) for c in numeric_text})
    pv, demand = columns_like(work, PV_WORDS), columns_like(work, DEMAND_WORDS)
    doubles = [f.name for f in work.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    work = work.withColumns({c: to_number(c) for c in doubles})

    both = work.withColumns({f"_raw_{c}": as_column(c) for c in [*pv, *demand]})
    rules = {c: Fill("time", limit=PV_LIMIT) for c in pv} | {c: Fill("forward", back=False, limit=DEMAND_LIMIT) for c in demand}
    if rules:
        both = fill(both, rules, [key], time, unit=RAW_SLICE, order=order)
    both = both.withColumns({f"_full_{c}": as_column(c) for c in [*pv, *demand]})
    both = both.withColumns({c: clip_negative(c) for c in [*pv, *demand]})

    counts = {}
    for c in pv:
        counts["interpolated pv", c] = F.count_if(as_column(f"_raw_{c}").isNull() & as_column(c).isNotNull())
    for c in demand:
        counts["forward-filled demand", c] = F.count_if(as_column(f"_raw_{c}").isNull() & as_column(c).isNotNull())
    for c in [*pv, *demand]:
        counts["clipped negatives", c] = F.count_if(as_column(f"_full_{c}") < 0)
        counts["missing before", c] = F.count_if(as_column(f"_raw_{c}").isNull())
    lost = None
    for c in demand:
        lost = as_column(c).isNull() if lost is None else lost | as_column(c).isNull()
    counts["rows without a series", key] = F.count_if(as_column(key).isNull())
    if lost is not None:
        counts["dropped rows with long demand gaps", "*"] = F.count_if(lost)
    names = list(counts)
    row = both.agg(*[counts[k].alias(f"_{i}") for i, k in enumerate(names)])
    entries = [
        F.struct(F.lit(s).alias("step"), F.lit(c).alias("column"), F.col(f"_{i}").alias("count"))
        for i, (s, c) in enumerate(names)
    ]
    log = unreadable.select(F.lit("drop invalid timestamps").alias("step"), F.lit(time).alias("column"), "count")
    log = log.unionByName(row.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))

    data = both if lost is None else both.where(~lost)
    return Cleaned(data.select(*[as_column(c) for c in work.columns]), log)
