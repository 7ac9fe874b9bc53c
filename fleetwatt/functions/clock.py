"""Calendar arithmetic on naive UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds in one slot of a grid, and the span that ordered work is
# cut into, so that no task holds more than one slice of a series.
SLOT_SECONDS = {"hour": 3600, "day": 86400}
SLICE_OF = {"hour": "month", "day": "year"}


def as_column(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def naive(c: str | Column) -> Column:
    return as_column(c).cast("timestamp_ntz")


def floor_to(unit: str, c: str | Column) -> Column:
    return naive(F.date_trunc(unit, as_column(c)))


def epoch(c: str | Column) -> Column:
    """Seconds since 1970 with the sub-second part kept."""
    return F.unix_micros(as_column(c).cast("timestamp")) / F.lit(1e6)


def every(unit: str, n: int = 1) -> Column:
    return F.expr(f"INTERVAL {n} {unit.upper()}")


def slots(lo: str | Column, hi: str | Column, unit: str) -> Column:
    return F.sequence(naive(lo), naive(hi), every(unit))


def later(c: str | Column, seconds: int) -> Column:
    return naive(as_column(c) + F.expr(f"INTERVAL {int(seconds)} SECOND"))


def weekday(c: str | Column) -> Column:
    """Monday is 0."""
    return F.weekday(as_column(c))


def is_weekend(c: str | Column) -> Column:
    return weekday(c) >= 5
