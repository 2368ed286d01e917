"""Trip measures as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(ts: Column) -> Column:
    """First day of the month of ``ts`` as a DATE (the partition value)."""
    return F.date_trunc("month", ts).cast("date")


def duration_sec(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def duration_min(start: Column, end: Column) -> Column:
    """Minutes between two timestamps as DECIMAL(10,2); NULL (not a job failure under ANSI
    mode) when a dirty timestamp pair overflows the type."""
    return (duration_sec(start, end) / F.lit(60.0)).try_cast("decimal(10,2)")


def tip_pct(tip: Column, fare: Column) -> Column:
    """Tip as a percentage of fare; NULL unless fare > 0, NULL on overflow."""
    return F.when(fare > 0, (tip / fare * F.lit(100.0)).try_cast("decimal(10,2)"))


def month_start(year: int, month: int) -> Column:
    return F.make_date(F.lit(year), F.lit(month), F.lit(1))
