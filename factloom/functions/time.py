"""Elapsed time and validity predicates. The clock is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


def clock(value: Column | dt.datetime | dt.date | str) -> Column:
    """A zone-free timestamp literal from a datetime, a date or an ISO string."""
    if isinstance(value, Column):
        return value
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def elapsed_micros(later: Column, earlier: Column) -> Column:
    """Microseconds between two timestamps of the same kind, without a time-zone conversion."""
    gap = later - earlier
    part = lambda unit: F.extract(F.lit(unit), gap)
    whole_minutes = (part("DAY").cast("long") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return whole_minutes * (60 * MICROS_PER_SECOND) + (
        part("SECOND") * MICROS_PER_SECOND
    ).cast("long")


def whole_days(later: Column, earlier: Column) -> Column:
    """Completed 24-hour days between two timestamps, truncated toward zero."""
    return (elapsed_micros(later, earlier) / F.lit(float(MICROS_PER_DAY))).cast("long")


def hours_between(later: Column, earlier: Column) -> Column:
    return elapsed_micros(later, earlier) / F.lit(3600.0 * MICROS_PER_SECOND)


def minutes_between(later: Column, earlier: Column) -> Column:
    return elapsed_micros(later, earlier) / F.lit(60.0 * MICROS_PER_SECOND)


def holds_at(moment: Column, start: Column, end: Column) -> Column:
    """Half-open interval test; a NULL end is open."""
    return (start <= moment) & (end.isNull() | (end > moment))
