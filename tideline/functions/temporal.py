"""Bucketed truncation, day ranges and durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted buckets, case-sensitive; anything else means a day.
BUCKETS = ("hour", "day", "week", "month")


def bucket_start(bucket: str, ts: Column) -> Column:
    """Start of the bucket holding ``ts``; weeks start on Monday."""
    return F.date_trunc(bucket if bucket in BUCKETS else "day", ts)


def in_day_range(ts: Column, start: dt.date, end: dt.date) -> Column:
    """True from midnight of ``start`` up to, not including, midnight after ``end``."""
    after = end + dt.timedelta(days=1)
    return (ts >= F.lit(start.isoformat()).cast("timestamp")) & (
        ts < F.lit(after.isoformat()).cast("timestamp")
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds, rounded to 6 decimals."""
    start, end = start.cast("timestamp"), end.cast("timestamp")
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / 1e6, 6)
