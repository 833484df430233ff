"""Calendar parts, buckets and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_key(ts: Column) -> Column:
    """The day as ``yyyy-MM-dd`` text in the session time zone."""
    return F.to_date(ts).cast("string")


def minute_bucket(ts: Column, minutes: int = 10) -> Column:
    """Minute of the hour, floored to a bucket."""
    return F.floor(F.minute(ts) / minutes) * minutes


def time_bucket(ts: Column, width_seconds: int) -> Column:
    """Start of the tumbling window that holds ``ts``, aligned to the epoch."""
    return F.window(ts, f"{width_seconds} seconds")["start"]


def seconds(n: int | float) -> Column:
    """A day-time interval."""
    return F.make_dt_interval(secs=F.lit(n).cast("decimal(18,6)"))


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def age_seconds(ts: Column, reference: Column) -> Column:
    """Whole seconds from ``ts`` to ``reference``."""
    return F.floor((_micros(reference) - _micros(ts)) / 1_000_000)


def age_label(age: Column) -> Column:
    """``45s``, ``12m`` or ``3h``."""
    return (
        F.when(age < 60, F.concat(age.cast("string"), F.lit("s")))
        .when(age < 3600, F.concat(F.floor(age / 60).cast("string"), F.lit("m")))
        .otherwise(F.concat(F.floor(age / 3600).cast("string"), F.lit("h")))
    )
