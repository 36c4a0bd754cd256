"""Time column expressions; "now" is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

DAY_SECONDS = 86400


def as_instant(value: str | dt.datetime | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def to_instant(c: Column, run_ts: str | dt.datetime | Column) -> Column:
    """Text or time to an instant: naive means UTC, unreadable means ``run_ts``."""
    written = c.cast("string")
    dated = F.when(written.rlike(r"^\d{4}-\d{2}-\d{2}"), written)
    return F.coalesce(F.try_to_timestamp(dated), as_instant(run_ts))


def epoch_to_instant(seconds: Column) -> Column:
    return F.timestamp_micros(F.rint(seconds * 1_000_000).cast("bigint"))


def age_days(created: Column, as_of: Column) -> Column:
    return (F.unix_micros(as_of) - F.unix_micros(created)) / F.lit(1e6 * DAY_SECONDS)


def recency(created: Column, as_of: Column) -> Column:
    """1 / (1 + age in days), floored at 0; 0.1 where it has no value."""
    value = F.try_divide(F.lit(1.0), F.lit(1.0) + age_days(created, as_of))
    # greatest() skips nulls, so the missing value has to be replaced inside it.
    return F.greatest(F.lit(0.0), F.coalesce(value, F.lit(0.1)))


def newer_than(created: Column, since: Column) -> Column:
    """Strictly newer; rows without a mark or a readable time pass."""
    return since.isNull() | created.isNull() | (created > since)
