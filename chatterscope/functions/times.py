"""Time column expressions. Every "now" is an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F


def timestamp(value) -> Column:
    """A zone-less timestamp from a column, a datetime or text."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def latest(df: DataFrame, column: str) -> Column:
    """The largest value of a column as a scalar subquery; nothing reaches the driver."""
    return df.agg(F.max(column)).scalar()


def hours_before(as_of, hours: int) -> Column:
    return timestamp(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")


def days_before(as_of, days: int) -> Column:
    return timestamp(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def day_of(ts: Column) -> Column:
    """Midnight before a zone-less timestamp; a date has no zone, so the session's plays no part."""
    return F.to_date(ts).cast("timestamp_ntz")


def hour_of(ts: Column) -> Column:
    return day_of(ts) + F.make_dt_interval(hours=F.hour(ts))


def from_epoch(seconds: Column) -> Column:
    """The zone-less UTC timestamp of seconds since 1970."""
    return timestamp("1970-01-01 00:00:00") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def epoch_of(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-less UTC timestamp."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def recent(df: DataFrame, column: str, as_of, hours: int | None = None, days: int | None = None):
    """Rows no older than the given span before ``as_of``."""
    edge = hours_before(as_of, hours) if hours is not None else days_before(as_of, days)
    return df.where(F.col(column) >= edge)


def on_day(df: DataFrame, column: str, as_of) -> DataFrame:
    """Rows of the calendar day of ``as_of``, as a range on the raw column so it pushes down."""
    start = day_of(timestamp(as_of))
    return df.where((F.col(column) >= start) & (F.col(column) < start + F.expr("INTERVAL 1 DAY")))
