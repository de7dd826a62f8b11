"""Day and hour keys."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, functions as F


def day_of_millis(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")


def hour_of_millis(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "HH")


def day_of_text(moment: Column) -> Column:
    """Day part of `yyyy-MM-dd HH:mm:ss`."""
    return F.split(moment, " ")[0]


def hour_of_text(moment: Column) -> Column:
    """Two-digit hour of `yyyy-MM-dd HH:mm:ss`; null where there is no time part."""
    return F.split(F.get(F.split(moment, " "), F.lit(1)), ":")[0]


def event_time(moment: Column) -> Column:
    """Text to a zoned timestamp, the type watermarks need; null where unreadable."""
    return F.try_to_timestamp(moment, F.lit("yyyy-MM-dd HH:mm:ss"))


def day_before(day: str) -> str:
    return (date.fromisoformat(day) - timedelta(days=1)).isoformat()


def day_after(day: str) -> str:
    return (date.fromisoformat(day) + timedelta(days=1)).isoformat()
