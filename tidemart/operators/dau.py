"""Daily active devices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.functions.times import day_of_millis, hour_of_millis
from tidemart.schemas import DAU


def flatten_start_logs(logs: DataFrame) -> DataFrame:
    """Parsed start logs to flat rows with day, hour and a constant minute."""
    return logs.select(
        *[F.col(f"common.{n}").alias(n) for n in ("mid", "uid", "ar", "ch", "vc")],
        day_of_millis(F.col("ts")).alias("dt"), hour_of_millis(F.col("ts")).alias("hr"),
        F.lit("00").alias("mi"), "ts")


def first_visits(rows: DataFrame) -> DataFrame:
    """Each device's first row of each day, equal times decided by the values.

    A partial aggregate runs before the exchange, so a device that sends a large
    part of all logs arrives as a few rows.
    """
    values = [n for n in DAU.fieldNames() if n not in ("dt", "mid", "ts")]
    first = F.min(F.struct("ts", *values)).alias("_f")
    return rows.groupBy("dt", "mid").agg(first).select("dt", "mid", "_f.*").select(*DAU.fieldNames())


def new_visits(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """First rows of the devices that have no row of that day yet."""
    return first_visits(rows).join(seen.select("dt", "mid"), ["dt", "mid"], "left_anti")


def first_hours(rows: DataFrame) -> DataFrame:
    """Day, device and hour of each first visit. The hour follows from the earliest time
    alone, a number, so this is a hash aggregate where whole rows need a sorting one."""
    return rows.groupBy("dt", "mid").agg(F.min("ts").alias("ts")) \
        .select("dt", "mid", hour_of_millis(F.col("ts")).alias("hr"))


def active_per_hour(visits: DataFrame) -> DataFrame:
    return visits.groupBy("dt", "hr").agg(F.count("*").alias("n"))


def new_devices(visits: DataFrame) -> DataFrame:
    """Devices per day whose first day ever it is."""
    return (visits.groupBy("mid").agg(F.min("dt").alias("dt"))
            .groupBy("dt").agg(F.count("*").alias("new_mid")))
