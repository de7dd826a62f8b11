"""The report requests: day cards, hour series, brand ranking, sales pages and charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.functions.money import from_cents
from tidemart.functions.text import matches_any_word
from tidemart.functions.times import day_before, hour_of_text
from tidemart.operators import dau, stats
from tidemart.operators.search import page_with_total


def order_amount_total(wide: DataFrame, day: str) -> DataFrame:
    """Sales of a day; null when the day has no rows."""
    return wide.where(F.col("dt") == day).agg(
        stats.sum_amount("final_detail_amount").alias("amount"))


def order_amount_hour(wide: DataFrame) -> DataFrame:
    """Sales per day and two-digit hour."""
    return wide.groupBy("dt", hour_of_text(F.col("create_time")).alias("hr")).agg(
        stats.sum_amount("final_detail_amount").alias("amount"))


def dau_total(visits: DataFrame, day: str) -> DataFrame:
    return visits.where(F.col("dt") == day).agg(F.count("*").alias("n"))


def realtime_total(visits: DataFrame, wide: DataFrame, day: str) -> DataFrame:
    """Day cards: active devices, new devices, sales (null without sales).

    New devices need each device's first day ever, so `visits` must hold all days.
    """
    active = dau_total(visits, day).select(
        F.lit("dau").alias("id"), F.col("n").cast("double").alias("value"))
    new = (dau.new_devices(visits).where(F.col("dt") == day)
           .agg(F.coalesce(F.sum("new_mid"), F.lit(0)).cast("double").alias("value"))
           .select(F.lit("new_mid").alias("id"), "value"))
    sales = order_amount_total(wide, day).select(
        F.lit("order_amount").alias("id"), F.col("amount").alias("value"))
    return active.unionByName(new).unionByName(sales)


def day_cards(active: DataFrame, new: DataFrame, sales: DataFrame, day: str) -> DataFrame:
    """The cards of `realtime_total` from sums kept per day and hour (see `sources.rollups`): devices, new devices
    and cents."""
    def card(name: str, sums: DataFrame, value) -> DataFrame:
        total = sums.where(F.col("dt") == day).agg(F.sum("value").alias("v"))
        return total.select(F.lit(name).alias("id"), value(F.col("v")).alias("value"))

    def count(v):
        return F.coalesce(v, F.lit(0)).cast("double")

    return card("dau", active, count).unionByName(card("new_mid", new, count)).unionByName(
        card("order_amount", sales, from_cents))


def today_and_yesterday(hourly: DataFrame, value: str, day: str) -> DataFrame:
    """24 rows: both days' values of every hour, 0 where a day has none."""
    hours = hourly.sparkSession.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hr"))
    yesterday = day_before(day)

    def on(d: str):
        return F.sum(F.when(F.col("dt") == d, F.col(value)))

    both = (hourly.where(F.col("dt").isin(day, yesterday)).groupBy("hr")
            .agg(on(day).alias("_t"), on(yesterday).alias("_y")))
    return hours.join(both, "hr", "left").select(
        "hr", F.coalesce("_t", F.lit(0)).alias("today"), F.coalesce("_y", F.lit(0)).alias("yesterday"))


def realtime_hour(kind: str, day: str, visits: DataFrame | None = None,
                  wide: DataFrame | None = None) -> DataFrame | None:
    """Hour series of `dau` or `order_amount`; None for any other kind."""
    days = [day, day_before(day)]
    if kind == "dau":
        return today_and_yesterday(dau.active_per_hour(visits.where(F.col("dt").isin(days))), "n", day)
    if kind == "order_amount":
        return today_and_yesterday(order_amount_hour(wide.where(F.col("dt").isin(days))), "amount", day)
    return None


def lines_with(wide: DataFrame, keyword: str) -> DataFrame:
    """Lines whose SKU name holds a word of the keyword; an empty keyword matches all."""
    return wide.where(matches_any_word(F.col("sku_name"), keyword)) if keyword.strip() else wide


def sale_detail_page(wide: DataFrame, users: DataFrame, day: str, keyword: str,
                     start_page: int, size: int, sku: DataFrame | None = None) -> DataFrame:
    """Lines of a day whose SKU name holds a word of the keyword, one page of them
    with the number of all. Pages count from 1.

    The page is cut first: users, and with `sku` the brands, are joined to its rows only. Without
    `sku` the lines have brand and gender themselves.
    """
    hits = lines_with(wide.where(F.col("dt") == day), keyword)
    rows = page_with_total(hits, [F.col("order_detail_id")], (start_page - 1) * size, size)
    names = ["user_age", "user_level"]
    if sku is not None:
        brands = sku.select(F.col("id").cast("long").alias("sku_id"), "tm_id")
        rows = rows.drop("tm_id", "user_gender").join(brands, "sku_id", "left")
        users, names = users.withColumn("user_gender", F.col("gender_name")), [*names, "user_gender"]
    dim = users.select(F.col("id").cast("long").alias("user_id"), *names)
    return rows.join(dim, "user_id", "left").select(
        "order_detail_id", "order_id", "user_id", "sku_id", "user_gender", "user_age", "user_level",
        "sku_price", "sku_name", F.col("tm_id").alias("sku_tm_id"), "dt", "total")


def hit_shares(wide: DataFrame, users: DataFrame, keyword: str) -> DataFrame:
    """(kind, value, n, share): the lines a keyword finds by gender and by age group. Hits are counted per user
    first, so that only these counts are joined with the users."""
    hits = lines_with(wide, keyword).groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    people = users.select(F.col("id").cast("long").alias("user_id"), F.col("gender_name").alias("gender"),
                          F.col("age_group").alias("age"))
    return stats.shares_by_each(hits.join(people, "user_id"), ["gender", "age"], F.col("_n"))
