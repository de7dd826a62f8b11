"""Sums over the wide table and over stored brand statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.functions.money import from_cents, round_half_up, to_cents


def sum_amount(amount: str) -> Column:
    """Exact sum of a two-digit amount."""
    return from_cents(F.sum(to_cents(F.col(amount))))


def brand_amounts(wide: DataFrame) -> DataFrame:
    """Sales per brand, keyed by id and name apart so that any name is safe."""
    return wide.groupBy("tm_id", "tm_name").agg(sum_amount("final_detail_amount").alias("amount"))


def brand_amounts_of_lines(lines: DataFrame, sku: DataFrame, *by: str) -> DataFrame:
    """Sales per brand (and the columns `by`) of lines that have no brand yet: sums
    per SKU first, so that only these and not the lines are joined."""
    per_sku = lines.groupBy(*by, "sku_id").agg(F.sum(to_cents(F.col("final_detail_amount"))).alias("_cents"))
    brands = sku.select(F.col("id").cast("long").alias("sku_id"), "tm_id", "tm_name")
    return (per_sku.join(brands, "sku_id", "left").groupBy(*by, "tm_id", "tm_name")
            .agg(from_cents(F.sum("_cents")).alias("amount")))


def brand_stat_rows(wide: DataFrame, stat_time: Column) -> DataFrame:
    """Brand sales of one batch as rows of the statistics table."""
    return brand_amounts(wide).select(
        stat_time.alias("stat_time"), F.col("tm_id").alias("trademark_id"),
        F.col("tm_name").alias("trademark_name"), "amount")


def top_brands(stats: DataFrame, start: str, end: str, top: int) -> DataFrame:
    """Brands by amount in the open time range, greatest first, ties by id."""
    inside = (F.col("stat_time") > start) & (F.col("stat_time") < end)
    return (stats.where(inside).groupBy("trademark_id", "trademark_name")
            .agg(sum_amount("amount").alias("amount"))
            .orderBy(F.desc("amount"), "trademark_id").limit(top))


def chart_points(top: DataFrame) -> DataFrame:
    """Top brands as chart input: x is the name, y the amount, s the only series."""
    return top.select(F.col("trademark_name").alias("x"), F.col("amount").alias("y"),
                      F.lit(1).alias("s"))


def shares(df: DataFrame, group: str, count: Column | None = None) -> DataFrame:
    """Row count per group and its part of all rows; `count` sums rows counted
    before. The window runs over the few counted groups, not over the rows."""
    counts = df.groupBy(group).agg((F.count("*") if count is None else F.sum(count)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share", round_half_up(F.col("n") / total, 6))


def province_sales(wide: DataFrame, band: int = 100) -> DataFrame:
    """Sales per province with the number of its value band."""
    total = sum_amount("final_detail_amount")
    return (wide.groupBy("province_name", "province_area_code").agg(total.alias("amount"))
            .withColumn("band", F.floor(F.col("amount") / band)))


def province_sales_of_orders(orders: DataFrame, province: DataFrame, band: int = 100) -> DataFrame:
    """The same from the orders that have lines: the shares of an order's lines add up to what was paid for it.
    Orders are summed by province id first, so that only the sums are joined with the names."""
    sums = orders.groupBy("province_id").agg(F.sum(to_cents(F.col("final_total_amount"))).alias("_cents"))
    names = province.select(F.col("id").cast("long").alias("province_id"), F.col("name").alias("province_name"),
                            F.col("area_code").alias("province_area_code"))
    return (sums.join(names, "province_id", "left").groupBy("province_name", "province_area_code")
            .agg(from_cents(F.sum("_cents")).alias("amount")).withColumn("band", F.floor(F.col("amount") / band)))


def shares_by_each(df: DataFrame, groups: list[str], count: Column) -> DataFrame:
    """(kind, value, n, share): for each of the columns the rows per value and their part of all, from one
    aggregate over grouping sets; `count` sums rows counted before."""
    sets = df.groupingSets([[g] for g in groups], *groups).agg(
        F.sum(count).alias("n"), F.grouping_id().cast("long").alias("_set"))
    # the k-th of m columns alone leaves a 0 at its bit of the grouping id
    bits = {g: (1 << len(groups)) - 1 - (1 << (len(groups) - 1 - i)) for i, g in enumerate(groups)}
    kind, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for g, b in bits.items():
        kind = F.when(F.col("_set") == b, g).otherwise(kind)
        value = F.when(F.col("_set") == b, F.col(g)).otherwise(value)
    total = F.sum("n").over(Window.partitionBy("kind"))
    return sets.select(kind.alias("kind"), value.alias("value"), "n").withColumn("share", round_half_up(F.col("n") / total, 6))
