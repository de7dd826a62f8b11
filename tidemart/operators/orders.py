"""Orders: dates, first-order flag, province and user attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.functions.times import day_of_text, hour_of_text


def with_date_hour(orders: DataFrame) -> DataFrame:
    return orders.withColumns({"create_date": day_of_text(F.col("create_time")),
                               "create_hour": hour_of_text(F.col("create_time"))})


def flag_first_order(orders: DataFrame, status: DataFrame) -> DataFrame:
    """`1` for orders of users without a status row, as the value in it is never
    looked at. Two orders of a new user in one batch are both flagged."""
    known = status.select("user_id").distinct().withColumn("_known", F.lit(True))
    flag = F.when(F.col("_known").isNotNull(), "0").otherwise("1")
    return orders.join(known, "user_id", "left").select(
        *orders.columns, flag.alias("if_first_order"))


def flag_first_order_by_day(orders: DataFrame) -> DataFrame:
    """The same rule with each day as one batch: `1` on the user's first day."""
    first_day = orders.groupBy("user_id").agg(F.min("create_date").alias("_first"))
    flag = F.when(F.col("create_date") == F.col("_first"), "1").otherwise("0")
    return orders.join(first_day, "user_id").select(
        *orders.columns, flag.alias("if_first_order"))


def keep_one_first_order(orders: DataFrame) -> DataFrame:
    """Within the given orders leave the flag only on each user's earliest one.

    Without a flag every order is looked at. The earliest order is found by a partial aggregate and matched on the unique
    order id, so a user with very many orders is never brought into one task.
    """
    flagged = orders.where(F.col("if_first_order") == "1") if "if_first_order" in orders.columns else orders
    earliest = (flagged.groupBy("user_id")
                .agg(F.min(F.struct("create_time", "id")).alias("_e"))
                .select(F.col("_e.id").alias("id"), F.lit("1").alias("_flag")))
    return orders.join(earliest, "id", "left").select(
        *[c for c in orders.columns if c != "if_first_order"],
        F.coalesce("_flag", F.lit("0")).alias("if_first_order"))


def first_order_users(orders: DataFrame) -> DataFrame:
    """Status rows to store: the users of flagged orders."""
    return (orders.where(F.col("if_first_order") == "1")
            .select("user_id").distinct().withColumn("if_consumed", F.lit("1")))


def join_province(orders: DataFrame, province: DataFrame) -> DataFrame:
    dim = province.select(F.col("id").cast("long").alias("province_id"),
                          F.col("name").alias("province_name"),
                          F.col("area_code").alias("province_area_code"),
                          F.col("iso_code").alias("province_iso_code"))
    return orders.join(dim, "province_id", "left").select(
        *orders.columns,
        "province_name", "province_area_code", "province_iso_code")


def join_user(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Needs users with `age_group` and `gender_name` (see `dims.describe_users`)."""
    dim = users.select(F.col("id").cast("long").alias("user_id"),
                       F.col("age_group").alias("user_age_group"),
                       F.col("gender_name").alias("user_gender"))
    return orders.join(dim, "user_id", "left").select(
        *orders.columns, "user_age_group", "user_gender")


def join_sku(details: DataFrame, sku: DataFrame) -> DataFrame:
    """Order lines with product, brand and category; an unknown SKU leaves nulls."""
    names = ["spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name"]
    dim = sku.select(F.col("id").cast("long").alias("sku_id"), *names)
    return details.join(dim, "sku_id", "left").select(*details.columns, *names)
