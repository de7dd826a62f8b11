"""Order lines joined with their order, and the payment spread over the lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.functions.money import from_cents, line_cents, share_cents, to_cents
from tidemart.schemas import ORDER_WIDE


def order_side(orders: DataFrame) -> DataFrame:
    """Order columns under their wide-table names."""
    return orders.select(
        F.col("id").alias("order_id"), "order_status", "create_time",
        F.col("create_date").alias("dt"), "user_id",
        "benefit_reduce_amount", "feight_fee", "original_total_amount", "final_total_amount",
        "if_first_order", "province_name", "province_area_code", "user_age_group", "user_gender")


def detail_side(details: DataFrame, *more: Column) -> DataFrame:
    """Line columns under their wide-table names, and whatever else is asked for."""
    return details.select(
        F.col("id").alias("order_detail_id"), "order_id", "sku_id", "sku_name",
        F.col("order_price").alias("sku_price"), "sku_num",
        "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name", *more)


def to_wide(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Inner join into the wide row; the share of the payment is filled in later."""
    joined = detail_side(details).join(order_side(orders), "order_id")
    return joined.withColumn("final_detail_amount", F.lit(None).cast("double")) \
        .select(*ORDER_WIDE.fieldNames())


def with_line_shares(wide: DataFrame) -> DataFrame:
    """Add `_line`, unless it is there, `_paid`, `_listed` and the rounded share `_share`, all in cents."""
    line = F.col("_line") if "_line" in wide.columns else line_cents(F.col("sku_price"), F.col("sku_num"))
    return wide.withColumns({
        "_line": line,
        "_paid": to_cents(F.col("final_total_amount")),
        "_listed": to_cents(F.col("original_total_amount")),
    }).withColumn("_share", share_cents(F.col("_paid"), F.col("_line"), F.col("_listed")))


def order_rests(wide: DataFrame) -> DataFrame:
    """Per order: what its lines' rounded shares leave of the payment, in cents, and
    the id of the line that gets it, the greatest one (lines of no amount aside).

    Paid minus all shares is a plain sum, so no order's lines have to meet in one
    task or be sorted.
    """
    return with_line_shares(wide).groupBy("order_id").agg(
        (F.max("_paid") - F.sum("_share")).alias("_rest"),
        F.coalesce(F.max(F.when(F.col("_line") != 0, F.col("order_detail_id"))),
                   F.max("order_detail_id")).alias("_last"))


def apportion(wide: DataFrame, rests: DataFrame | None = None) -> DataFrame:
    """Fill `final_detail_amount` so that an order's lines add up to what was paid.

    `rests` are the `order_rests` of the same lines, when they can be had from rows
    without the dimension columns.
    """
    rests = order_rests(wide) if rests is None else rests
    extra = F.when(F.col("order_detail_id") == F.col("_last"), F.col("_rest")).otherwise(F.lit(0))
    return (with_line_shares(wide).join(rests, "order_id")
            .withColumn("final_detail_amount", from_cents(F.col("_share") + extra))
            .select(*wide.columns))


def stretches(df: DataFrame, key: str, order: str, rows_each: int = 100_000) -> DataFrame:
    """`df` with `_chunk`, the number of the stretch of its key a row lies in: 0 for keys of up to `rows_each` rows,
    else cut at quantiles of the numeric column `order`, so that a stretch has about that many rows.

    The quantiles come from one aggregate over the rows of large keys, which keeps a sketch of bounded size per
    key and task and so never brings a key's rows together.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_each)
    large = df.select(key, order).join(F.broadcast(counts) if counts.limit(10_001).count() <= 10_000 else counts, key)
    parts = F.ceil(F.col("_n") / rows_each)
    # at most a thousand cuts; a key of more stretches than that has larger ones
    shares = F.lit([i / 1000 for i in range(1, 1000)])
    cuts = (large.groupBy(key).agg(F.percentile_approx(order, shares, 20_000).alias("_all"), F.max("_n").alias("_n"))
            .select(key, F.transform(F.sequence(F.lit(1), F.least(parts, F.lit(1000)) - 1),
                                     lambda i: F.get("_all", F.floor(i * 1000 / F.least(parts, F.lit(1000))).cast("int") - 1))
                    .alias("_cuts")))
    chunk = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(order))), F.lit(0))
    return df.join(cuts, key, "left").withColumn("_chunk", F.when(F.col("_cuts").isNull(), 0).otherwise(chunk)).drop("_cuts")


def running_totals(df: DataFrame, key: str, order: str, sums: dict[str, Column],
                   chunk: Column | None = None, rows_each: int = 100_000) -> DataFrame:
    """Running sums per key in the order of a unique column.

    The order is cut into stretches, by `chunk` (which must never fall as `order` rises) or at sampled
    splitters of the keys with more than `rows_each` rows. Sums run inside a stretch, and each stretch
    starts from the total of the ones before it, so a key with very many rows is spread over its stretches.
    Only the stretch totals of a key meet in one task.
    """
    rows = stretches(df, key, order, rows_each) if chunk is None else df.withColumn("_chunk", chunk)
    for name, value in sums.items():
        rows = rows.withColumn(f"_v_{name}", value)
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(key, "_chunk").agg(
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    starts = starts.select(key, "_chunk", *[
        F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_s_{n}") for n in sums])
    inside = Window.partitionBy(key, "_chunk").orderBy(order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ran = rows.select(*df.columns, "_chunk",
                      *[F.sum(f"_v_{n}").over(inside).alias(f"_r_{n}") for n in sums])
    return ran.join(starts, [key, "_chunk"]).select(
        *df.columns, *[(F.col(f"_s_{n}") + F.col(f"_r_{n}")).alias(n) for n in sums])
