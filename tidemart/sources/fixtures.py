"""The warehouse's input records, made from the TPC-H-like test tables.

Times of day, birthdays and genders are derived from keys because the tables
hold none; no row of any table is left out. `days` bounds (first day, day after
the last) reach the parquet scan as plain comparisons on the stored column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.money import from_cents, line_cents, to_cents
from tidemart.functions.records import once, to_record
from tidemart.sources.tables import Tables

AS_OF = "2001-08-01"

Days = tuple[str, str] | None


def _between(moment: Column, days: Days) -> Column:
    low, high = days
    return (moment >= F.lit(low).cast("timestamp_ntz")) & (moment < F.lit(high).cast("timestamp_ntz"))


def order_time() -> Column:
    """Midnight of the order's day plus a time of day derived from its key."""
    hours, minutes = (F.col("o_orderkey") * 7919) % 24, F.col("o_orderkey") % 60
    return F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), hours.cast("int"), minutes.cast("int"), F.lit(0))


def _orders(t: Tables, days: Days) -> DataFrame:
    orders = t("orders")
    return orders if days is None else orders.where(_between(F.col("o_orderdate"), days))


def line_id() -> Column:
    """A number from the columns that tell lines apart; it rises with the order, then with the line number."""
    what = (F.col("l_partkey") * 1009 + F.col("l_suppkey")) * 51 + F.col("l_quantity").cast("long")
    tail = what % 100_000_000
    return F.col("l_orderkey") * 1_000_000_000 + F.col("l_linenumber") * 100_000_000 + tail


def line_name() -> Column:
    """What the line says was bought: the SKU and how many of it."""
    return F.concat(F.lit("item "), F.col("l_partkey"), F.lit(" x"), F.col("l_quantity").cast("long"))


def order_detail(t: Tables, days: Days = None, spread: bool = False) -> DataFrame:
    """Order lines."""
    lines = t.spread("lineitem") if spread else t("lineitem")
    if days is not None:
        wanted = _orders(t, days).select(F.col("o_orderkey").alias("l_orderkey"))
        lines = lines.join(wanted, "l_orderkey", "left_semi")
    count = F.col("l_quantity").cast("long")
    return lines.select(
        line_id().alias("id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("order_price"),
        count.alias("sku_num"), line_name().alias("sku_name"))


def order_info(t: Tables, days: Days = None, province: bool = True) -> DataFrame:
    """All orders; the listed total is the sum of the lines, 0 without lines. The left
    join onto it is dropped by Spark where no amount is asked for. Without `province`
    that column is null and the customers are not joined."""
    listed = order_detail(t, days).groupBy("order_id").agg(
        F.sum(line_cents(F.col("order_price"), F.col("sku_num"))).alias("_listed"))
    orders = (_orders(t, days).join(listed, F.col("o_orderkey") == F.col("order_id"), "left")
              .withColumn("_listed", F.coalesce("_listed", F.lit(0).cast("long"))))
    place = F.lit(None).cast("long")
    if province:
        customers = t("customer").select("c_custkey", "c_nationkey")
        orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        place = F.col("c_nationkey").cast("long")
    paid = to_cents(F.col("o_totalprice"))
    return orders.select(
        F.col("o_orderkey").alias("id"), place.alias("province_id"),
        F.col("o_orderstatus").alias("order_status"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("final_total_amount"),
        from_cents(F.greatest(F.col("_listed") - paid, F.lit(0))).alias("benefit_reduce_amount"),
        from_cents(F.col("_listed")).alias("original_total_amount"),
        from_cents(F.greatest(paid - F.col("_listed"), F.lit(0))).alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        order_time().cast("string").alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"))


def timed_detail(t: Tables, delay_returned: bool = False) -> DataFrame:
    """Lines with a `create_time`: five seconds per line number after the order.
    With `delay_returned`, returned lines come two minutes later instead."""
    keys = t("lineitem").select(
        F.col("l_orderkey").alias("order_id"), line_id().alias("id"), line_name().alias("sku_name"), "l_linenumber",
        "l_returnflag", "l_partkey", "l_quantity", "l_extendedprice")
    after = F.col("l_linenumber") * 5
    if delay_returned:
        after = F.when(F.col("l_returnflag") == "R", 120).otherwise(after)
    orders = t("orders").select(F.col("o_orderkey").alias("order_id"), order_time().alias("_t"))
    moment = F.col("_t") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), after)
    count = F.col("l_quantity").cast("long")
    return keys.join(orders, "order_id").select(
        "id", "order_id", F.col("l_partkey").alias("sku_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("order_price"),
        count.alias("sku_num"), "sku_name",
        moment.cast("string").alias("create_time"))


def base_province(t: Tables) -> DataFrame:
    return t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"),
        F.col("r_name").alias("area_code"),
        F.concat(F.lit("ISO-"), F.col("n_nationkey")).alias("iso_code"))


def user_info(t: Tables) -> DataFrame:
    age = ((F.col("c_custkey") * 37) % 20000).cast("int") + 3650
    code = F.col("c_custkey") % 3
    return t("customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("user_level"),
        F.date_sub(F.lit(AS_OF).cast("date"), age).cast("string").alias("birthday"),
        F.when(code == 0, "M").when(code == 1, "F").alias("gender"))


def base_trademark(t: Tables) -> DataFrame:
    return t("part").select(F.regexp_extract("p_brand", r"(\d+)", 1).alias("id"),
                            F.col("p_brand").alias("tm_name")).distinct()


def sent_brands(brands: DataFrame) -> DataFrame:
    """Brand rows as the source database names their columns."""
    return brands.withColumnRenamed("id", "tm_id")


def base_category3(t: Tables) -> DataFrame:
    return t("part").select(F.lower("p_type").alias("id"), F.col("p_type").alias("name")).distinct() \
        .withColumn("category2_id", F.lit("1"))


def spu_info(t: Tables) -> DataFrame:
    return t("part").select(F.translate("p_name", " ", "-").alias("id"),
                            F.col("p_name").alias("spu_name")).distinct()


def sku_info(t: Tables, spread: bool = False) -> DataFrame:
    parts = t.spread("part") if spread else t("part")
    return parts.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.translate("p_name", " ", "-").alias("spu_id"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.concat(F.lit("item "), F.col("p_partkey")).alias("sku_name"),
        F.regexp_extract("p_brand", r"(\d+)", 1).alias("tm_id"),
        F.lower("p_type").alias("category3_id"),
        F.lit("1995-01-01 00:00:00").alias("create_time"))


def device_logs(t: Tables, days: Days = None) -> DataFrame:
    """Device log messages: events of type `error` have no `start` object."""
    events = t.spread("events")
    if days is not None:
        events = events.where(_between(F.col("ts"), days))
    user = F.col("user_id").cast("string")
    common = F.struct(F.concat(F.lit("mid_"), user).alias("mid"), user.alias("uid"),
                      F.get_json_object("props", "$.k").alias("ar"),
                      F.col("event_type").alias("ch"), F.lit("v1").alias("vc"))
    start = F.when(F.col("event_type") != "error",
                   F.struct(F.lit("icon").alias("entry"), F.col("event_id")))
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    record = events.select(common.alias("common"), start.alias("start"), ms.alias("ts"))
    return record.select(once(to_record(record)).alias("value"))


def canal_envelopes(t: Tables) -> DataFrame:
    """One envelope per order line and one per order; half-done orders are updates."""
    details = order_detail(t, spread=True)
    lines = details.select(F.lit("order_detail").alias("table"), F.lit("INSERT").alias("type"),
                           F.array(F.struct(*details.columns)).alias("data"))
    orders = t("orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"))
    kind = F.when(F.col("order_status") == "P", "UPDATE").otherwise("INSERT")
    heads = orders.select(F.lit("order_info").alias("table"), kind.alias("type"),
                          F.array(F.struct(*orders.columns)).alias("data"))
    return lines.select(once(to_record(lines)).alias("value")).unionByName(
        heads.select(once(to_record(heads)).alias("value")))


def canal_text_envelopes(t: Tables) -> DataFrame:
    """Envelopes as the source database sends them: every value a text, several rows in
    one record. Each order comes with its deposit, which has the negative id and a
    quarter of the amount; half-done orders have a user id that is no number."""
    user = F.when(F.col("o_orderstatus") == "P", F.lit("unknown")).otherwise(F.col("o_custkey").cast("string"))
    cents = to_cents(F.col("o_totalprice"))

    def row(key: Column, amount: Column) -> Column:
        return F.struct(key.cast("string").alias("id"), user.alias("user_id"),
                        F.col("o_orderstatus").alias("order_status"),
                        amount.cast("string").alias("final_total_amount"))
    key = F.col("o_orderkey")
    data = F.array(row(key, from_cents(cents)), row(-key, from_cents(F.floor(cents / 4))))
    out = t("orders").select(F.lit("order_info").alias("table"), F.lit("INSERT").alias("type"), data.alias("data"))
    return out.select(once(to_record(out)).alias("value"))


def envelope(df: DataFrame, table: str, kind: Column, data: Column | None = None) -> DataFrame:
    body = F.struct(*df.columns) if data is None else data
    out = df.select(F.lit(table).alias("table"), kind.alias("type"), body.alias("data"))
    return out.select(once(to_record(out)).alias("value"))


def numbered_changes(df: DataFrame, table: str, name: str, gone: Column, rounds: int = 3) -> DataFrame:
    """(value, round): three changes of every row, in envelopes with their time and number. The first has another
    `name` that sorts behind the right one, the second the right one; where `gone` holds, the third deletes the row.
    Half of the rows send all their changes in one round, the others each in another one, later ones also first."""
    key = F.crc32(F.coalesce(*[c for c in ("id", "tm_id") if c in df.columns]))
    columns = [c for c in df.columns if not c.startswith("_")]
    out = None
    for number, (kind, ts) in enumerate((("insert", 1000), ("update", 1000), ("delete", 1001)), 1):
        rows = df.where(gone) if kind == "delete" else df
        rows = rows if kind == "update" else rows.withColumn(name, F.concat(F.lit("zz "), name))
        body = rows.select(
            F.struct(F.lit(table).alias("table"), F.lit(kind).alias("type"), F.lit(ts).alias("ts"), F.lit(number).alias("seq"),
                     F.struct(*columns).alias("data")).alias("r"),
            F.when(key % 2 == 0, key % rounds).otherwise((key + 2 * number) % rounds).cast("int").alias("round"))
        body = body.select(once(F.to_json("r")).alias("value"), "round")
        out = body if out is None else out.unionByName(body)
    return out


def maxwell_envelopes(t: Tables) -> DataFrame:
    """Change records of all tables: orders in three kinds, users with an empty
    record where the balance is below zero, and a table nobody wants."""
    kinds = F.when(F.col("order_status") == "P", "update") \
        .when(F.col("order_status") == "F", "delete").otherwise("insert")
    orders = t("orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"))
    users = t("customer").select(F.col("c_custkey").cast("string").alias("id"),
                                 F.col("c_mktsegment").alias("user_level"), "c_acctbal")
    user_body = F.when(F.col("c_acctbal") >= 0, F.struct("id", "user_level"))
    suppliers = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    parts = [
        envelope(orders, "order_info", kinds),
        envelope(order_detail(t, spread=True), "order_detail", F.lit("insert")),
        envelope(users, "user_info", F.lit("bootstrap-insert"), user_body),
        envelope(base_province(t), "base_province", F.lit("update")),
        envelope(sku_info(t), "sku_info", F.lit("delete")),
        envelope(suppliers, "supplier_info", F.lit("insert")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
