"""The streaming queries by name.

Each puts the tables' rows into topics in three rounds, by time, and runs its jobs
after every round from their checkpoints, as if restarted twice. It returns what
the jobs have stored, to be compared with the batch rule over the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart import schemas
from tidemart.functions.money import from_cents
from tidemart.functions.records import as_messages, parse_records
from tidemart.functions.times import day_before, event_time
from tidemart.operators import cdc, stats
from tidemart.plans import batch, reports
from tidemart.session import configure, drop_shuffles, new_workdir
from tidemart.sources import fixtures
from tidemart.sources.rollups import read_sums
from tidemart.sources.sinks import (append_batch, append_keyed, latest_documents, latest_rows, read_batches, read_dim, read_documents,
                                    upsert_dim)
from tidemart.sources.tables import Tables, parquet_tables
from tidemart.sources.topics import append_file_topic, file_topic, messages_writer, move_into_topic
from tidemart.streaming import jobs
from tidemart.streaming.run import each_batch, run_once

ORDER_CUTS = ("1997-03-01", "1999-06-01")
VISIT_CUTS = ("2024-01-11", "2024-01-21")

_QUERIES = {}


def query(fn: Callable[[SparkSession, Tables, str], DataFrame]):
    """Register a function of (session, table reader, working folder)."""
    def run(spark, folder):
        configure(spark)
        return fn(spark, parquet_tables(spark, folder), new_workdir(spark, fn.__name__))
    _QUERIES[fn.__name__] = run
    return fn


def stream_queries():
    return dict(_QUERIES)


def _round_of(day, cuts) -> Column:
    """Number of the round a day belongs to."""
    number = F.lit(0)
    for cut in cuts:
        number = number + F.when(day >= cut, 1).otherwise(0)
    return number


def _stage(df: DataFrame, day, cuts, path: str) -> list[str]:
    """Messages cut into rounds, each written once as a folder of a topic's files."""
    return _staged(df.select("value", F.coalesce(_round_of(day, cuts), F.lit(0)).alias("round")), len(cuts) + 1, path)


def _staged(df: DataFrame, rounds: int, path: str) -> list[str]:
    """(value, round) rows as a folder of topic files per round."""
    messages_writer(df).partitionBy("round").text(path)
    return [f"{path}/round={n}" for n in range(rounds)]


def _rounds(spark: SparkSession, topics: dict[str, list]) -> Iterator[int]:
    """Publish the next part of every topic folder, then let the caller run its jobs. A part is a staged folder,
    which goes into the topic as it is, or a DataFrame of messages, or several of these."""
    count = max(len(parts) for parts in topics.values())
    for n in range(count):
        for path, parts in topics.items():
            for part in (parts[n] if isinstance(parts[n], tuple) else (parts[n],)) if n < len(parts) else ():
                if isinstance(part, str):
                    move_into_topic(spark, part, path)
                else:
                    append_file_topic(part, path)
        drop_shuffles(spark)
        yield n


def _order_day():
    return F.substring(F.get_json_object("value", "$.create_time"), 1, 10)


def _log_day():
    return F.date_format(F.timestamp_millis(F.get_json_object("value", "$.ts").cast("long")), "yyyy-MM-dd")


def _order_messages(t: Tables) -> DataFrame:
    return as_messages(fixtures.order_info(t))


def _put_dims(t: Tables, dims: str) -> None:
    """Dimension tables as their jobs would have left them."""
    upsert_dim(fixtures.base_province(t), 0, f"{dims}/base_province", schemas.PROVINCE)
    append_keyed(batch.users(t), "id", 0, f"{dims}/user_info")


@query
def stream_dau(spark, t, work):
    parts = _stage(cdc.route_logs(fixtures.device_logs(t)).where(F.col("topic") == "log_start"),
                   _log_day(), VISIT_CUTS, f"{work}/staged")
    for _ in _rounds(spark, {f"{work}/starts": parts}):
        run_once(jobs.store_visits(file_topic(spark, f"{work}/starts"), f"{work}/visits"), f"{work}/cp")
    return read_batches(spark, f"{work}/visits", schemas.DAU).select(*schemas.DAU.fieldNames())


@query
def stream_first_order(spark, t, work):
    """First-order flag against the status table earlier batches have written."""
    _put_dims(t, f"{work}/dims")
    parts = _stage(_order_messages(t), _order_day(), ORDER_CUTS, f"{work}/staged")
    for _ in _rounds(spark, {f"{work}/orders": parts}):
        run_once(jobs.enrich_orders(file_topic(spark, f"{work}/orders"), f"{work}/dims", f"{work}/status",
                                    f"{work}/docs", f"{work}/dwd", by="month"), f"{work}/cp")
    return read_documents(spark, f"{work}/docs", schemas.ORDER_DOCUMENT).select("id", "user_id", "if_first_order")


@query
def stream_dim_refresh(spark, t, work):
    """SKU names follow their dimensions: a first round knows the brands under a
    former name, the second brings the right ones, then the lines are enriched."""
    dims = f"{work}/dims"
    upsert_dim(fixtures.base_category3(t), 0, f"{dims}/base_category3", schemas.CATEGORY3)
    upsert_dim(fixtures.spu_info(t), 0, f"{dims}/spu_info", schemas.SPU)
    former = fixtures.base_trademark(t).withColumn("tm_name", F.concat(F.lit("former "), "tm_name"))
    brands = [as_messages(fixtures.sent_brands(b)) for b in (former, fixtures.base_trademark(t))]
    skus = [as_messages(fixtures.sku_info(t, spread=True))] * 2
    for _ in _rounds(spark, {f"{work}/brands": brands, f"{work}/skus": skus}):
        run_once(jobs.keep_dim(file_topic(spark, f"{work}/brands"), schemas.TRADEMARK,
                               f"{dims}/base_trademark"), f"{work}/cp_brands")
        run_once(jobs.keep_skus(file_topic(spark, f"{work}/skus"), dims, f"{dims}/sku_info"),
                 f"{work}/cp_skus")
    append_file_topic(as_messages(fixtures.order_detail(t, spread=True)), f"{work}/details")
    run_once(jobs.enrich_details(file_topic(spark, f"{work}/details"), dims, f"{work}/dwd"), f"{work}/cp")
    out = schemas.ORDER_DETAIL_ENRICHED
    rows = spark.read.text(f"{work}/dwd", recursiveFileLookup=True)
    return rows.select(F.from_json("value", out).alias("r")).select("r.*").select(
        "id", "order_id", "sku_id", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name")


@query
def stream_interval_join(spark, t, work):
    """Orders and lines within the bound; returned lines come too late for theirs."""
    orders = t("orders").select(F.col("o_orderkey").alias("id"),
                                fixtures.order_time().cast("string").alias("create_time"))
    lines = fixtures.timed_detail(t, delay_returned=True).select("id", "order_id", "create_time")
    topics = {f"{work}/orders": _stage(as_messages(orders), _order_day(), ORDER_CUTS, f"{work}/s1"),
              f"{work}/lines": _stage(as_messages(lines), _order_day(), ORDER_CUTS, f"{work}/s2")}
    for _ in _rounds(spark, topics):
        left = file_topic(spark, f"{work}/orders").select(
            F.from_json("value", "id long, create_time string").alias("r")).select(
            F.col("r.id").alias("order_id"), event_time(F.col("r.create_time")).alias("_order_time"))
        right = file_topic(spark, f"{work}/lines").select(
            F.from_json("value", "id long, order_id long, create_time string").alias("r")).select(
            F.col("r.order_id").alias("order_id"), F.col("r.id").alias("order_detail_id"),
            event_time(F.col("r.create_time")).alias("_line_time"))
        pairs = jobs.pair_within(left.withWatermark("_order_time", jobs.LATENESS),
                                 right.withWatermark("_line_time", jobs.LATENESS))
        writer = pairs.select("order_id", "order_detail_id").writeStream.format("parquet") \
            .option("path", f"{work}/pairs")
        run_once(writer, f"{work}/cp", changelogs=False)
    return spark.read.schema("order_id long, order_detail_id long").parquet(f"{work}/pairs")


def _dwd_topics(t: Tables, work: str, twice: bool = False) -> dict[str, list[str]]:
    """Enriched order and line messages in rounds; lines sent twice when asked."""
    lines = batch.orders.join_sku(fixtures.timed_detail(t), batch.sku(t))
    if twice:
        lines = lines.unionByName(lines)
    return {f"{work}/orders": _stage(as_messages(batch.enriched_orders(t)), _order_day(), ORDER_CUTS,
                                     f"{work}/s1"),
            f"{work}/lines": _stage(as_messages(lines), _order_day(), ORDER_CUTS, f"{work}/s2")}


@query
def stream_order_wide(spark, t, work):
    """Windowed join of the two order streams; every line message comes twice."""
    for _ in _rounds(spark, _dwd_topics(t, work, twice=True)):
        rows = jobs.widen_orders(file_topic(spark, f"{work}/orders"), file_topic(spark, f"{work}/lines"))
        run_once(rows.writeStream.format("parquet").option("path", f"{work}/wide"), f"{work}/cp", changelogs=False)
    return spark.read.schema(schemas.ORDER_WIDE).parquet(f"{work}/wide").drop("final_detail_amount")


def _apportioned(spark, work: str, topic: str, brand_stat: str | None = None, hours: str | None = None) -> None:
    run_once(jobs.store_shares(file_topic(spark, topic), f"{work}/shares", brand_stat, hours, by="month"),
             f"{work}/cp_shares")
    done = jobs.complete_orders(file_topic(spark, topic))
    run_once(jobs.store_complete(done, f"{work}/done", brand_stat, hours, by="month"), f"{work}/cp_done")


def _paid(spark, work: str) -> DataFrame:
    return jobs.paid_rows(read_batches(spark, f"{work}/shares", schemas.STORED_WIDE),
                          read_batches(spark, f"{work}/done", schemas.DONE_ORDER))


@query
def stream_apportion(spark, t, work):
    parts = _stage(as_messages(batch.plain_wide(t)), _order_day(), ORDER_CUTS, f"{work}/staged")
    for _ in _rounds(spark, {f"{work}/wide": parts}):
        _apportioned(spark, work, f"{work}/wide")
    return _paid(spark, work).select("order_id", "order_detail_id", "final_total_amount",
                                     "final_detail_amount")


@query
def stream_sliding_window(spark, t, work):
    logs = fixtures.device_logs(t)
    parts = _stage(logs, _log_day(), VISIT_CUTS, f"{work}/staged")
    for _ in _rounds(spark, {f"{work}/logs": parts}):
        ms = F.get_json_object("value", "$.ts").cast("long")
        rows = file_topic(spark, f"{work}/logs").select(F.timestamp_millis(ms).alias("ts"))
        run_once(jobs.store_counts(jobs.sliding_counts(rows, "ts"), f"{work}/counts"), f"{work}/cp")
    counts = latest_documents(read_batches(spark, f"{work}/counts", schemas.WINDOW_COUNT), ("window_start",))
    return counts.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n")


def _brand_total(spark, path: str) -> DataFrame:
    rows = read_batches(spark, path, schemas.BRAND_STAT)
    return rows.groupBy(F.col("trademark_id").alias("tm_id"), F.col("trademark_name").alias("tm_name")).agg(
        stats.sum_amount("amount").alias("amount"))


@query
def stream_brand_amount(spark, t, work):
    parts = _stage(as_messages(batch.brand_wide(t)), _order_day(), ORDER_CUTS, f"{work}/staged")
    for _ in _rounds(spark, {f"{work}/wide": parts}):
        run_once(jobs.brand_stat(file_topic(spark, f"{work}/wide"), f"{work}/stat"), f"{work}/cp")
    return _brand_total(spark, f"{work}/stat")


@query
def stream_dim_versions(spark, t, work):
    """Users, SKUs and brands whose changes come several in a batch, in any order, some rounds too late, and end with
    a deletion: the change made last counts."""
    dims, ods = f"{work}/dims", f"{work}/ods"
    skus = t("part").select("p_partkey", "p_size").withColumn("id", F.col("p_partkey").cast("string")).join(
        fixtures.sku_info(t), "id").drop("p_partkey").withColumnRenamed("p_size", "_size")
    users = t("customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_acctbal").alias("_balance")).join(
        fixtures.user_info(t), "id")
    brands = fixtures.sent_brands(fixtures.base_trademark(t))
    sent = (fixtures.numbered_changes(users, "user_info", "user_level", F.col("_balance") < 0)
            .unionByName(fixtures.numbered_changes(skus, "sku_info", "sku_name", F.col("_size") > 45))
            .unionByName(fixtures.numbered_changes(brands, "base_trademark", "tm_name", F.col("tm_name") >= "Brand#5")))
    staged = _staged(sent, 3, f"{work}/staged")

    def topic(name: str) -> DataFrame:
        rows = spark.readStream.schema("value string, topic string").format("text").load(ods)
        return rows.where(F.col("topic") == f"ods_{name}").select("value")

    for _ in _rounds(spark, {f"{work}/db": staged}):
        run_once(jobs.split_topics(file_topic(spark, f"{work}/db"), lambda m: cdc.split_maxwell(m, arrival=True), ods),
                 f"{work}/cp_ods")
        run_once(jobs.keep_dim(topic("base_trademark"), schemas.TRADEMARK, f"{dims}/base_trademark"), f"{work}/cp_brand")
        run_once(jobs.keep_users(topic("user_info"), f"{dims}/user_info", fixtures.AS_OF), f"{work}/cp_user")
        run_once(jobs.keep_skus(topic("sku_info"), dims, f"{dims}/sku_info"), f"{work}/cp_sku")

    def named(kind: str, rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.lit(kind).alias("dim"), "id", F.col(name).alias("name"))
    return (named("user", latest_rows(spark, f"{dims}/user_info", schemas.USER_DESCRIBED), "user_level")
            .unionByName(named("sku", latest_rows(spark, f"{dims}/sku_info", schemas.SKU_ENRICHED), "sku_name"))
            .unionByName(named("brand", read_dim(spark, f"{dims}/base_trademark", schemas.TRADEMARK), "tm_name")))


@query
def stream_doc_upsert(spark, t, work):
    """Order documents by day and id. Every order comes as created first; half-done ones a second time in the same
    batch, finished ones again a round later: one document each, in its last form and with the flag it had."""
    _put_dims(t, f"{work}/dims")
    orders = fixtures.order_info(t)
    day = F.substring("create_time", 1, 10)
    status = F.col("order_status")
    first = orders.withColumn("order_status", F.when(status == "O", status).otherwise("created"))
    again = orders.where(status != "O")
    number = F.coalesce(_round_of(day, ORDER_CUTS), F.lit(0))
    sent = first.select("*", F.lit(1).alias("_seq"), number.alias("round")).unionByName(
        again.select("*", F.lit(2).alias("_seq"), (number + F.when(status == "F", 1).otherwise(0)).alias("round")))
    columns = [c for c in sent.columns if c != "round"]
    staged = _staged(sent.select(F.to_json(F.struct(*columns)).alias("value"), "round"), 4, f"{work}/staged")
    for _ in _rounds(spark, {f"{work}/orders": staged}):
        run_once(jobs.enrich_orders(file_topic(spark, f"{work}/orders"), f"{work}/dims", f"{work}/status",
                                    f"{work}/docs", f"{work}/dwd", by="month"), f"{work}/cp")
    return read_documents(spark, f"{work}/docs", schemas.ORDER_DOCUMENT).select(
        "dt", "id", "user_id", "order_status", "if_first_order")


@query
def stream_dead_letters(spark, t, work):
    """What every layer takes and what it leaves out, with the reason; the two add up to what was sent.

    Broken envelopes, tables nobody wants, deleted orders and users without data end at the split; half-done orders
    have a user that is no number, lines and wide rows of more than forty pieces a count or price that is none,
    logs of type `error` are cut off."""
    dims, ods, dead = f"{work}/dims", f"{work}/ods", f"{work}/dead"
    status = F.col("order_status")
    orders = fixtures.order_info(t)
    heads = orders.withColumn("user_id", F.when(status == "P", "unknown").otherwise(F.col("user_id").cast("string")))
    count = F.col("sku_num")
    lines = fixtures.order_detail(t).withColumn("sku_num", F.when(count > 40, "none").otherwise(count.cast("string")))
    users = fixtures.user_info(t).join(
        t("customer").select(F.col("c_custkey").cast("string").alias("id"), "c_acctbal"), "id")
    body = F.when(F.col("c_acctbal") >= 0, F.struct("id", "user_level", "birthday", "gender"))
    insert = F.lit("insert")
    db = (fixtures.envelope(heads, "order_info", F.when(status == "F", "delete").otherwise(insert))
          .unionByName(fixtures.envelope(lines, "order_detail", insert))
          .unionByName(fixtures.envelope(users, "user_info", insert, body))
          .unionByName(fixtures.envelope(t("supplier").select("s_suppkey"), "supplier_info", insert))
          .unionByName(t("nation").select(F.concat(F.lit('{"table":"base_province","data":{"id":'), "n_nationkey").alias("value"))))
    value = F.col("value")
    logs = fixtures.device_logs(t).select(
        F.when(F.get_json_object("value", "$.common.ch") == "error", F.substring(value, 1, 20)).otherwise(value).alias("value"))
    price = F.col("sku_price").cast("string")
    wide = as_messages(batch.plain_wide(t).withColumn("sku_price", F.when(count > 40, "none").otherwise(price)))

    def halves(df: DataFrame, name: str) -> list[str]:
        return _staged(df.select("value", (F.crc32("value") % 2).cast("int").alias("round")), 2, f"{work}/s_{name}")

    def topic(name: str) -> DataFrame:
        rows = spark.readStream.schema("value string, topic string").format("text").load(ods)
        return rows.where(F.col("topic") == f"ods_{name}").select("value")

    for _ in _rounds(spark, {f"{work}/db": halves(db, "db"), f"{work}/logs": halves(logs, "logs"), f"{work}/wide": halves(wide, "wide")}):
        changes = file_topic(spark, f"{work}/db")
        run_once(jobs.split_topics(changes, cdc.split_maxwell, ods), f"{work}/cp_ods")
        run_once(jobs.keep_left_out(changes, cdc.left_out_maxwell, f"{dead}/split"), f"{work}/cp_out")
        run_once(jobs.keep_users(topic("user_info"), f"{dims}/user_info", fixtures.AS_OF, dead), f"{work}/cp_user")
        run_once(jobs.enrich_orders(topic("order_info"), dims, f"{work}/status", f"{work}/docs", f"{work}/dwd_orders", dead, by="month"),
                 f"{work}/cp_orders")
        run_once(jobs.enrich_details(topic("order_detail"), dims, f"{work}/dwd_lines", dead), f"{work}/cp_lines")
        run_once(jobs.store_visits(file_topic(spark, f"{work}/logs"), f"{work}/visits", f"{work}/hours", dead=dead), f"{work}/cp_visits")
        run_once(jobs.store_shares(file_topic(spark, f"{work}/wide"), f"{work}/shares", dead=dead, by="month"), f"{work}/cp_shares")

    taken = {"split": spark.read.schema("value string, topic string").text(ods),
             "users": read_batches(spark, f"{dims}/user_info", schemas.USER_DESCRIBED),
             "orders": read_batches(spark, f"{work}/docs", schemas.ORDER_DOCUMENT),
             "details": spark.read.text(f"{work}/dwd_lines", recursiveFileLookup=True),
             "shares": read_batches(spark, f"{work}/shares", schemas.STORED_WIDE)}
    out = None
    for job in (*taken, "visits"):
        parts = [read_batches(spark, f"{dead}/{job}", schemas.LEFT_OUT).select("reason")]
        if job in taken:
            parts.append(taken[job].select(F.lit("taken").alias("reason")))
        for part in parts:
            n = part.groupBy(F.lit(job).alias("job"), F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
            out = n if out is None else out.unionByName(n)
    return out


@query
def stream_hour_rollup(spark, t, work):
    """Sales by day and hour from the sums the jobs keep: shares as lines come, rests as orders become complete."""
    parts = _stage(as_messages(batch.plain_wide(t)), _order_day(), ORDER_CUTS, f"{work}/staged")
    for _ in _rounds(spark, {f"{work}/wide": parts}):
        _apportioned(spark, work, f"{work}/wide", hours=f"{work}/hours")
    sums = read_sums(spark, f"{work}/hours/lines", f"{work}/hours/rest")
    return sums.select("dt", "hr", from_cents(F.col("value")).alias("amount"))


@query
def stream_new_devices(spark, t, work):
    """New devices by day from a register of all devices. The rounds come in another order than the days, so that
    devices already counted turn out to have been there before."""
    starts = cdc.route_logs(fixtures.device_logs(t)).where(F.col("topic") == "log_start")
    parts = _stage(starts, _log_day(), VISIT_CUTS, f"{work}/staged")
    for _ in _rounds(spark, {f"{work}/starts": [parts[1], parts[2], parts[0]]}):
        run_once(jobs.store_visits(file_topic(spark, f"{work}/starts"), f"{work}/visits", f"{work}/hours", f"{work}/seen"),
                 f"{work}/cp")
    return read_sums(spark, f"{work}/hours/new").where(F.col("value") != 0).select("dt", F.col("value").alias("new_mid"))


@query
def stream_day_cards(spark, t, work):
    """The day cards and the hour series of a day of sales and a day of visits, from the sums the jobs keep."""
    starts = cdc.route_logs(fixtures.device_logs(t)).where(F.col("topic") == "log_start")
    topics = {f"{work}/wide": _stage(as_messages(batch.plain_wide(t)), _order_day(), ORDER_CUTS, f"{work}/s1"),
              f"{work}/starts": _stage(starts, _log_day(), VISIT_CUTS, f"{work}/s2")}
    hours = f"{work}/hours"
    for _ in _rounds(spark, topics):
        _apportioned(spark, work, f"{work}/wide", hours=hours)
        run_once(jobs.store_visits(file_topic(spark, f"{work}/starts"), f"{work}/visits", hours, f"{work}/seen"), f"{work}/cp")
    out = None
    for day in (batch.SALES_DAY, batch.VISIT_DAY):
        both = [day, day_before(day)]
        visits, new = (read_sums(spark, f"{hours}/{name}", days=both) for name in ("visits", "new"))
        sales = read_sums(spark, f"{hours}/lines", f"{hours}/rest", days=both)
        cards = reports.day_cards(visits, new, sales, day).select(
            F.lit("cards").alias("request"), F.col("id").alias("key"), F.col("value").alias("today"),
            F.lit(None).cast("double").alias("yesterday"))
        series = reports.today_and_yesterday(visits, "value", day).select(
            F.lit("dau").alias("request"), F.col("hr").alias("key"), *[F.col(c).cast("double").alias(c) for c in ("today", "yesterday")])
        amounts = reports.today_and_yesterday(sales, "value", day).select(
            F.lit("order_amount").alias("request"), F.col("hr").alias("key"), *[from_cents(F.col(c)).alias(c) for c in ("today", "yesterday")])
        here = cards.unionByName(series).unionByName(amounts).withColumn("day", F.lit(day))
        out = here if out is None else out.unionByName(here)
    return out


# What drives the watermark past a round: just not ten minutes after its end.
TICKS = ("1997-03-01 00:09:59", "1999-06-01 00:09:59", "2002-01-01 00:00:00")


def _ticks(spark, *records: str) -> DataFrame:
    return spark.createDataFrame([(r,) for r in records], "value string")


@query
def stream_unmatched_lines(spark, t, work):
    """Each line's outcome: returned lines come too late for their orders and are given out alone, accepted ones are
    sent when the watermark has passed and get no row, the others are matched."""
    orders = t("orders").select(F.col("o_orderkey").alias("id"), fixtures.order_time().cast("string").alias("create_time"))
    lines = fixtures.timed_detail(t, delay_returned=True).select("id", "order_id", "create_time")
    late = t("lineitem").where(F.col("l_returnflag") == "A").select(fixtures.line_id().alias("id"), F.lit(1).alias("late"))
    lines = lines.join(late, "id", "left").select(
        F.to_json(F.struct("id", "order_id", "create_time")).alias("value"),
        (F.coalesce(_round_of(F.substring("create_time", 1, 10), ORDER_CUTS), F.lit(0)) + F.coalesce("late", F.lit(0))).alias("round"))
    staged = _staged(lines, 4, f"{work}/s2")
    heads = _stage(as_messages(orders), _order_day(), ORDER_CUTS, f"{work}/s1")
    heads = [(h, _ticks(spark, f'{{"id":-1,"create_time":"{tick}"}}')) for h, tick in zip(heads, TICKS)]
    parts = [(p, _ticks(spark, f'{{"id":-1,"order_id":-2,"create_time":"{tick}"}}')) for p, tick in zip(staged, TICKS)] + staged[3:]
    for _ in _rounds(spark, {f"{work}/orders": heads, f"{work}/lines": parts}):
        left = file_topic(spark, f"{work}/orders").select(
            F.from_json("value", "id long, create_time string").alias("r")).select(
            F.col("r.id").alias("order_id"), event_time(F.col("r.create_time")).alias("_order_time"))
        right = file_topic(spark, f"{work}/lines").select(
            F.from_json("value", "id long, order_id long, create_time string").alias("r")).select(
            F.col("r.order_id").alias("order_id"), F.col("r.id").alias("order_detail_id"),
            event_time(F.col("r.create_time")).alias("_line_time"))
        pairs = jobs.pair_or_leave(left.withWatermark("_order_time", jobs.LATENESS),
                                   right.withWatermark("_line_time", jobs.LATENESS))
        run_once(each_batch(pairs.select("order_id", "order_detail_id", "matched"),
                            lambda df, n: append_batch(df, n, f"{work}/outcomes")), f"{work}/cp", changelogs=False)
    found = read_batches(spark, f"{work}/outcomes", schemas.LINE_OUTCOME).where(F.col("order_id") >= 0)
    sent = spark.read.text(f"{work}/lines", recursiveFileLookup=True).select(F.from_json("value", "id long, order_id long").alias("r")).select(
        F.col("r.id").alias("order_detail_id"), F.col("r.order_id").alias("order_id")).where(F.col("order_id") >= 0)
    rest = sent.join(found, "order_detail_id", "left_anti").select("order_id", "order_detail_id", F.lit("late").alias("outcome"))
    return found.select("order_id", "order_detail_id", F.when(F.col("matched"), "matched").otherwise("unmatched").alias("outcome")) \
        .unionByName(rest)


@query
def stream_unfinished_orders(spark, t, work):
    """Every order whose returned lines never come: complete without them, or given out ten minutes after its time with
    what is open. What lines have got and what none has got add up to what was paid."""
    returned = t("lineitem").where(F.col("l_returnflag") == "R").select(fixtures.line_id().alias("order_detail_id"))
    wide = batch.plain_wide(t).join(returned, "order_detail_id", "left_anti")
    parts = _stage(as_messages(wide), _order_day(), ORDER_CUTS, f"{work}/staged")
    tick = ('{{"order_id":-1,"order_detail_id":-1,"sku_price":1,"sku_num":1,"original_total_amount":1,"final_total_amount":1,'
            '"create_time":"{}","dt":"none"}}')
    parts = [(p, _ticks(spark, tick.format(m))) for p, m in zip(parts, TICKS)]
    for _ in _rounds(spark, {f"{work}/wide": parts}):
        _apportioned(spark, work, f"{work}/wide")
        run_once(jobs.store_unfinished(jobs.unfinished_orders(file_topic(spark, f"{work}/wide")), f"{work}/open", by="month"), f"{work}/cp_open")
    done = read_batches(spark, f"{work}/done", schemas.DONE_ORDER).where(F.col("order_id") >= 0)
    left = read_batches(spark, f"{work}/open", schemas.UNFINISHED_ORDER).where(F.col("order_id") >= 0)
    return done.select("order_id", F.lit("complete").alias("state"), F.lit(0.0).alias("open_amount"),
                       from_cents(F.col("rest")).alias("unshared")).unionByName(
        left.select("order_id", F.lit("unfinished").alias("state"), from_cents(F.col("listed") - F.col("came")).alias("open_amount"),
                    from_cents(F.col("paid") - F.col("shared")).alias("unshared")))


class _Lost(Exception):
    """Stands for a driver that goes away after its output and before its commit."""


@query
def stream_idempotent_replay(spark, t, work):
    """Brand sums when every batch is written, lost before it counts as done, and
    run again by the restarted query."""
    parts = _stage(as_messages(batch.brand_wide(t)), _order_day(), ORDER_CUTS, f"{work}/staged")

    def write_then_fail(df, batch_id):
        jobs.store_brand_stat(df, batch_id, f"{work}/stat")
        raise _Lost()

    for _ in _rounds(spark, {f"{work}/wide": parts}):
        rows = parse_records(file_topic(spark, f"{work}/wide"), schemas.ORDER_WIDE)
        try:
            run_once(each_batch(rows, write_then_fail, keep=False), f"{work}/cp")
        except Exception as e:
            if "_Lost" not in str(e):
                raise
        run_once(jobs.brand_stat(file_topic(spark, f"{work}/wide"), f"{work}/stat"), f"{work}/cp")
    return _brand_total(spark, f"{work}/stat")


@query
def stream_layers(spark, t, work):
    """All layers in a row: change records are split by table, dimensions kept,
    orders and lines enriched, joined, paid shares spread and brands summed. Every
    order is inserted; those no longer open are updated, too."""
    dims, ods = f"{work}/dims", f"{work}/ods"
    orders = fixtures.order_info(t)
    updated = fixtures.envelope(orders.where(F.col("order_status") != "O"), "order_info", F.lit("update"))
    facts = fixtures.envelope(orders, "order_info", F.lit("insert")).unionByName(updated).unionByName(
        fixtures.envelope(fixtures.timed_detail(t), "order_detail", F.lit("insert")))
    day = F.substring(F.get_json_object("value", "$.data.create_time"), 1, 10)
    parts = _stage(facts, day, ORDER_CUTS, f"{work}/staged")
    sides = {"base_province": fixtures.base_province(t), "user_info": fixtures.user_info(t),
             "base_trademark": fixtures.sent_brands(fixtures.base_trademark(t)), "base_category3": fixtures.base_category3(t),
             "spu_info": fixtures.spu_info(t), "sku_info": fixtures.sku_info(t)}
    for name, df in sides.items():
        append_file_topic(fixtures.envelope(df, name, F.lit("insert")), f"{work}/db")

    def topic(name: str) -> DataFrame:
        rows = spark.readStream.schema("value string, topic string").format("text").load(ods)
        return rows.where(F.col("topic") == f"ods_{name}").select("value")

    for _ in _rounds(spark, {f"{work}/db": parts}):
        run_once(jobs.split_topics(file_topic(spark, f"{work}/db"), cdc.split_maxwell, ods), f"{work}/cp_ods")
        for name in ("base_province", "base_trademark", "base_category3", "spu_info"):
            run_once(jobs.keep_dim(topic(name), schemas.DIM_SCHEMAS[name], f"{dims}/{name}"), f"{work}/cp_{name}")
        run_once(jobs.keep_users(topic("user_info"), f"{dims}/user_info", fixtures.AS_OF), f"{work}/cp_user")
        run_once(jobs.keep_skus(topic("sku_info"), dims, f"{dims}/sku_info"), f"{work}/cp_sku")
        run_once(jobs.enrich_orders(topic("order_info"), dims, f"{work}/status", f"{work}/docs",
                                    f"{work}/dwd_orders", by="month"), f"{work}/cp_orders")
        run_once(jobs.enrich_details(topic("order_detail"), dims, f"{work}/dwd_lines"), f"{work}/cp_lines")
        wide = jobs.widen_orders(file_topic(spark, f"{work}/dwd_orders"), file_topic(spark, f"{work}/dwd_lines"))
        run_once(jobs.publish(wide, f"{work}/wide"), f"{work}/cp_wide", changelogs=False)
        _apportioned(spark, work, f"{work}/wide", f"{work}/stat")
    both = read_batches(spark, f"{work}/stat/part=lines", schemas.BRAND_STAT).unionByName(
        read_batches(spark, f"{work}/stat/part=rest", schemas.BRAND_STAT))
    return both.groupBy(F.col("trademark_id").alias("tm_id"), F.col("trademark_name").alias("tm_name")).agg(
        stats.sum_amount("amount").alias("amount"))
