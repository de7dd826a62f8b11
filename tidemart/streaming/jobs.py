"""The streaming jobs, layer by layer.

Each job takes streaming DataFrames and gives a writer for `run.start`. Jobs that
look something up in a table read it anew in every batch; they hand the keys of
the batch to the table, never the table to the batch.

With `dead`, a job keeps the messages it cannot take, and why, under `<dead>/<job>/batch_id=<n>`: replaced with the batch
when that is run again, so that what was taken and what was left out add up to what was sent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tidemart import schemas
from tidemart.functions.money import from_cents, to_cents
from tidemart.functions.records import as_messages, marked_records, parse_records, split_marked, split_readable
from tidemart.functions.times import event_time, hour_of_text
from tidemart.operators import dau, orders as order_rules, stats
from tidemart.operators.dims import broadcast_if_few, describe_users, enrich_sku, keys_of
from tidemart.operators.wide import detail_side, order_side, with_line_shares
from tidemart.sources.rollups import add_sums
from tidemart.sources.sinks import (append_batch, append_folders, append_keyed, folders_of, keep_short, land_raw, latest_by_key,
                                    latest_rows, read_dim, rows_of_keys, upsert_dim)
from tidemart.sources.topics import COMPRESSION, messages_writer
from tidemart.streaming.run import each_batch

LATENESS = "10 minutes"
PAIR_BOUND = "50 seconds"


def _taken(df: DataFrame, schema: StructType, batch_id: int, dead: str | None, job: str, *keep: str) -> DataFrame:
    """The batch's readable records; the others go to the job's own folder of left-out messages."""
    if dead is None:
        return parse_records(df, schema, "value", *keep)
    rows, out = split_readable(df, schema, "value", *keep)
    if not out.isEmpty():
        append_batch(out, batch_id, f"{dead}/{job}")
    return rows


@contextmanager
def _taken_once(df: DataFrame, schema: StructType, batch_id: int, dead: str | None, job: str, persist: bool = False) -> Iterator[DataFrame]:
    """As `_taken`, for large batches: where what is left out is asked for, too, or with `persist`, every message is read
    once and its record kept until the end."""
    if dead is None:
        rows = kept = parse_records(df, schema)
    else:
        kept, persist = marked_records(df, schema), True
        rows, out = split_marked(kept)
    if persist:
        kept.persist()
    try:
        if dead is not None and not out.isEmpty():
            append_batch(out, batch_id, f"{dead}/{job}")
        yield rows
    finally:
        if persist:
            kept.unpersist()


def _changes(df: DataFrame, schema: StructType, batch_id: int, dead: str | None, job: str) -> DataFrame:
    """Changes of a dimension with their place in the order of changes: as the message says, else as the
    topic does (its time stamp and offset, where it has them)."""
    topic = [c for c in ("timestamp", "offset") if c in df.columns]
    rows = _taken(df, schemas.arriving(schema), batch_id, dead, job, *topic)
    if "timestamp" in topic:
        rows = rows.withColumn("_ts", F.coalesce("_ts", F.unix_millis("timestamp")))
    if "offset" in topic:
        rows = rows.withColumn("_seq", F.coalesce("_seq", "offset"))
    return rows.withColumn("_deleted", F.coalesce(F.lower("_op") == "delete", F.lit(False))).drop("_op", *topic)


# --- ODS: split by table ----------------------------------------------------

def split_topics(messages: DataFrame, split: Callable[[DataFrame], DataFrame], out: str) -> DataStreamWriter:
    """Route messages (`split` gives `topic` and `value`) into one folder per topic.
    The file sink's own log makes each message appear once."""
    return (split(messages).select("topic", "value").writeStream.format("text")
            .partitionBy("topic").option("compression", COMPRESSION).option("path", out))


def keep_left_out(messages: DataFrame, left_out: Callable[[DataFrame], DataFrame], out: str) -> DataStreamWriter:
    """What a job without a sink of its own leaves out of a topic: (value, reason) rows by `left_out`."""
    return each_batch(left_out(messages), lambda df, n: append_batch(df, n, out), keep=False)


def unreadable(schema: StructType) -> Callable[[DataFrame], DataFrame]:
    """What a job that parses this record leaves out, for `keep_left_out`."""
    return lambda messages: split_readable(messages, schema)[1]


def land_logs(messages: DataFrame, out: str) -> DataStreamWriter:
    """Keep raw device logs, one folder per day of their time stamp."""
    day = F.date_format(F.timestamp_millis(F.get_json_object("value", "$.ts").cast("long")), "yyyy-MM-dd")
    return each_batch(messages.select("value", day.alias("dt")), lambda df, n: land_raw(df, n, out))


# --- DIM ----------------------------------------------------------------------

def keep_dim(messages: DataFrame, schema: StructType, out: str, dead: str | None = None) -> DataStreamWriter:
    """The last change per id of one dimension topic, in the order the changes were made."""
    def sink(df: DataFrame, batch_id: int) -> None:
        brands = schema == schemas.TRADEMARK
        rows = _changes(df, schemas.TRADEMARK_MESSAGE if brands else schema, batch_id, dead, "dim")
        if brands:
            rows = rows.withColumn("id", F.coalesce("id", "tm_id")).drop("tm_id")
        upsert_dim(rows, batch_id, out, schema)
    return each_batch(messages, sink)


def _store_changes(rows: DataFrame, batch_id: int, out: str, schema: StructType) -> None:
    """Changes of a large dimension, one per id and batch, to its log (see `sinks.latest_rows`)."""
    full = schemas.extended(schemas.versioned(schema), bucket=schemas.BUCKET)
    keep_short(rows.sparkSession, out, full, batch_id, key="id", partitions=("bucket",))
    append_keyed(rows, "id", batch_id, out)


def keep_users(messages: DataFrame, out: str, as_of: str | None = None, dead: str | None = None) -> DataStreamWriter:
    """Described users, appended batch by batch."""
    def sink(df: DataFrame, batch_id: int) -> None:
        day = None if as_of is None else F.lit(as_of).cast("date")
        rows = latest_by_key(_changes(df, schemas.USER, batch_id, dead, "users"), "id", schemas.VERSION)
        _store_changes(describe_users(rows, day), batch_id, out, schemas.USER_DESCRIBED)
    return each_batch(messages, sink)


def keep_skus(messages: DataFrame, dims: str, out: str, dead: str | None = None) -> DataStreamWriter:
    """SKU rows with the names their three dimensions have at the time of the batch."""
    def sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        tables = [read_dim(spark, f"{dims}/{name}", schemas.DIM_SCHEMAS[name])
                  for name in ("base_category3", "base_trademark", "spu_info")]
        rows = latest_by_key(_changes(df, schemas.SKU, batch_id, dead, "skus"), "id", schemas.VERSION)
        _store_changes(enrich_sku(rows, *tables), batch_id, out, schemas.SKU_ENRICHED)
    return each_batch(messages, sink)


# --- DWD ----------------------------------------------------------------------

def publish_batch(df: DataFrame, batch_id: int, topic: str) -> None:
    """Rows as JSON messages of a folder topic, replacing a former attempt."""
    messages_writer(as_messages(df)).mode("overwrite").text(f"{topic}/batch_id={batch_id}")


def known_users(rows: DataFrame, status: str, before: int) -> DataFrame:
    """The batch's users who have ordered in an earlier batch."""
    buyers = broadcast_if_few(keys_of(rows, "user_id", "user_id", "long"))
    return rows_of_keys(rows.sparkSession, status, schemas.USER_STATUS, buyers, before)


def _one_status(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id", "bucket").agg(F.max("if_consumed").alias("if_consumed"), F.max("batch_id").alias("batch_id"))


def _flags_given(rows: DataFrame, docs: str, before: int, by: str) -> DataFrame:
    """(dt, id, flag) of the batch's orders that were stored before: an order sent again keeps its flag."""
    stored = folders_of(rows.sparkSession, docs, schemas.ORDER_DOCUMENT, rows, before, by)
    stored = stored.join(broadcast_if_few(rows.select("dt", "id")), ["dt", "id"], "left_semi")
    return stored.groupBy("dt", "id").agg(F.max("if_first_order").alias("_given"))


def enrich_orders(messages: DataFrame, dims: str, status: str, docs: str, topic: str,
                  dead: str | None = None, by: str = "dt") -> DataStreamWriter:
    """Flag first orders, add province and user, then store the new users' status,
    the order documents by day and id, and the messages for the next layer.

    An order may be sent again, in the same batch or a later one: its last form is stored, and it keeps
    the flag it had. Orders without a day lie under `none`.
    """
    def sink(df: DataFrame, batch_id: int) -> None:
        schema = schemas.extended(schemas.ORDER_INFO, **dict.fromkeys(schemas.VERSION, schemas.LONG))
        with _taken_once(df, schema, batch_id, dead, "orders") as sent:
            store(sent, batch_id)

    def store(sent: DataFrame, batch_id: int) -> None:
        spark = sent.sparkSession
        # orders without an id are kept one by one
        alone = sent.withColumn("_alone", F.when(F.col("id").isNull(), F.monotonically_increasing_id()))
        last = latest_by_key(alone, ("id", "_alone"), schemas.VERSION).drop("_alone")
        rows = order_rules.with_date_hour(last.drop(*schemas.VERSION)) \
            .withColumn("dt", F.coalesce("create_date", F.lit("none"))).persist()
        keep_short(spark, status, schemas.extended(schemas.USER_STATUS, bucket=schemas.BUCKET), batch_id,
                   partitions=("bucket",), merge=_one_status)
        given = _flags_given(rows, docs, batch_id, by)
        flagged = order_rules.flag_first_order(rows, known_users(rows, status, batch_id))
        flagged = order_rules.keep_one_first_order(flagged).join(given, ["dt", "id"], "left") \
            .withColumn("if_first_order", F.coalesce("_given", "if_first_order"))
        province = read_dim(spark, f"{dims}/base_province", schemas.PROVINCE)
        users = latest_rows(spark, f"{dims}/user_info", schemas.USER_DESCRIBED,
                            of=broadcast_if_few(keys_of(rows, "user_id")))
        full = order_rules.join_user(order_rules.join_province(flagged, province), users) \
            .select(*schemas.ORDER_DOCUMENT.fieldNames()).persist()
        try:
            append_keyed(order_rules.first_order_users(full), "user_id", batch_id, status)
            append_folders(full, batch_id, docs, by)
            publish_batch(full.drop("dt"), batch_id, topic)
        finally:
            full.unpersist()
            rows.unpersist()
    return each_batch(messages, sink, keep=False)


def enrich_details(messages: DataFrame, dims: str, topic: str, dead: str | None = None) -> DataStreamWriter:
    def sink(df: DataFrame, batch_id: int) -> None:
        with _taken_once(df, schemas.ORDER_DETAIL, batch_id, dead, "details", persist=True) as rows:
            keys = keys_of(rows, "sku_id").persist()
            try:
                sku = latest_rows(df.sparkSession, f"{dims}/sku_info", schemas.SKU_ENRICHED, of=broadcast_if_few(keys))
                publish_batch(order_rules.join_sku(rows, sku), batch_id, topic)
            finally:
                keys.unpersist()
    return each_batch(messages, sink, keep=False)


# --- DWS ----------------------------------------------------------------------

def pair_within(orders: DataFrame, details: DataFrame, bound: str = PAIR_BOUND,
                salts: int = 8) -> DataFrame:
    """Orders and lines of the same id whose times are at most `bound` apart.

    `orders` have `order_id` and `_order_time`, `details` have `order_id`,
    `order_detail_id` and `_line_time`, both times with a watermark. These and the bound let Spark
    drop state that can find no partner any more. Lines are spread over `salts`
    parts by their id and orders repeated for each, so one order's lines are kept
    in several state partitions.
    """
    return _pairs(orders, details, bound, salts, "inner").drop("_oid")


def pair_or_leave(orders: DataFrame, details: DataFrame, bound: str = PAIR_BOUND, salts: int = 8) -> DataFrame:
    """Every line once: with its order (`matched`), or alone when the watermark has passed the bound within which
    an order could still come. A line is kept until then and no longer; one that comes after the watermark
    itself gets no row (`run.late_rows` counts these)."""
    pairs = _pairs(orders, details, bound, salts, "right_outer")
    return pairs.withColumn("matched", F.col("order_id").isNotNull()) \
        .withColumn("order_id", F.col("_oid")).drop("_oid")


def _pairs(orders: DataFrame, details: DataFrame, bound: str, salts: int, how: str) -> DataFrame:
    left = orders.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    right = (details.withColumn("_line_salt", F.pmod(F.hash("order_detail_id"), F.lit(salts)))
             .withColumnRenamed("order_id", "_oid"))
    apart = F.expr(f"INTERVAL {bound}")
    return left.join(right, (F.col("order_id") == F.col("_oid")) & (F.col("_salt") == F.col("_line_salt"))
                     & (F.col("_line_time") >= F.col("_order_time") - apart)
                     & (F.col("_line_time") <= F.col("_order_time") + apart), how).drop("_salt", "_line_salt")


def drop_repeats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """First of each key within the watermark's lifetime, in two steps: per input
    partition, then overall. The copies of one key leave the first step as at most
    one row per partition."""
    return (rows.withColumn("_part", F.spark_partition_id())
            .dropDuplicatesWithinWatermark(keys + ["_part"]).drop("_part")
            .dropDuplicatesWithinWatermark(keys))


def widen_orders(orders: DataFrame, details: DataFrame, bound: str = PAIR_BOUND,
                 lateness: str = LATENESS, salts: int = 8, leave: bool = False) -> DataFrame:
    """Enriched order and line messages to wide rows, each pair once.

    Messages sent again are dropped before the join; the join itself gives a pair once. With `leave`, lines that
    find no order come, too, with `matched` false and no order columns (see `store_matches`)."""
    head = parse_records(orders, schemas.ORDER_INFO_ENRICHED)
    head = order_side(head).withColumn("_order_time", event_time(F.col("create_time")))
    lines = parse_records(details, schemas.ORDER_DETAIL_ENRICHED)
    lines = detail_side(lines, event_time(F.col("create_time")).alias("_line_time"))
    head = drop_repeats(head.withWatermark("_order_time", lateness), ["order_id"])
    lines = drop_repeats(lines.withWatermark("_line_time", lateness), ["order_id", "order_detail_id"])
    pairs = pair_or_leave(head, lines, bound, salts) if leave else pair_within(head, lines, bound, salts)
    return pairs.withColumn("final_detail_amount", F.lit(None).cast("double")) \
        .select(*schemas.ORDER_WIDE.fieldNames(), *(["matched"] if leave else []))


def store_matches(rows: DataFrame, topic: str, unmatched: str) -> DataStreamWriter:
    """Rows of `widen_orders` with `leave`: pairs to the next layer's topic, lines without an order to a table."""
    def sink(df: DataFrame, batch_id: int) -> None:
        publish_batch(df.where("matched").drop("matched"), batch_id, topic)
        append_batch(df.where("NOT matched").drop("matched"), batch_id, unmatched)
    return each_batch(rows, sink)


def publish(rows: DataFrame, topic: str) -> DataStreamWriter:
    """Rows of a stream as JSON messages of a folder topic."""
    return as_messages(rows).writeStream.format("text").option("compression", COMPRESSION).option("path", topic)


def store_shares(wide: DataFrame, out: str, brand_stat: str | None = None, hours: str | None = None,
                 dead: str | None = None, by: str = "dt") -> DataStreamWriter:
    """Wide messages to stored rows with each line's rounded share, by day, and the batch's
    sums by brand and by hour. Needs no state: a share depends on its own row only."""
    def sink(df: DataFrame, batch_id: int) -> None:
        with _taken_once(df, schemas.ORDER_WIDE, batch_id, dead, "shares") as taken:
            store(taken, batch_id)

    def store(taken: DataFrame, batch_id: int) -> None:
        rows = with_line_shares(taken).withColumn("final_detail_amount", from_cents(F.col("_share"))) \
            .select(*schemas.ORDER_WIDE.fieldNames())
        if dead is None:        # else the records are kept already
            rows.persist()
        try:
            append_folders(rows, batch_id, out, by)
            if brand_stat:
                store_brand_stat(rows, batch_id, f"{brand_stat}/part=lines")
            if hours:
                add_sums(rows, batch_id, f"{hours}/lines", to_cents(F.col("final_detail_amount")), hour_of_text(F.col("create_time")))
        finally:
            rows.unpersist()
    return each_batch(wide, sink, keep=False)


def _order_sums(wide: DataFrame, lateness: str) -> DataFrame:
    """Running sums per order: streaming aggregates, so that partial sums are built before the exchange; an
    order's sums are dropped `lateness` after its time."""
    rows = with_line_shares(parse_records(wide, schemas.ORDER_WIDE)) \
        .withColumn("_time", event_time(F.col("create_time"))) \
        .withWatermark("_time", lateness)
    rows = rows.where((F.col("_line") != 0) | (F.col("_listed") == 0))
    return rows.groupBy("order_id", "dt", "_time").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("_line").alias("_sum"), F.sum("_share").alias("_shared"),
        F.max("_paid").alias("_paid"), F.max("_listed").alias("_listed"),
        F.max(F.struct("order_detail_id", "tm_id", "tm_name")).alias("_last"))


def complete_orders(wide: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Orders whose lines have come in full (their amounts reach the listed total),
    with the line that gets the rest of the payment and that rest in cents."""
    return _order_sums(wide, lateness).where(F.col("_sum") == F.col("_listed")).select(
        "order_id", F.col("_last.order_detail_id").alias("last_id"),
        (F.col("_paid") - F.col("_shared")).alias("rest"), "_last.tm_id", "_last.tm_name", "dt",
        F.date_format("_time", "HH").alias("hr"))


def store_complete(done: DataFrame, out: str, brand_stat: str | None = None, hours: str | None = None,
                   by: str = "dt") -> DataStreamWriter:
    """Store each order's completion once, by day, and its rest in the sums by brand and by hour."""
    def sink(df: DataFrame, batch_id: int) -> None:
        keys = ["dt", "order_id"]
        before = folders_of(df.sparkSession, out, schemas.DONE_ORDER, df, batch_id, by)
        before = before.join(broadcast_if_few(df.select(*keys)), keys, "left_semi").select(*keys)
        fresh = df.join(before, keys, "left_anti").select(*schemas.DONE_ORDER.fieldNames()).persist()
        try:
            append_folders(fresh, batch_id, out, by)
            if brand_stat:
                rest = fresh.withColumn("final_detail_amount", from_cents(F.col("rest")))
                store_brand_stat(rest, batch_id, f"{brand_stat}/part=rest")
            if hours:
                add_sums(fresh, batch_id, f"{hours}/rest", F.col("rest"), F.col("hr"))
        finally:
            fresh.unpersist()
    return each_batch(done, sink, mode="update")


def unfinished_orders(wide: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Orders whose lines have not come in full when the watermark passes their time: how many came, what these and
    the order list, what was paid and what of it the lines' shares have taken, all in cents.

    The same sums as in `complete_orders`, given out when their state ends (append mode) and not while they grow. An
    order's shares stay stored; `paid - shared` is what no line has got.
    """
    return _order_sums(wide, lateness).where(F.col("_sum") != F.col("_listed")).select(
        "order_id", "dt", F.date_format("_time", "HH").alias("hr"), "lines", F.col("_sum").alias("came"),
        F.col("_listed").alias("listed"), F.col("_paid").alias("paid"), F.col("_shared").alias("shared"))


def store_unfinished(rows: DataFrame, out: str, by: str = "dt") -> DataStreamWriter:
    """Each unfinished order once, by day."""
    return each_batch(rows, lambda df, n: append_folders(df, n, out, by))


def paid_rows(shares: DataFrame, done: DataFrame) -> DataFrame:
    """Stored shares with the rest added on each complete order's last line."""
    extra = done.select("order_id", F.col("last_id").alias("order_detail_id"),
                        from_cents(F.col("rest")).alias("_rest"))
    joined = shares.join(extra, ["order_id", "order_detail_id"], "left")
    cents = F.floor(F.col("final_detail_amount") * 100 + 0.5) \
        + F.floor(F.coalesce("_rest", F.lit(0.0)) * 100 + 0.5)
    return joined.withColumn("final_detail_amount", from_cents(cents)).drop("_rest")


# --- ADS ----------------------------------------------------------------------

def store_brand_stat(rows: DataFrame, batch_id: int, out: str, stat_time: str | None = None) -> None:
    """Brand sums of one batch with the time they were made."""
    moment = F.lit(stat_time) if stat_time else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    append_batch(stats.brand_stat_rows(rows, moment), batch_id, out)


def brand_stat(wide: DataFrame, out: str, dead: str | None = None) -> DataStreamWriter:
    """Brand sums of every batch of wide messages that carry final amounts."""
    def sink(df: DataFrame, batch_id: int) -> None:
        with _taken_once(df, schemas.ORDER_WIDE, batch_id, dead, "brands") as rows:
            store_brand_stat(rows, batch_id, out)
    return each_batch(wide, sink, keep=False)


# --- daily active devices -------------------------------------------------------

def _earliest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("mid", "bucket").agg(F.min("dt").alias("dt"), F.max("batch_id").alias("batch_id"))


def _note_new_devices(firsts: DataFrame, batch_id: int, seen: str, counts: str) -> None:
    """Note devices never seen before, and count them on their first day. A device that turns out to have been
    there on an earlier day moves: one less on the day it was counted, one more on the earlier one."""
    spark = firsts.sparkSession
    keep_short(spark, seen, schemas.extended(schemas.FIRST_SEEN, bucket=schemas.BUCKET), batch_id,
               partitions=("bucket",), merge=_earliest)
    mine = firsts.groupBy("mid").agg(F.min("dt").alias("dt"))
    known = rows_of_keys(spark, seen, schemas.FIRST_SEEN, broadcast_if_few(mine.select("mid")), batch_id) \
        .groupBy("mid").agg(F.min("dt").alias("_known"))
    new = mine.join(known, "mid", "left").where(F.col("_known").isNull() | (F.col("dt") < F.col("_known"))).persist()
    try:
        append_keyed(new.select("mid", "dt"), "mid", batch_id, seen)
        moved = new.where(F.col("_known").isNotNull()).select(F.col("_known").alias("dt"), F.lit(-1).alias("n"))
        add_sums(new.select("dt", F.lit(1).alias("n")).unionByName(moved), batch_id, counts, F.col("n"))
    finally:
        new.unpersist()


def store_visits(messages: DataFrame, out: str, hours: str | None = None, seen: str | None = None,
                 dead: str | None = None) -> DataStreamWriter:
    """First visit of each device and day; with `hours` also the sums of visits by hour, with `seen` a register
    of devices ever seen and, under `hours`, the new ones by day.

    A batch is reduced to one row per device first, then compared with what the
    table already has for these devices on the batch's days; other days' folders
    are not opened, nor buckets of the register that hold none of the batch's devices.
    """
    def sink(df: DataFrame, batch_id: int) -> None:
        with _taken_once(df, schemas.START_LOG, batch_id, dead, "visits") as taken:
            store(dau.flatten_start_logs(taken), batch_id)

    def store(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        firsts = dau.first_visits(rows).persist()
        keys = ["dt", "mid"]
        stored = folders_of(spark, out, schemas.DAU, firsts, batch_id)
        stored = stored.join(broadcast_if_few(firsts.select(*keys)), keys, "left_semi").select(*keys)
        fresh = firsts.join(stored, keys, "left_anti").persist()
        try:
            append_folders(fresh, batch_id, out)
            if hours:
                add_sums(fresh, batch_id, f"{hours}/visits", F.lit(1), F.col("hr"))
            if seen:
                _note_new_devices(firsts, batch_id, seen, f"{hours}/new")
        finally:
            fresh.unpersist()
            firsts.unpersist()
    return each_batch(messages, sink, keep=False)


# --- sliding counts ---------------------------------------------------------------


def sliding_counts(rows: DataFrame, moment: str, length: str = PAIR_BOUND, slide: str = "5 seconds",
                   lateness: str = LATENESS) -> DataFrame:
    """Rows per overlapping window of event time."""
    return (rows.withWatermark(moment, lateness)
            .groupBy(F.window(moment, length, slide)).agg(F.count("*").alias("n"))
            .select(F.col("window.start").alias("window_start"), "n"))


def store_counts(counts: DataFrame, out: str) -> DataStreamWriter:
    return each_batch(counts, lambda df, n: append_batch(df, n, out), mode="update")
