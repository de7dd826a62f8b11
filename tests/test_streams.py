import json
import os

import pytest
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions.times import event_time
from tidemart.operators import cdc
from tidemart.plans import streams
from tidemart.session import new_workdir
from tidemart.sources import fixtures
from tidemart.sources.rollups import read_sums
from tidemart.sources.sinks import latest_rows, read_batches, read_dim, read_documents, upsert_dim
from tidemart.sources.tables import parquet_tables
from tidemart.sources.topics import append_file_topic, file_topic, to_console
from tidemart.streaming import jobs
from tidemart.streaming.run import each_batch, late_rows, run_once


@pytest.fixture
def work(spark):
    return new_workdir(spark, "stream-test")


def put(spark, path, *records):
    values = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    append_file_topic(spark.createDataFrame(values, "value string").coalesce(1), path)


def log(mid, ts):
    return {"common": {"mid": mid, "uid": "u", "ar": "a", "ch": "c", "vc": "v"}, "start": {"entry": "i"}, "ts": ts}


def test_visits_across_batches_and_bad_messages(spark, work, rows):
    def run():
        run_once(jobs.store_visits(file_topic(spark, f"{work}/in"), f"{work}/out"), f"{work}/cp")
    put(spark, f"{work}/in", log("m1", 7200000), log("m1", 3600000), "{bad")
    run()
    put(spark, f"{work}/in", log("m1", 1000), log("m2", 1000), log("m1", 90000000))
    run()
    run()
    got = read_batches(spark, f"{work}/out", schemas.DAU)
    assert rows(got, "dt", "mid", "hr") == [
        ("1970-01-01", "m1", "01"), ("1970-01-01", "m2", "00"), ("1970-01-02", "m1", "01")]


def order(i, user, time, listed=10.0, paid=9.0):
    return {"id": i, "user_id": user, "province_id": 1, "create_time": time,
            "final_total_amount": paid, "original_total_amount": listed}


def test_first_order_status_and_replay(spark, work, rows):
    """A batch that is run again must not take its own users for known ones."""
    calls = []
    original = jobs.publish_batch

    def fail_first_time(df, batch_id, topic):
        original(df, batch_id, topic)
        calls.append(batch_id)
        if calls == [0]:
            raise RuntimeError("lost")

    def run():
        run_once(jobs.enrich_orders(file_topic(spark, f"{work}/in"), f"{work}/dims", f"{work}/status",
                                    f"{work}/docs", f"{work}/dwd"), f"{work}/cp")
    put(spark, f"{work}/in", order(1, 7, "2022-01-01 10:00:00"), order(2, 7, "2022-01-01 09:00:00"))
    jobs.publish_batch = fail_first_time
    try:
        with pytest.raises(Exception, match="lost"):
            run()
        run()
        put(spark, f"{work}/in", order(3, 7, "2022-01-02 10:00:00"), order(4, 8, "2022-01-02 09:00:00"))
        run()
    finally:
        jobs.publish_batch = original
    docs = read_batches(spark, f"{work}/docs", schemas.ORDER_DOCUMENT)
    assert rows(docs, "id", "if_first_order", "create_hour") == [
        (1, "0", "10"), (2, "1", "09"), (3, "0", "10"), (4, "1", "09")]
    assert rows(read_batches(spark, f"{work}/status", schemas.USER_STATUS), "user_id") == [(7,), (8,)]


def test_names_are_looked_up_anew_in_every_batch(spark, work, rows):
    sku = {"id": "5", "tm_id": "1", "sku_name": "n"}

    def run():
        run_once(jobs.keep_skus(file_topic(spark, f"{work}/in"), f"{work}/dims", f"{work}/sku"), f"{work}/cp")
        return rows(latest_rows(spark, f"{work}/sku", schemas.SKU_ENRICHED), "id", "tm_name")
    put(spark, f"{work}/in", sku)
    assert run() == [("5", None)]
    upsert_dim(spark.createDataFrame([("1", "brand")], schemas.TRADEMARK), 0, f"{work}/dims/base_trademark",
               schemas.TRADEMARK)
    put(spark, f"{work}/in", sku)
    assert run() == [("5", "brand")]


def test_users_are_described(spark, work, rows):
    put(spark, f"{work}/in", {"id": "1", "birthday": "2000-01-01", "gender": "M"}, {"id": "2", "gender": None})
    run_once(jobs.keep_users(file_topic(spark, f"{work}/in"), f"{work}/out", "2021-01-01"), f"{work}/cp")
    assert rows(latest_rows(spark, f"{work}/out", schemas.USER_DESCRIBED), "id", "age_group", "gender_name") == [
        ("1", "20_30", "male"), ("2", None, "female")]


def wide_message(o, i, price, listed, paid, tm="t", time="2022-01-01 10:00:00"):
    return {"order_id": o, "order_detail_id": i, "sku_price": price, "sku_num": 1, "tm_id": tm, "tm_name": tm,
            "original_total_amount": listed, "final_total_amount": paid, "create_time": time, "dt": time[:10]}


def test_rest_of_a_payment_once_the_order_is_complete(spark, work, rows):
    def run():
        topic = f"{work}/in"
        run_once(jobs.store_shares(file_topic(spark, topic), f"{work}/shares", f"{work}/stat"), f"{work}/cp1")
        run_once(jobs.store_complete(jobs.complete_orders(file_topic(spark, topic)), f"{work}/done",
                                     f"{work}/stat"), f"{work}/cp2")
        return rows(jobs.paid_rows(read_batches(spark, f"{work}/shares", schemas.STORED_WIDE),
                                   read_batches(spark, f"{work}/done", schemas.DONE_ORDER)),
                    "order_id", "order_detail_id", "final_detail_amount")
    put(spark, f"{work}/in", wide_message(1, 1, 10, 30, 10), wide_message(1, 2, 10, 30, 10, tm="z"),
        wide_message(2, 1, 1, 2, 1))
    assert run() == [(1, 1, 3.33), (1, 2, 3.33), (2, 1, 0.5)]
    put(spark, f"{work}/in", wide_message(1, 3, 10, 30, 10, tm="z"), wide_message(1, 4, 0, 30, 10))
    want = [(1, 1, 3.33), (1, 2, 3.33), (1, 3, 3.34), (1, 4, 0.0), (2, 1, 0.5)]
    assert run() == want
    put(spark, f"{work}/in", wide_message(1, 5, 0, 30, 10))
    assert run() == sorted(want + [(1, 5, 0.0)])
    both = read_batches(spark, f"{work}/stat/part=lines", schemas.BRAND_STAT).unionByName(
        read_batches(spark, f"{work}/stat/part=rest", schemas.BRAND_STAT))
    sums = both.groupBy("trademark_id").agg(F.round(F.sum("amount"), 2))
    assert rows(sums) == [("t", 3.83), ("z", 6.67)]


def test_pairs_within_the_bound_and_sent_once(spark, work, rows):
    def enriched(i, time):
        return {"id": i, "user_id": 1, "create_time": time, "create_date": time[:10], "create_hour": "10"}

    def line(i, o, time):
        return {"id": i, "order_id": o, "order_price": 1.0, "sku_num": 1, "create_time": time}

    def run():
        out = jobs.widen_orders(file_topic(spark, f"{work}/o"), file_topic(spark, f"{work}/d"), salts=3)
        run_once(out.writeStream.format("parquet").option("path", f"{work}/out"), f"{work}/cp")
    put(spark, f"{work}/o", enriched(1, "2022-01-01 10:00:00"), enriched(2, "2022-01-01 10:00:00"))
    put(spark, f"{work}/d", line(1, 1, "2022-01-01 10:00:50"), line(2, 1, "2022-01-01 10:00:51"),
        line(3, 3, "2022-01-01 10:00:00"), line(1, 1, "2022-01-01 10:00:50"))
    run()
    put(spark, f"{work}/d", line(1, 1, "2022-01-01 10:00:50"), line(4, 2, "2022-01-01 09:59:30"))
    put(spark, f"{work}/o", enriched(1, "2022-01-01 10:00:00"), enriched(3, "2022-01-01 10:00:10"))
    run()
    got = spark.read.schema(schemas.ORDER_WIDE).parquet(f"{work}/out")
    assert rows(got, "order_id", "order_detail_id") == [(1, 1), (2, 4), (3, 3)]


def test_line_later_than_the_watermark_finds_no_order(spark, work, rows):
    def run():
        left = file_topic(spark, f"{work}/o").select(F.from_json("value", "id long, t string").alias("r")).select(
            F.col("r.id").alias("order_id"), event_time(F.col("r.t")).alias("_order_time"))
        right = file_topic(spark, f"{work}/d").select(
            F.from_json("value", "id long, o long, t string").alias("r")).select(
            F.col("r.o").alias("order_id"), F.col("r.id").alias("order_detail_id"),
            event_time(F.col("r.t")).alias("_line_time"))
        pairs = jobs.pair_within(left.withWatermark("_order_time", "10 minutes"),
                                 right.withWatermark("_line_time", "10 minutes"), salts=2)
        run_once(pairs.select("order_id", "order_detail_id").writeStream.format("parquet")
                 .option("path", f"{work}/out"), f"{work}/cp")
    put(spark, f"{work}/o", {"id": 1, "t": "2022-01-01 10:00:00"})
    put(spark, f"{work}/d", {"id": 1, "o": 1, "t": "2022-01-01 10:00:05"})
    run()
    put(spark, f"{work}/o", {"id": 2, "t": "2022-01-01 12:00:00"})
    put(spark, f"{work}/d", {"id": 2, "o": 2, "t": "2022-01-01 12:00:05"})
    run()
    put(spark, f"{work}/d", {"id": 9, "o": 1, "t": "2022-01-01 10:00:06"})
    run()
    got = spark.read.schema("order_id long, order_detail_id long").parquet(f"{work}/out")
    assert rows(got) == [(1, 1), (2, 2)]


def test_topics_are_split_once_also_over_a_restart(spark, work, rows):
    def env(table, kind, i):
        return {"table": table, "type": kind, "data": {"id": i}}

    def run():
        run_once(jobs.split_topics(file_topic(spark, f"{work}/db"), cdc.split_maxwell, f"{work}/ods"), f"{work}/cp")
    put(spark, f"{work}/db", env("order_info", "insert", 1), env("order_info", "update", 2))
    run()
    put(spark, f"{work}/db", env("user_info", "update", 3))
    run()
    got = spark.read.schema("value string, topic string").text(f"{work}/ods")
    assert rows(got, "topic", "value") == [("ods_order_info", '{"id":1}'), ("ods_user_info", '{"id":3}')]


def test_empty_batches_are_skipped(spark, work):
    seen = []
    put(spark, f"{work}/in", {"a": 1})
    stream = file_topic(spark, f"{work}/in").where(F.col("value") == "nothing")
    run_once(each_batch(stream, lambda df, n: seen.append(n)), f"{work}/cp")
    assert seen == []


def test_raw_logs_by_day_and_console(spark, work, rows):
    put(spark, f"{work}/in", log("m1", 1000), log("m2", 90000000))
    run_once(jobs.land_logs(file_topic(spark, f"{work}/in"), f"{work}/raw"), f"{work}/cp")
    back = spark.read.schema("value string, batch_id long, dt string").text(f"{work}/raw")
    assert rows(back.groupBy("dt").count()) == [("1970-01-01", 1), ("1970-01-02", 1)]
    shown = run_once(to_console(file_topic(spark, f"{work}/in")), f"{work}/cp2")
    assert shown.lastProgress["numInputRows"] == 2


def test_change_records_carry_their_order_through_the_split(spark, work, rows):
    """Two changes of one user in one batch: the later one counts, though the earlier one's values sort higher."""
    def env(kind, ts, seq, **data):
        return {"table": "user_info", "type": kind, "ts": ts, "seq": seq, "data": data}

    def run():
        run_once(jobs.split_topics(file_topic(spark, f"{work}/db"), lambda m: cdc.split_maxwell(m, arrival=True), f"{work}/ods"),
                 f"{work}/cp1")
        topic = spark.readStream.schema("value string, topic string").format("text").load(f"{work}/ods")
        run_once(jobs.keep_users(topic.select("value"), f"{work}/out", "2021-01-01"), f"{work}/cp2")
        return rows(latest_rows(spark, f"{work}/out", schemas.USER_DESCRIBED), "id", "user_level")
    put(spark, f"{work}/db", env("update", 10, 2, id="1", user_level="1"), env("insert", 10, 1, id="1", user_level="9"),
        env("insert", 10, 3, id="2", user_level="x"))
    assert run() == [("1", "1"), ("2", "x")]
    put(spark, f"{work}/db", env("delete", 30, 5, id="2"), env("update", 9, 9, id="1", user_level="late"))
    assert run() == [("1", "1")]
    put(spark, f"{work}/db", env("update", 20, 4, id="2", user_level="before the deletion"), env("insert", 40, 6, id="2", user_level="n"))
    assert run() == [("1", "1"), ("2", "n")]


def test_canal_rows_keep_their_place_and_topic_offsets_count(spark, rows):
    df = spark.createDataFrame([('{"table":"x","type":"INSERT","ts":3,"data":[{"id":1},{"id":2},{}]}', 7),
                                ('{"table":"x","type":"INSERT","data":[{"id":3}]}', 8)], "value string, offset long")
    assert rows(cdc.split_canal(df, arrival=True), "value") == [
        ('{"_seq":8,"_pos":0,"_op":"insert","id":3}',), ('{"_ts":3,"_seq":7,"_pos":0,"_op":"insert","id":1}',),
        ('{"_ts":3,"_seq":7,"_pos":1,"_op":"insert","id":2}',)]


def test_brand_topic_with_times_and_offsets(spark, work, rows):
    def frame(*messages):
        df = spark.createDataFrame(list(messages), "value string, t long, offset long")
        return df.select("value", F.timestamp_millis("t").alias("timestamp"), "offset")
    changes = jobs._changes(frame(('{"tm_id":"1","tm_name":"z"}', 5, 1), ('{"tm_id":"1","tm_name":"a","_op":"DELETE"}', 5, 2)),
                            schemas.TRADEMARK_MESSAGE, 0, None, "dim")
    assert rows(changes, "tm_name", "_ts", "_seq", "_deleted") == [("a", 5, 2, True), ("z", 5, 1, False)]


def test_order_sent_again_keeps_flag_and_has_one_document(spark, work, rows):
    def run():
        run_once(jobs.enrich_orders(file_topic(spark, f"{work}/in"), f"{work}/dims", f"{work}/status",
                                    f"{work}/docs", f"{work}/dwd"), f"{work}/cp")
        return rows(read_documents(spark, f"{work}/docs", schemas.ORDER_DOCUMENT), "dt", "id", "order_status", "if_first_order")

    def sent(i, user, time, status, seq):
        return {**order(i, user, time), "order_status": status, "_seq": seq}
    put(spark, f"{work}/in", sent(1, 7, "2022-01-01 10:00:00", "paid", 2), sent(1, 7, "2022-01-01 10:00:00", "zz new", 1),
        sent(2, 7, "2022-01-01 11:00:00", "new", 1), {"id": 9, "user_id": 8})
    first = [("2022-01-01", 1, "paid", "1"), ("2022-01-01", 2, "new", "0"), ("none", 9, None, "1")]
    assert run() == first
    put(spark, f"{work}/in", sent(1, 7, "2022-01-01 10:00:00", "done", 1), sent(3, 7, "2022-01-02 10:00:00", "new", 1),
        {"id": 9, "user_id": 8, "order_status": "x"})
    assert run() == [("2022-01-01", 1, "done", "1"), ("2022-01-01", 2, "new", "0"), ("2022-01-02", 3, "new", "0"),
                     ("none", 9, "x", "1")]


def test_left_out_messages_count_once_also_when_a_batch_runs_again(spark, work, rows):
    lost = []

    def run(fail=False):
        writer = jobs.store_visits(file_topic(spark, f"{work}/in"), f"{work}/out", f"{work}/hours", dead=f"{work}/dead")
        original = jobs.add_sums
        if fail:
            def broken(*a, **k):
                original(*a, **k)
                lost.append(1)
                raise RuntimeError("lost")
            jobs.add_sums = broken
        try:
            run_once(writer, f"{work}/cp")
        finally:
            jobs.add_sums = original
    put(spark, f"{work}/in", log("m1", 1000), "{bad", '{"ts":"noon"}', log("m2", 2000))
    with pytest.raises(Exception, match="lost"):
        run(fail=True)
    run()
    run()
    assert lost and rows(read_batches(spark, f"{work}/dead/visits", schemas.LEFT_OUT), "value", "reason") == [
        ('{"ts":"noon"}', "number"), ("{bad", "broken")]
    assert rows(read_sums(spark, f"{work}/hours/visits")) == [("1970-01-01", "00", 2)]


def test_reasons_why_a_change_record_is_left_out(spark, rows):
    def env(table, kind, data):
        return (f'{{"table":"{table}","type":"{kind}","data":{data}}}',)
    df = spark.createDataFrame([
        env("order_info", "insert", '{"id":1}'), env("order_info", "update", '{"id":2}'), env("user_info", "delete", '{"id":4}'),
        env("sku_info", "insert", "{}"), env("cart_info", "insert", '{"id":6}'), ("{bad",), ("7",), ("",), (None,)], "value string")
    left = cdc.left_out_maxwell(df)
    assert rows(left.groupBy("reason").count()) == [("broken", 4), ("empty", 1), ("kind", 1), ("table", 1)]
    assert left.count() + cdc.split_maxwell(df).count() == df.count()


def test_register_of_devices_and_their_first_days(spark, work, rows):
    day = 86400000

    def run():
        run_once(jobs.store_visits(file_topic(spark, f"{work}/in"), f"{work}/out", f"{work}/hours", f"{work}/seen"), f"{work}/cp")
        return [r for r in rows(read_sums(spark, f"{work}/hours/new"), "dt", "value") if r[1]]
    put(spark, f"{work}/in", log("m1", 5 * day), log("m2", 5 * day), log("m1", 6 * day))
    assert run() == [("1970-01-06", 2)]
    put(spark, f"{work}/in", log("m1", 5 * day + 9), log("m3", 6 * day))
    assert run() == [("1970-01-06", 2), ("1970-01-07", 1)]
    put(spark, f"{work}/in", log("m2", 2 * day), log("m3", 7 * day))
    assert run() == [("1970-01-03", 1), ("1970-01-06", 1), ("1970-01-07", 1)]


def test_lines_without_an_order_are_given_out_and_late_ones_counted(spark, work, rows):
    def enriched(i, time):
        return {"id": i, "user_id": 1, "create_time": time, "create_date": time[:10], "create_hour": "10"}

    def line(i, o, time):
        return {"id": i, "order_id": o, "order_price": 1.0, "sku_num": 1, "create_time": time}

    def run():
        out = jobs.widen_orders(file_topic(spark, f"{work}/o"), file_topic(spark, f"{work}/d"), salts=3, leave=True)
        query = run_once(jobs.store_matches(out, f"{work}/wide", f"{work}/left"), f"{work}/cp")
        return (rows(read_batches(spark, f"{work}/left", schemas.ORDER_WIDE), "order_id", "order_detail_id"), late_rows(query))
    put(spark, f"{work}/o", enriched(1, "2022-01-01 10:00:00"))
    put(spark, f"{work}/d", line(1, 1, "2022-01-01 10:00:50"), line(2, 1, "2022-01-01 10:00:51"), line(3, 3, "2022-01-01 10:00:00"))
    assert run() == ([], 0)
    put(spark, f"{work}/o", enriched(8, "2022-01-01 12:00:00"))
    put(spark, f"{work}/d", line(8, 8, "2022-01-01 12:00:00"))
    assert run() == ([(1, 2), (3, 3)], 0)
    put(spark, f"{work}/d", line(9, 1, "2022-01-01 10:00:05"), line(10, 8, "2022-01-01 12:00:10"))
    assert run() == ([(1, 2), (3, 3)], 1)
    wide = spark.read.text(f"{work}/wide", recursiveFileLookup=True).select(F.get_json_object("value", "$.order_detail_id").alias("i"))
    assert rows(wide) == [("1",), ("10",), ("8",)]


def test_lines_are_read_once_and_sku_messages_by_all_cores(spark, work, rows):
    lines = [{"id": i, "order_id": i, "sku_id": i % 3, "order_price": 1.0, "sku_num": 1} for i in range(50)]
    put(spark, f"{work}/in", *lines)
    query = run_once(jobs.enrich_details(file_topic(spark, f"{work}/in"), f"{work}/dims", f"{work}/out"), f"{work}/cp")
    assert spark.read.text(f"{work}/out", recursiveFileLookup=True).count() == 50
    assert sum(p["numInputRows"] for p in query.recentProgress) < 100
    spark.createDataFrame([(i, "a b", "Brand#1", "T", 1.5) for i in range(9)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double") \
        .coalesce(1).write.parquet(f"{work}/t/part.parquet")
    tables = parquet_tables(spark, f"{work}/t")
    spread = fixtures.sku_info(tables, spread=True)
    assert spread.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert rows(spread) == rows(fixtures.sku_info(tables))


def test_a_batch_writes_down_the_changes_of_its_state(spark, work, rows):
    """Not the whole stores; a restarted query finds the state of the runs before."""
    topic = f"{work}/wide"

    def run():
        run_once(jobs.store_complete(jobs.complete_orders(file_topic(spark, topic)), f"{work}/done"), f"{work}/cp")

    def line(order_id, detail_id):
        return {"order_id": order_id, "order_detail_id": detail_id, "sku_price": 5.0, "sku_num": 1, "original_total_amount": 10.0,
                "final_total_amount": 9.0, "create_time": "2020-01-01 10:00:00", "dt": "2020-01-01"}
    put(spark, topic, line(1, 11), line(2, 21))
    run()
    put(spark, topic, line(1, 12))
    run()
    assert rows(read_batches(spark, f"{work}/done", schemas.DONE_ORDER), "order_id", "last_id", "rest") == [(1, 12, 0)]
    kept = [f for _, _, files in os.walk(f"{work}/cp/state") for f in files]
    assert any(f.endswith(".changelog") for f in kept)


def test_unfinished_orders_are_given_out_once(spark, work, rows):
    def run():
        topic = f"{work}/in"
        run_once(jobs.store_complete(jobs.complete_orders(file_topic(spark, topic)), f"{work}/done"), f"{work}/cp1")
        run_once(jobs.store_unfinished(jobs.unfinished_orders(file_topic(spark, topic)), f"{work}/open"), f"{work}/cp2")
        return rows(read_batches(spark, f"{work}/open", schemas.UNFINISHED_ORDER), "order_id", "lines", "came", "listed", "paid", "shared")
    put(spark, f"{work}/in", wide_message(1, 1, 10, 30, 9), wide_message(1, 2, 10, 30, 9), wide_message(2, 1, 1, 2, 1))
    assert run() == []
    put(spark, f"{work}/in", wide_message(2, 2, 1, 2, 1), wide_message(3, 1, 5, 5, 5, time="2022-01-01 10:10:01"))
    want = [(1, 2, 2000, 3000, 900, 600)]
    assert run() == want
    put(spark, f"{work}/in", wide_message(4, 1, 5, 5, 5, time="2022-01-01 12:00:00"))
    assert run() == want
    assert rows(read_batches(spark, f"{work}/done", schemas.DONE_ORDER), "order_id", "rest") == [(2, 0), (3, 0), (4, 0)]


def test_staged_rounds_go_into_a_topic_packed_and_without_a_copy(spark, work, rows):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("c", 2)], "value string, round int")
    parts = streams._staged(df, 3, f"{work}/staged")
    tick = spark.createDataFrame([("tick",)], "value string")
    seen = []
    for _ in streams._rounds(spark, {f"{work}/topic": [(parts[0], tick), *parts[1:]]}):
        run_once(jobs.store_counts(file_topic(spark, f"{work}/topic"), f"{work}/out"), f"{work}/cp")
        seen.append(spark.read.text(f"{work}/topic", recursiveFileLookup=True).count())
    assert seen == [3, 3, 4]
    files = [f for folder in ("topic", "staged") for _, _, fs in os.walk(f"{work}/{folder}") for f in fs if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    assert not [f for _, _, fs in os.walk(f"{work}/staged") for f in fs if f.startswith("part-")]


def test_a_batch_of_messages_is_not_kept_beside_its_topic(spark, work):
    kept = []

    def sink(df, n):
        kept.append(df.storageLevel.useMemory)

    put(spark, f"{work}/in", {"a": 1})
    run_once(each_batch(file_topic(spark, f"{work}/in"), sink), f"{work}/cp1")
    run_once(each_batch(file_topic(spark, f"{work}/in"), sink, keep=False), f"{work}/cp2")
    assert kept == [True, False]


def test_a_join_keeps_one_store_a_partition(spark, work):
    put(spark, f"{work}/o", {"id": 1, "create_time": "2022-01-01 10:00:00"})
    put(spark, f"{work}/d", {"id": 5, "order_id": 1, "create_time": "2022-01-01 10:00:01"})
    out = jobs.widen_orders(file_topic(spark, f"{work}/o"), file_topic(spark, f"{work}/d"), salts=2)
    run_once(out.writeStream.format("parquet").option("path", f"{work}/wide"), f"{work}/cp")
    assert spark.read.parquet(f"{work}/wide").count() == 1
    assert not [d for d, _, _ in os.walk(f"{work}/cp/state") if d.endswith(("-keyToNumValues", "-keyWithIndexToValue"))]
