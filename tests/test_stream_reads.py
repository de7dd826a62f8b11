"""How often the jobs read their topics, and what streams leave on disk."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.plans import streams
from tidemart.session import new_workdir
from tidemart.sources.sinks import read_batches
from tidemart.sources.topics import append_file_topic, file_topic
from tidemart.streaming import jobs
from tidemart.streaming.run import CHANGELOGS, run_once


@pytest.fixture
def work(spark):
    return new_workdir(spark, "stores-test")


def put(spark, path, *records):
    append_file_topic(spark.createDataFrame([(json.dumps(r),) for r in records], "value string").coalesce(1), path)


def wide_message(order_id, line_id, amount, listed, paid):
    return {"order_id": order_id, "order_detail_id": line_id, "sku_price": amount, "sku_num": 1, "original_total_amount": listed,
            "final_total_amount": paid, "create_time": "2022-01-01 10:00:00", "dt": "2022-01-01"}


def test_what_is_taken_and_left_out_comes_from_one_reading(spark, work, rows):
    dead = f"{work}/dead"
    lines = [{"id": i, "order_id": i, "sku_id": 1, "order_price": 1.0, "sku_num": "none" if i % 5 == 0 else "2"} for i in range(50)]
    put(spark, f"{work}/lines", *lines)
    heads = [{"id": i, "user_id": "x" if i % 5 == 0 else "7", "create_time": "2022-01-01 10:00:00"} for i in range(49)]
    put(spark, f"{work}/orders", *heads, {"user_id": 1}, {"user_id": 1})
    put(spark, f"{work}/wide", *[wide_message(i, i, 10, 10, 9) for i in range(50)], {"order_id": "x"})
    queries = [
        (jobs.enrich_details(file_topic(spark, f"{work}/lines"), f"{work}/dims", f"{work}/dwd", dead), 50),
        (jobs.enrich_orders(file_topic(spark, f"{work}/orders"), f"{work}/dims", f"{work}/status", f"{work}/docs", f"{work}/dwo", dead), 51),
        (jobs.store_shares(file_topic(spark, f"{work}/wide"), f"{work}/shares", dead=dead), 51)]
    for n, (job, sent) in enumerate(queries):
        query = run_once(job, f"{work}/cp{n}")
        assert sum(p["numInputRows"] for p in query.recentProgress) < 2 * sent
    assert spark.read.text(f"{work}/dwd", recursiveFileLookup=True).count() == 40
    docs = read_batches(spark, f"{work}/docs", schemas.ORDER_DOCUMENT)
    assert (docs.count(), docs.where("id IS NULL").count()) == (41, 2)      # orders without an id stay two
    assert read_batches(spark, f"{work}/shares", schemas.STORED_WIDE).count() == 50
    for job, n in (("details", 10), ("orders", 10), ("shares", 1)):
        assert rows(read_batches(spark, f"{dead}/{job}", schemas.LEFT_OUT), "reason") == [("number",)] * n


def test_stores_of_joins_are_put_by_whole(spark, work, rows):
    """No changes to play back; a restarted query finds the state of the runs before, and settings stay as they were."""
    before = spark.conf.get(CHANGELOGS)

    def pairs(n):
        out = jobs.widen_orders(file_topic(spark, f"{work}/o"), file_topic(spark, f"{work}/d"), salts=2)
        run_once(out.writeStream.format("parquet").option("path", f"{work}/wide"), f"{work}/cp", changelogs=False)
        assert spark.read.schema("order_detail_id long").parquet(f"{work}/wide").count() == n
    put(spark, f"{work}/o", {"id": 1, "create_time": "2022-01-01 10:00:00"})
    put(spark, f"{work}/d", {"id": 5, "order_id": 1, "create_time": "2022-01-01 10:00:01"})
    pairs(1)
    put(spark, f"{work}/d", {"id": 6, "order_id": 1, "create_time": "2022-01-01 10:00:02"})
    pairs(2)
    kept = [f for _, _, files in os.walk(f"{work}/cp/state") for f in files]
    assert any(f.endswith(".zip") for f in kept) and not any(f.endswith(".changelog") for f in kept)
    assert spark.conf.get(CHANGELOGS) == before


def test_shuffle_files_go_between_rounds(spark, work):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return sum(f.startswith("shuffle_") for folder in folders for _, _, found in os.walk(folder) for f in found)
    for n in range(3):
        spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count().collect()
    had = files()
    assert had
    for _ in streams._rounds(spark, {f"{work}/topic": [spark.createDataFrame([("a",)], "value string")]}):
        for _ in range(50):
            if files() < had:
                break
            time.sleep(0.1)
        assert files() < had
