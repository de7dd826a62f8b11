from datetime import datetime

from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.plans import batch, reports


def visits(spark, *rows):
    return spark.createDataFrame(list(rows), "dt string, mid string, hr string")


def sales(spark, *rows):
    return spark.createDataFrame(list(rows), "dt string, create_time string, final_detail_amount double")


def test_day_cards_with_and_without_rows(spark, rows):
    v = visits(spark, ("2022-01-01", "a", "01"), ("2022-01-02", "a", "01"), ("2022-01-02", "b", "02"))
    s = sales(spark, ("2022-01-02", "2022-01-02 10:00:00", 1.25), ("2022-01-02", "2022-01-02 10:00:00", 2.25))
    assert rows(reports.realtime_total(v, s, "2022-01-02")) == [("dau", 2.0), ("new_mid", 1.0), ("order_amount", 3.5)]
    assert rows(reports.realtime_total(v, s, "2022-02-02")) == [("dau", 0.0), ("new_mid", 0.0), ("order_amount", None)]


def test_hour_series_fills_with_zero(spark):
    v = visits(spark, ("2022-01-01", "a", "23"), ("2022-01-02", "a", "00"), ("2022-01-02", "b", "00"))
    got = {r["hr"]: (r["today"], r["yesterday"]) for r in reports.realtime_hour("dau", "2022-01-02", visits=v).collect()}
    assert len(got) == 24 and got["00"] == (2, 0) and got["23"] == (0, 1) and got["05"] == (0, 0)
    s = sales(spark, ("2022-01-02", "2022-01-02 09:00:00", 1.5))
    got = {r["hr"]: (r["today"], r["yesterday"]) for r in reports.realtime_hour("order_amount", "2022-01-02", wide=s).collect()}
    assert got["09"] == (1.5, 0.0)
    assert reports.realtime_hour("other", "2022-01-02") is None


def test_detail_page_counts_all_hits(spark):
    wide = spark.range(45).select(
        F.format_string("%03d", "id").alias("order_detail_id"), F.lit("2022-01-01").alias("dt"),
        F.when(F.col("id") < 41, "red ring").otherwise("bolt").alias("sku_name"), F.lit(1).cast("long").alias("user_id"))
    for f in schemas.ORDER_WIDE:
        if f.name not in wide.columns:
            wide = wide.withColumn(f.name, F.lit(None).cast(f.dataType))
    users = spark.createDataFrame([("1", 33, "L")], "id string, user_age long, user_level string")
    got = reports.sale_detail_page(wide, users, "2022-01-01", "ring", 3, 20).collect()
    assert [(r["order_detail_id"], r["total"], r["user_age"]) for r in got] == [("040", 41, 33)]
    assert reports.sale_detail_page(wide, users, "2022-01-01", "", 1, 100).count() == 45


def test_registered_detail_page_has_twenty_of_all_lines_of_the_day(spark, tmp_path):
    day = datetime(1998, 6, 15)
    tables = {
        "orders": spark.createDataFrame([(n, 1, "O", 100.0, day, "1") for n in range(5)], "o_orderkey long, o_custkey long, o_orderstatus string, "
                                        "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": spark.createDataFrame([(n % 5, 3, 2, n // 5, 40.0, 4.0) for n in range(25)], "l_orderkey long, l_partkey long, "
                                          "l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"),
        "customer": spark.createDataFrame([(1, 5, 1.0, "S")], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": spark.createDataFrame([(3, "a b", "Brand#12", "T", 1.0)], "p_partkey long, p_name string, p_brand string, "
                                      "p_type string, p_retailprice double")}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    got = batch.batch_queries()["sale_detail_page"](spark, str(tmp_path)).collect()
    assert len(got) == 20 and {(r["total"], r["sku_tm_id"]) for r in got} == {(25, "12")}
