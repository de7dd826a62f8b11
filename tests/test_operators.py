import re
from datetime import datetime

from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.operators import cdc, dau, dims, orders, search, stats, wide
from tidemart.plans import batch


def order_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, user_id long, create_time string, create_date string")


def wide_rows(spark, *lines):
    """(order, line id, price, count, listed, paid)"""
    df = spark.createDataFrame([(o, i, float(p), n, float(li), float(pa)) for o, i, p, n, li, pa in lines],
                               "order_id long, order_detail_id long, sku_price double, sku_num long, "
                               "original_total_amount double, final_total_amount double")
    for f in schemas.ORDER_WIDE:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.select(*schemas.ORDER_WIDE.fieldNames())


def test_status_row_decides_whatever_its_value(spark, rows):
    o = order_rows(spark, (1, 10, "t", "d"), (2, 11, "t", "d"), (3, 11, "t", "d"), (4, None, "t", "d"))
    status = spark.createDataFrame([(10, "0"), (10, "1")], "user_id long, if_consumed string")
    flagged = orders.flag_first_order(o, status)
    assert rows(flagged, "id", "if_first_order") == [(1, "0"), (2, "1"), (3, "1"), (4, "1")]


def test_one_first_order_per_user_in_a_batch(spark, rows):
    o = order_rows(spark, (5, 10, "2022-01-01 10:00:00", "d"), (4, 10, "2022-01-01 10:00:00", "d"),
                   (3, 10, "2022-01-01 11:00:00", "d"), (6, 11, "2022-01-01 09:00:00", "d"),
                   (7, 12, "2022-01-01 08:00:00", "d")).withColumn(
        "if_first_order", F.when(F.col("user_id") == 12, "0").otherwise("1"))
    fixed = orders.keep_one_first_order(o)
    assert rows(fixed, "id", "if_first_order") == [(3, "0"), (4, "1"), (5, "0"), (6, "1"), (7, "0")]
    assert rows(orders.first_order_users(fixed)) == [(10, "1"), (11, "1")]


def test_unknown_province_user_and_sku_leave_nulls(spark, rows):
    o = spark.createDataFrame([(1, 3, 10), (2, 99, 99)], "id long, province_id long, user_id long")
    province = spark.createDataFrame([("3", "P", "A", "I")], schemas.PROVINCE)
    users = spark.createDataFrame([("10", "lt20", "male")], "id string, age_group string, gender_name string")
    out = orders.join_user(orders.join_province(o, province), users)
    assert rows(out, "id", "province_name", "province_iso_code", "user_age_group", "user_gender") == [
        (1, "P", "I", "lt20", "male"), (2, None, None, None, None)]
    d = spark.createDataFrame([("a", 5), ("b", 6)], "id string, sku_id long")
    sku = dims.enrich_sku(
        spark.createDataFrame([("5", "s", "1", "n", "t", "c", "x")], schemas.SKU),
        spark.createDataFrame([("c", "cat", "1")], schemas.CATEGORY3),
        spark.createDataFrame([], schemas.TRADEMARK),
        spark.createDataFrame([("s", "spu")], schemas.SPU))
    assert rows(orders.join_sku(d, sku), "id", "tm_id", "tm_name", "category3_name", "spu_name") == [
        ("a", "t", None, "cat", "spu"), ("b", None, None, None, None)]


def test_apportioned_cents_add_up(spark, rows):
    w = wide_rows(spark,
                  (1, 1, 10, 1, 30, 10), (1, 2, 10, 1, 30, 10), (1, 3, 10, 1, 30, 10),
                  (2, 1, 5, 2, 10, 7.77),
                  (3, 1, 1, 1, 1, 0.99), (3, 2, 0, 1, 1, 0.99),
                  (4, 1, 0, 1, 0, 3.5))
    out = wide.apportion(w)
    assert rows(out, "order_id", "order_detail_id", "final_detail_amount") == [
        (1, 1, 3.33), (1, 2, 3.33), (1, 3, 3.34), (2, 1, 7.77), (3, 1, 0.99), (3, 2, 0.0),
        (4, 1, 3.5)]


def test_running_totals_over_stretches(spark, rows):
    df = spark.range(50).select(F.lit(1).alias("k"), F.col("id"), (F.col("id") * 3 % 7).alias("v"))
    out = wide.running_totals(df, "k", "id", {"total": F.col("v")}, F.floor(F.col("id") / 6))
    want, total = [], 0
    for i in range(50):
        total += i * 3 % 7
        want.append((i, total))
    assert sorted(rows(out, "id", "total")) == want


def test_running_totals_at_sampled_splitters(spark):
    """A key with a third of all rows is cut into stretches of about the wanted size; small keys stay whole."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100 + 1).alias("k"),
                                  (F.col("id") * 7919 % 9001 * 1000).alias("o"), (F.col("id") % 11).alias("v"))
    cut = wide.stretches(df, "k", "o", 200).groupBy("k", "_chunk").count().collect()
    hot = [r["count"] for r in cut if r["k"] == 0]
    assert len(hot) == 15 and max(hot) < 260 and all(r["_chunk"] == 0 for r in cut if r["k"] != 0)
    out = wide.running_totals(df, "k", "o", {"total": F.col("v")}, rows_each=200).collect()
    want, sums = {}, {}
    for k, o, v in sorted(tuple(r) for r in df.collect()):
        sums[k] = sums.get(k, 0) + v
        want[k, o] = sums[k]
    assert len(out) == 9000 and {(r["k"], r["o"]): r["total"] for r in out} == want


def test_shares_by_each_column_at_once(spark, rows):
    df = spark.createDataFrame([("m", "x", 3), ("f", "x", 1), (None, "y", 4)], "g string, a string, n long")
    assert rows(stats.shares_by_each(df, ["g", "a"], F.col("n"))) == [
        ("a", "x", 4, 0.5), ("a", "y", 4, 0.5), ("g", "f", 1, 0.125), ("g", "m", 3, 0.375), ("g", None, 4, 0.5)]


def test_hot_order_is_split_and_right(spark):
    """One order with a third of all lines: the join is split and the sums hold."""
    base = spark.range(0, 60000, numPartitions=8)
    lines = base.select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("order_id"),
        F.col("id").alias("order_detail_id"), F.lit(1.0).alias("sku_price"),
        F.lit(1).cast("long").alias("sku_num"))
    heads = base.where((F.col("id") % 3 != 0) | (F.col("id") == 0)).select(
        F.col("id").alias("_o"), F.when(F.col("id") == 0, 20000.0).otherwise(1.0).alias("original_total_amount"),
        F.when(F.col("id") == 0, 12345.67).otherwise(0.5).alias("final_total_amount"))
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
             "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        joined = lines.join(heads, F.col("order_id") == F.col("_o")).drop("_o").withColumn(
            "final_detail_amount", F.lit(None).cast("double"))
        out = wide.apportion(joined)
        per_order = out.groupBy("order_id").agg(
            F.round(F.sum("final_detail_amount"), 2).alias("s"), F.max("final_total_amount").alias("p"))
        assert per_order.where(F.col("s") != F.col("p")).count() == 0
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_brand_names_with_underscores_stay_apart(spark, rows):
    df = spark.createDataFrame([("1", "a_b", 1.1), ("1", "a_c", 2.2), ("1", "a_b", 0.2)],
                               "tm_id string, tm_name string, final_detail_amount double")
    assert rows(stats.brand_amounts(df)) == [("1", "a_b", 1.3), ("1", "a_c", 2.2)]


def test_top_brands_in_open_range_with_ties(spark):
    df = spark.createDataFrame([("t1", "b", "B", 5.0), ("t2", "a", "A", 5.0), ("t2", "c", "C", 9.0),
                                ("t3", "d", "D", 99.0), ("t0", "d", "D", 99.0)], schemas.BRAND_STAT)
    top = stats.top_brands(df, "t0", "t3", 2)
    assert [tuple(r) for r in top.collect()] == [("c", "C", 9.0), ("a", "A", 5.0)]
    assert [tuple(r) for r in stats.chart_points(top).collect()] == [("C", 9.0, 1), ("A", 5.0, 1)]


def test_canal_takes_inserts_of_any_table(spark, rows):
    df = spark.createDataFrame([('{"table":"x","type":"INSERT","data":[{"id":1},{"id":2}]}',),
                                ('{"table":"x","type":"UPDATE","data":[{"id":3}]}',), ("{bad",)], "value string")
    assert rows(cdc.split_canal(df)) == [("ods_x", '{"id":1}'), ("ods_x", '{"id":2}')]


def test_maxwell_rules(spark, rows):
    def env(table, kind, data):
        return (f'{{"table":"{table}","type":"{kind}","data":{data}}}',)
    df = spark.createDataFrame([
        env("order_info", "insert", '{"id":1}'), env("order_info", "update", '{"id":2}'),
        env("order_detail", "delete", '{"id":3}'), env("user_info", "delete", '{"id":4}'),
        env("sku_info", "bootstrap-insert", '{"id":5}'), env("sku_info", "insert", "{}"),
        env("sku_info", "insert", "null"), env("cart_info", "insert", '{"id":6}'), ("{bad",)], "value string")
    assert rows(cdc.split_maxwell(df)) == [
        ("ods_order_info", '{"id":1}'), ("ods_sku_info", '{"id":5}'), ("ods_user_info", '{"id":4}')]
    assert rows(cdc.split_maxwell(df, drop_deletes=True), "topic") == [("ods_order_info",), ("ods_sku_info",)]


def test_logs_with_a_start_object_are_start_logs(spark, rows):
    df = spark.createDataFrame([('{"start":{"entry":"x"},"ts":1}',), ('{"start":{},"ts":1}',),
                                ('{"start":null,"ts":1}',), ('{"ts":1}',)], "value string")
    assert rows(cdc.route_logs(df).groupBy("topic").count()) == [("log_event", 2), ("log_start", 2)]


def visit(mid, ms, ch="c"):
    return (mid, "u", "a", ch, "v", None, None, "00", ms)


def test_first_visit_per_device_and_day(spark, rows):
    day = 86400000
    raw = spark.createDataFrame([(m, ms) for m, ms in [
        ("m1", 3 * day - 1), ("m1", 3 * day), ("m1", 3 * day + 3600000), ("m2", 3 * day + 5)]], "mid string, ts long")
    logs = raw.select(F.struct("mid", *[F.lit("x").alias(c) for c in ("uid", "ar", "ch", "vc")]).alias("common"), "ts")
    visits = dau.first_visits(dau.flatten_start_logs(logs))
    assert rows(visits, "dt", "mid", "hr", "mi") == [
        ("1970-01-03", "m1", "23", "00"), ("1970-01-04", "m1", "00", "00"), ("1970-01-04", "m2", "00", "00")]
    assert rows(dau.new_devices(visits)) == [("1970-01-03", 1), ("1970-01-04", 1)]
    seen = visits.where(F.col("mid") == "m1")
    assert rows(dau.new_visits(dau.flatten_start_logs(logs), seen), "mid") == [("m2",)]


def test_search_page(spark):
    df = spark.createDataFrame([(1, "Red ring", "x", 5), (2, "ring", "x", 9), (3, "rings", "x", 99),
                                (4, "ring", "y", 7), (5, "a ring", "x", 9)], "id long, name string, kind string, score long")
    page = search.search_page(df, "name", "ring", {"kind": "x"}, [F.desc("score"), F.col("id")], 1, 2)
    assert [(r["id"], r["highlight"]) for r in page.collect()] == [(5, "a <em>ring</em>"), (1, "Red <em>ring</em>")]
    both = search.page_with_total(df, [F.col("id")], 4, 10)
    assert [(r["id"], r["total"]) for r in both.collect()] == [(5, 5)]
    assert search.get_by_id(df, "id", 4).count() == 1


def test_nested_values_must_be_of_one_entry(spark):
    df = spark.createDataFrame([(1, "ring", [(7, "a"), (8, "b")]), (2, "ring", [(7, "b")]), (3, "ring", []), (4, "ring", None),
                                (5, "bolt", [(7, "a")]), (6, "ring", [(None, "a")])],
                               "id long, name string, actors array<struct<id:int,role:string>>")

    def found(values):
        return sorted(r["id"] for r in search.search(df, "name", "ring", {}, {"actors": values}).collect())
    assert found({"id": 7, "role": "a"}) == [1] and found({"id": 7}) == [1, 2] and found({"role": "a"}) == [1, 6]
    assert found({"id": None}) == [6]


def test_term_index_finds_what_a_scan_finds(spark, tmp_path):
    texts = ["Red ring", "ring", "rings", "it's a ring.", "RING-bolt", None, "", "\u4e2d\u6587\u8bd7", "abc\u4e2dx", "\u6587\u4e2d", "s it",
             "Ring ring ring", "caf\u00e9 RING"] + [f"filler {i}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, name string").withColumn("kind", F.col("id") % 2)
    path = str(tmp_path / "terms")
    search.write_term_index(search.term_index(docs, "id", "name"), path)
    for query in ("ring", "it's", "\u4e2d\u6587", "\u4e2d", "caf\u00e9 filler", "ring-bolt", "nothing", "abc x"):
        want = sorted(r["id"] for r in search.search(docs, "name", query, {"kind": 0}).collect())
        hits = search.search_index(spark, path, docs, "id", "name", query, {"kind": 0})
        assert sorted(r["id"] for r in hits.collect()) == want, query
    one = spark.read.parquet(path).where(F.col("term") == "ring").select("bucket").distinct().collect()
    assert len(one) == 1


def test_deep_pages_equal_the_sorted_list(spark):
    df = spark.range(3000, numPartitions=5).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, 5)
                                                   .when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).alias("v"))
    for order in ({"v": False, "k": True}, {"v": True, "k": False}):
        full = [tuple(r) for r in df.orderBy(*search.sorting(order)).collect()]
        for start in (0, 1, 1490, 2700, 2995, 3000, 5000):
            got = [tuple(r) for r in search.page_deep(df, order, start, 10, most=100, ranges=8, sample=200).collect()]
            assert got == full[start: start + 10], (order, start)
        last = None
        for start in range(0, 60, 20):
            got = [tuple(r) for r in search.page_after(df, order, last, 20).collect()]
            assert got == full[start: start + 20]
            last = {"k": got[-1][0], "v": got[-1][1]}
        at = full[2900]
        got = [tuple(r) for r in search.page_after(df, order, {"k": at[0], "v": at[1]}, 20).collect()]
        assert got == full[2901: 2921]


def test_a_deep_page_sorts_few_rows(spark):
    """The rows that are sorted for the page are the range's, not all that come before it."""
    df = spark.range(20000).select(F.col("id").alias("k"))
    page = search.page_deep(df, {"k": True}, 18000, 20, most=500, ranges=16, sample=800)
    assert [r["k"] for r in page.collect()] == list(range(18000, 18020))
    inner = page._jdf.queryExecution().optimizedPlan().toString()
    offset = int(re.search(r"(?:Offset|TakeOrdered\w*\(offset=) ?(\d+)", inner).group(1))
    assert offset < 1500


def test_only_dimension_rows_in_use(spark, rows):
    sku = spark.createDataFrame([("1",), ("2",)], "id string")
    facts = spark.createDataFrame([(2,), (2,), (7,), (None,)], "sku_id long")
    assert rows(dims.rows_of_keys(sku, facts, "sku_id")) == [("2",)]


def test_keys_are_broadcast_only_when_few(spark, rows):
    table = spark.range(100).withColumn("d", F.col("id") % 10)

    def joined(most):
        df = table.join(dims.broadcast_if_few(spark.range(5), most), "id", "left_semi")
        return df.count(), "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert joined(5) == (5, True)
    assert joined(4) == (5, False)


def test_order_wide_deals_orders_twice_and_lines_without_names(spark, tmp_path):
    """Its exchanges, none saved by a broadcast of a large table: names of products, brands and categories stay out of them."""
    def table(name, columns, *data):
        spark.createDataFrame(list(data), columns).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    day = datetime(1998, 1, 1)
    table("region", "r_regionkey int, r_name string", (0, "R"))
    table("nation", "n_nationkey int, n_name string, n_regionkey int", (0, "N", 0))
    table("customer", "c_custkey long, c_nationkey int, c_mktsegment string", (1, 0, "S"), (2, None, "S"))
    table("part", "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double",
          (1, "red ring", "Brand#7", "LARGE", 1.0), (2, None, None, None, None))
    table("orders", "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
          (1, 1, "O", 10.0, day), (2, 1, "O", 5.0, day), (3, 9, "F", 1.0, day), (4, 2, "F", 0.0, day))
    table("lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double",
          (1, 1, 1, 1, 1.0, 10.0), (1, 2, 1, 2, 1.0, 10.0), (1, 1, 1, 3, 1.0, 10.0), (2, 8, 1, 1, 2.0, 5.0), (3, 1, 1, 1, 1.0, 1.0))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        df = batch.batch_queries()["order_wide"](spark, str(tmp_path))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert plan.count("Exchange hashpartitioning(user_id") + plan.count("Exchange hashpartitioning(province_id") == 2   # users, first orders
    assert [(r.order_id, r.order_detail_id // 100_000_000 % 10, r.final_detail_amount, r.if_first_order, r.province_name, r.tm_name, r.category3_name,
             r.spu_name, r.dt) for r in df.orderBy("order_detail_id").collect()] == [
        (1, 1, 3.33, "0", "N", "Brand#7", "LARGE", "red ring", "1998-01-01"), (1, 2, 3.33, "0", "N", None, None, None, "1998-01-01"),
        (1, 3, 3.34, "0", "N", "Brand#7", "LARGE", "red ring", "1998-01-01"), (2, 1, 5.0, "1", "N", None, None, None, "1998-01-01"),
        (3, 1, 1.0, "1", None, "Brand#7", "LARGE", "red ring", "1998-01-01")]
