"""The batch queries by name. Each takes (spark, folder of the tables)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart import schemas
from tidemart.functions.money import from_cents, line_cents, round_half_up, to_cents
from tidemart.functions.people import age_years
from tidemart.functions.records import as_messages, parse_records, unreadable_records
from tidemart.functions.times import day_after, day_before
from tidemart.operators import cdc, dau, dims, orders, search, stats, wide
from tidemart.plans import reports
from tidemart.session import configure, new_workdir
from tidemart.sources import fixtures
from tidemart.sources.sinks import latest_by_key, latest_documents
from tidemart.sources.tables import Tables, parquet_tables

SALES_DAY = "1998-06-15"
VISIT_DAY = "2024-01-15"
KEYWORD = "x1 x2 x3 x4 x5 x6 x7 x8 x9 x10 x11 x12"

MOST_NAMES = 50_000     # rows of a list of names that is broadcast, at most

_QUERIES = {}


def query(fn):
    """Register a function of the table reader under its own name (a leading
    underscore keeps it apart from an imported one)."""
    def run(spark, folder):
        return fn(parquet_tables(configure(spark), folder))
    _QUERIES[fn.__name__.strip("_")] = run
    return fn


def batch_queries():
    return dict(_QUERIES)


# --- building blocks -------------------------------------------------------

def as_of() -> Column:
    return F.lit(fixtures.AS_OF).cast("date")


def users(t: Tables) -> DataFrame:
    return dims.describe_users(fixtures.user_info(t), as_of())


def sku(t: Tables) -> DataFrame:
    return dims.enrich_sku(fixtures.sku_info(t), fixtures.base_category3(t),
                           fixtures.base_trademark(t), fixtures.spu_info(t))


def branded_sku(t: Tables) -> DataFrame:
    """SKU rows with the name of their brand only."""
    return fixtures.sku_info(t).join(
        fixtures.base_trademark(t).withColumnRenamed("id", "tm_id"), "tm_id", "left")


def dated_orders(t: Tables, days=None, province: bool = False) -> DataFrame:
    return orders.with_date_hour(fixtures.order_info(t, days, province))


def flagged_orders(t: Tables, province: bool = False) -> DataFrame:
    return orders.keep_one_first_order(dated_orders(t, province=province))


def enriched_orders(t: Tables) -> DataFrame:
    """Orders with province, user and flag. What hangs on the user comes first and the flag, matched on the order's id,
    after it, so that orders are dealt by user once and then by id once, as the join with their lines needs them."""
    flagged = orders.keep_one_first_order(orders.join_user(fixtures.order_info(t), users(t)))
    provinces = dims.broadcast_if_few(fixtures.base_province(t), MOST_NAMES)
    return orders.with_date_hour(orders.join_province(flagged, provinces))


def enriched_details(t: Tables) -> DataFrame:
    return orders.join_sku(fixtures.order_detail(t), sku(t))


ORDER_DIMS = ("if_first_order", "province_name", "province_area_code", "user_age_group", "user_gender")
SKU_NAMES = ("spu_name", "tm_name", "category3_name")
SKU_DIMS = ("spu_id", "tm_id", "category3_id", *SKU_NAMES)


def with_nulls(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Add text columns nobody is going to fill in."""
    missing = [n for n in names if n not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(n) for n in missing])


def plain_wide(t: Tables, days=None) -> DataFrame:
    """Wide rows with the order, line and amount columns only, for the reports that
    need no dimension; the dimension columns are null."""
    return wide.to_wide(with_nulls(dated_orders(t, days), ORDER_DIMS),
                        with_nulls(fixtures.order_detail(t, days), SKU_DIMS))


def wide_rows(t: Tables) -> DataFrame:
    """Wide rows with all their columns. Names of categories, brands and products, where they are few, are looked up at the
    lines last, so that lines are dealt by order without them."""
    lists = fixtures.base_category3(t), fixtures.base_trademark(t), fixtures.spu_info(t)
    if not all(dims.few(names, MOST_NAMES) for names in lists):
        return wide.to_wide(enriched_orders(t), enriched_details(t))
    lines = orders.join_sku(fixtures.order_detail(t), with_nulls(fixtures.sku_info(t), SKU_DIMS))
    rows = wide.to_wide(enriched_orders(t), lines).drop(*SKU_NAMES)
    return dims.enrich_sku(rows, *map(F.broadcast, lists)).select(*schemas.ORDER_WIDE.fieldNames())


def payment_rests(t: Tables) -> DataFrame:
    """`wide.order_rests` of all orders, from rows of the numbers it needs."""
    lines = fixtures.order_detail(t).select("order_id", F.col("id").alias("order_detail_id"),
                                            line_cents(F.col("order_price"), F.col("sku_num")).alias("_line"))
    paid = fixtures.order_info(t, province=False).select(F.col("id").alias("order_id"), "final_total_amount", "original_total_amount")
    return wide.order_rests(lines.join(paid, "order_id"))


def paid_wide(t: Tables, days=None) -> DataFrame:
    return wide.apportion(plain_wide(t, days))


def brand_wide(t: Tables) -> DataFrame:
    """Apportioned wide rows with their brand and product filled in."""
    lines = paid_wide(t).drop(*SKU_DIMS)
    return orders.join_sku(lines, sku(t)).select(*schemas.ORDER_WIDE.fieldNames())


def start_rows(t: Tables, days=None) -> DataFrame:
    logs = cdc.route_logs(fixtures.device_logs(t, days))
    starts = logs.where(F.col("topic") == "log_start")
    return dau.flatten_start_logs(parse_records(starts, schemas.START_LOG))


def visits(t: Tables, days=None) -> DataFrame:
    return dau.first_visits(start_rows(t, days))


def _two_days(day: str) -> tuple[str, str]:
    return day_before(day), day_after(day)


def _one_day(day: str) -> tuple[str, str]:
    return day, day_after(day)


# --- parsing, routing, scalar rules ----------------------------------------

@query
def json_parse(t):
    messages = as_messages(fixtures.order_detail(t, spread=True))
    rows = parse_records(messages, schemas.ORDER_DETAIL)
    return rows.select("id", "order_id", "sku_id", "sku_num", "order_price", "sku_name")


@query
def json_roundtrip(t):
    messages = as_messages(fixtures.order_info(t), key="id")
    rows = parse_records(messages, schemas.ORDER_INFO)
    return rows.select("id", "province_id", "user_id", "order_status", "final_total_amount",
                       "original_total_amount", "create_time")


@query
def log_route(t):
    return cdc.route_logs(fixtures.device_logs(t)).groupBy("topic").agg(F.count("*").alias("n"))


@query
def start_log_flatten(t):
    return start_rows(t)


@query
def event_date_hour(t):
    rows = start_rows(t)
    return rows.select("mid", "ts", "dt", "hr")


@query
def order_date_hour(t):
    return dated_orders(t).select("id", "create_date", "create_hour")


@query
def user_age_group(t):
    return users(t).select("id", "birthday", "gender", "age_group", "gender_name",
                           age_years(F.to_date("birthday"), as_of()).alias("age"))


@query
def _round_half_up(t):
    """Ties and negative values: discounted prices and their negatives."""
    value = F.col("l_extendedprice") * F.col("l_discount")
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                round_half_up(value).alias("up"), round_half_up(-value).alias("down"))


@query
def line_amount(t):
    return fixtures.order_detail(t).select("id", from_cents(
        line_cents(F.col("order_price"), F.col("sku_num"))).alias("amount"))


@query
def cdc_canal_split(t):
    rows = cdc.split_canal(fixtures.canal_envelopes(t))
    return rows.select("topic", F.get_json_object("value", "$.id").alias("id"))


@query
def cdc_maxwell_split(t):
    rows = cdc.split_maxwell(fixtures.maxwell_envelopes(t))
    return rows.select("topic", F.get_json_object("value", "$.id").alias("id"))


def _canal_orders(t: Tables) -> DataFrame:
    return cdc.split_canal(fixtures.canal_text_envelopes(t)).where(F.col("topic") == "ods_order_info")


@query
def cdc_canal_typed(t):
    """Records whose values are all text, two in a message, to typed orders."""
    rows = parse_records(_canal_orders(t), schemas.ORDER_INFO)
    return rows.select("id", "user_id", "order_status", "final_total_amount")


@query
def dead_letters(t):
    """Order records with a text that is no number, kept as they came."""
    bad = unreadable_records(_canal_orders(t), schemas.ORDER_INFO)
    return bad.select(*[F.get_json_object("value", f"$.{n}").alias(n) for n in ("id", "user_id", "order_status")])


# --- dimensions and lookups ------------------------------------------------

@query
def dim_latest_by_key(t):
    """The brand of each product name as the latest part row (greatest key) says."""
    changes = t("part").select(F.col("p_name").alias("id"), F.col("p_brand").alias("tm_name"),
                               F.col("p_partkey").alias("version"))
    return latest_by_key(changes, "id", "version")


@query
def dim_semi_lookup(t):
    lines = fixtures.order_detail(t)
    return dims.rows_of_keys(fixtures.sku_info(t), lines, "sku_id").select("id", "spu_id", "tm_id")


@query
def sku_enrich(t):
    return sku(t)


@query
def order_join_province(t):
    return orders.join_province(fixtures.order_info(t), fixtures.base_province(t)).select(
        "id", "province_id", "province_name", "province_area_code", "province_iso_code")


@query
def order_join_user(t):
    return orders.join_user(fixtures.order_info(t, province=False), users(t)).select(
        "id", "user_id", "user_age_group", "user_gender")


@query
def detail_join_sku(t):
    return enriched_details(t)


# --- first orders ----------------------------------------------------------

@query
def first_order_flag(t):
    return orders.flag_first_order_by_day(dated_orders(t)).select("id", "user_id", "if_first_order")


@query
def first_order_corrected(t):
    return flagged_orders(t).select("id", "user_id", "if_first_order")


@query
def first_order_users(t):
    return orders.first_order_users(flagged_orders(t))


# --- wide rows and apportionment -------------------------------------------

@query
def order_detail_join(t):
    return plain_wide(t).select("order_id", "order_detail_id", "sku_id", "sku_num", "dt", "create_time")


@query
def order_wide(t):
    return wide.apportion(wide_rows(t), payment_rests(t))


@query
def order_apportion(t):
    return paid_wide(t).select("order_id", "order_detail_id", "final_total_amount", "final_detail_amount")


@query
def order_running_sum(t):
    lines = paid_wide(t).select(
        "order_id", "order_detail_id",
        line_cents(F.col("sku_price"), F.col("sku_num")).alias("origin"),
        to_cents(F.col("final_detail_amount")).alias("split"))
    ran = wide.running_totals(lines, "order_id", "order_detail_id",
                              {"origin_sum": F.col("origin"), "split_sum": F.col("split")})
    return ran.select("order_id", "order_detail_id", from_cents(F.col("origin_sum")).alias("origin_sum"),
                      from_cents(F.col("split_sum")).alias("split_sum"))


@query
def apportion_balance(t):
    """Orders whose lines do not add up to what was paid, counted with the rest."""
    sums = paid_wide(t).groupBy("order_id").agg(
        stats.sum_amount("final_detail_amount").alias("split"), F.max("final_total_amount").alias("paid"))
    return sums.groupBy((F.col("split") == F.col("paid")).alias("balanced")).agg(F.count("*").alias("n"))


# --- sales statistics ------------------------------------------------------

@query
def brand_amount(t):
    return stats.brand_amounts_of_lines(paid_wide(t), branded_sku(t))


def _brand_stats(t: Tables, days=None) -> DataFrame:
    """Statistics rows with each day of orders as one batch."""
    daily = stats.brand_amounts_of_lines(paid_wide(t, days), branded_sku(t), "dt")
    return daily.select(F.concat("dt", F.lit(" 00:00:00")).alias("stat_time"),
                        F.col("tm_id").alias("trademark_id"), F.col("tm_name").alias("trademark_name"), "amount")


STAT_RANGE = ("1996-01-01 00:00:00", "2000-12-31 00:00:00")
STAT_DAYS = ("1996-01-01", "2001-01-01")  # days whose rows may be inside, for the scan


@query
def brand_topn(t):
    return stats.top_brands(_brand_stats(t, STAT_DAYS), *STAT_RANGE, 10)


@query
def brand_topn_xys(t):
    return stats.chart_points(stats.top_brands(_brand_stats(t, STAT_DAYS), *STAT_RANGE, 5))


@query
def order_amount_total(t):
    return reports.order_amount_total(paid_wide(t, _one_day(SALES_DAY)), SALES_DAY)


@query
def order_amount_hour(t):
    return reports.order_amount_hour(paid_wide(t))


@query
def province_sales(t):
    bought = fixtures.order_info(t).select("id", "province_id", "final_total_amount").join(
        fixtures.order_detail(t).select(F.col("order_id").alias("id")), "id", "left_semi")
    return stats.province_sales_of_orders(bought, fixtures.base_province(t))


def _buyers(t: Tables) -> DataFrame:
    """Orders with the buyer's attributes and the number of their lines."""
    head = orders.join_user(fixtures.order_info(t, province=False), users(t))
    lines = fixtures.order_detail(t).groupBy("order_id").agg(F.count("*").alias("lines"))
    return lines.join(head.select(F.col("id").alias("order_id"), "user_gender", "user_age_group"), "order_id")


@query
def gender_share(t):
    return stats.shares(_buyers(t), "user_gender", F.col("lines"))


@query
def age_share(t):
    return stats.shares(_buyers(t), "user_age_group", F.col("lines"))


@query
def sale_detail_page(t):
    people = users(t).withColumn("user_age", age_years(F.to_date("birthday"), as_of()))
    return reports.sale_detail_page(plain_wide(t, _one_day(SALES_DAY)), people, SALES_DAY, "item", start_page=1, size=20,
                                    sku=fixtures.sku_info(t))


@query
def hit_shares(t):
    """Who bought what a keyword finds: lines by gender and by age group, from one aggregate."""
    return reports.hit_shares(plain_wide(t), users(t), KEYWORD)


# --- daily active devices --------------------------------------------------

@query
def dau_first_visit(t):
    return visits(t)


@query
def dau_total(t):
    return reports.dau_total(visits(t, _one_day(VISIT_DAY)), VISIT_DAY)


@query
def dau_hour(t):
    return dau.active_per_hour(dau.first_hours(start_rows(t)))


@query
def new_devices(t):
    return dau.new_devices(visits(t))


@query
def dau_today_yesterday(t):
    return reports.realtime_hour("dau", VISIT_DAY, visits=dau.first_hours(start_rows(t, _two_days(VISIT_DAY))))


@query
def amount_today_yesterday(t):
    return reports.realtime_hour("order_amount", SALES_DAY, wide=paid_wide(t, _two_days(SALES_DAY)))


@query
def realtime_total(t):
    return reports.realtime_total(visits(t), paid_wide(t, _one_day(VISIT_DAY)), VISIT_DAY)


@query
def realtime_total_sales_day(t):
    return reports.realtime_total(visits(t), paid_wide(t, _one_day(SALES_DAY)), SALES_DAY)


# --- documents -------------------------------------------------------------

@query
def doc_upsert_by_id(t):
    """Order documents written twice, first as ordered, then as paid: the later stays."""
    base = dated_orders(t).select(F.col("create_date").alias("dt"), F.col("id").cast("string").alias("id"),
                                  "user_id", "order_status")
    first = base.withColumn("order_status", F.lit("ordered")).withColumn("batch_id", F.lit(1))
    second = base.where(F.col("order_status") != "P").withColumn("batch_id", F.lit(2))
    return latest_documents(first.unionByName(second))


@query
def doc_get_by_id(t):
    return search.get_by_id(t("documents"), "doc_id", 42)


@query
def doc_search(t):
    return search.search_page(t("documents"), "text", "the tion", {"lang": "en", "source": "src3"},
                              [F.desc("n_chars"), F.col("doc_id")], 0, 20)


@query
def doc_search_nested(t):
    """Texts with a word, of which one label entry says good and not toxic."""
    labels = t("labels").groupBy("doc_id").agg(F.collect_list(F.struct("quality", "toxic")).alias("labels"))
    docs = t("documents").join(labels, "doc_id")
    return search.search_page(docs, "text", "the tion", {"lang": "en"}, [F.desc("n_chars"), F.col("doc_id")], 0, 20,
                              {"labels": {"quality": 1, "toxic": 0}}).drop("labels")


@query
def doc_search_index(t):
    """The search through a stored term index."""
    docs, path = t("documents"), new_workdir(t.spark, "terms")
    search.write_term_index(search.term_index(docs, "doc_id", "text"), path)
    hits = search.search_index(t.spark, path, docs, "doc_id", "text", "the tion", {"lang": "en", "source": "src3"})
    return search.page(hits, [F.desc("n_chars"), F.col("doc_id")], 0, 20)


BY_LENGTH = {"n_chars": False, "doc_id": True}


@query
def doc_page_deep(t):
    """Twenty documents by length from nine tenths down the list; ranges are cut until they hold a hundred rows."""
    docs = t("documents")
    start = docs.count() * 9 // 10
    return search.page_deep(docs, BY_LENGTH, start, 20, most=100, ranges=16, sample=1_024).select("doc_id", "n_chars", "lang", "source")


@query
def doc_page_after(t):
    """Twenty documents behind the last key seen."""
    return search.page_after(t("documents"), BY_LENGTH, {"n_chars": 500, "doc_id": 42}, 20).select("doc_id", "n_chars", "lang", "source")


@query
def doc_search_ascending(t):
    return search.search_page(t("documents"), "text", "the", {"lang": "en"},
                              [F.asc("n_chars"), F.col("doc_id")], 0, 10)
