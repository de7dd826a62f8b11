"""SQL twins of the registered queries, for a second engine on the same tables."""

from __future__ import annotations

_BASE = """
WITH order_detail AS (
  SELECT l_orderkey * 1000000000 + l_linenumber * 100000000 + ((l_partkey * 1009 + l_suppkey) * 51 + CAST(l_quantity AS BIGINT)) % 100000000 AS id,
         l_orderkey AS order_id, l_partkey AS sku_id, l_extendedprice / l_quantity AS order_price,
         CAST(l_quantity AS BIGINT) AS sku_num, concat('item ', l_partkey, ' x', CAST(l_quantity AS BIGINT)) AS sku_name,
         CAST(floor(l_extendedprice / l_quantity * CAST(l_quantity AS BIGINT) * 100.0::DOUBLE
                    + 0.5::DOUBLE) AS BIGINT) AS line,
         l_linenumber, l_returnflag
  FROM lineitem),
listed AS (SELECT order_id, CAST(sum(line) AS BIGINT) AS listed FROM order_detail GROUP BY order_id),
order_time AS (
  SELECT *, o_orderdate + to_hours((o_orderkey * 7919) % 24) + to_minutes(o_orderkey % 60) AS moment,
         CAST(floor(o_totalprice * 100.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS paid
  FROM orders),
order_info AS (
  SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS province_id, o_orderstatus AS order_status,
         o_custkey AS user_id, o_totalprice AS final_total_amount,
         greatest(listed - paid, 0) / 1e2 AS benefit_reduce_amount, listed / 1e2 AS original_total_amount,
         greatest(paid - listed, 0) / 1e2 AS feight_fee, strftime(moment, '%Y-%m-%d %H:%M:%S') AS create_time,
         strftime(moment, '%Y-%m-%d') AS create_date, strftime(moment, '%H') AS create_hour, paid, listed
  FROM (SELECT t.*, coalesce(l.listed, 0) AS listed FROM order_time t LEFT JOIN listed l ON o_orderkey = order_id)
  LEFT JOIN customer ON o_custkey = c_custkey),
base_province AS (
  SELECT n_nationkey AS id, n_name AS name, r_name AS area_code, concat('ISO-', n_nationkey) AS iso_code
  FROM nation JOIN region ON n_regionkey = r_regionkey),
user_days AS (
  SELECT c_custkey, c_mktsegment, CAST((c_custkey * 37) % 20000 AS INTEGER) + 3650 AS days,
         CASE WHEN c_custkey % 3 = 0 THEN 'M' WHEN c_custkey % 3 = 1 THEN 'F' END AS gender FROM customer),
user_info AS (
  SELECT c_custkey AS id, c_mktsegment AS user_level, gender,
         strftime(DATE '2001-08-01' - days, '%Y-%m-%d') AS birthday, days // 365 AS age,
         CASE WHEN days // 365 < 20 THEN 'lt20' WHEN days // 365 <= 30 THEN '20_30' ELSE 'gt30' END AS age_group,
         CASE WHEN gender = 'M' THEN 'male' ELSE 'female' END AS gender_name FROM user_days),
sku_info AS (
  SELECT p_partkey AS id, replace(p_name, ' ', '-') AS spu_id, CAST(p_retailprice AS VARCHAR) AS price,
         concat('item ', p_partkey) AS sku_name, regexp_extract(p_brand, '(\\d+)', 1) AS tm_id,
         lower(p_type) AS category3_id, '1995-01-01 00:00:00' AS create_time,
         p_type AS category3_name, p_name AS spu_name, p_brand AS tm_name FROM part),
first_day AS (
  SELECT *, CASE WHEN create_date = min(create_date) OVER (PARTITION BY user_id) THEN '1' ELSE '0' END AS day_flag,
         CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1
              THEN '1' ELSE '0' END AS if_first_order
  FROM order_info),
share AS (
  SELECT d.id AS order_detail_id, d.order_id, d.line, d.sku_id, o.paid, o.listed, o.create_date AS dt,
         o.create_hour AS hr, o.final_total_amount,
         coalesce(CAST(floor(CAST(o.paid AS DOUBLE) * d.line / nullif(o.listed, 0) + 0.5::DOUBLE) AS BIGINT), 0) AS part,
         row_number() OVER (PARTITION BY d.order_id ORDER BY d.id) AS rn,
         count(*) OVER (PARTITION BY d.order_id) AS n
  FROM order_detail d JOIN order_info o ON d.order_id = o.id),
split AS (
  SELECT *, CASE WHEN rn < n THEN part ELSE paid - coalesce(CAST(sum(part) OVER (PARTITION BY order_id
              ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) END AS final_cents
  FROM share),
device_log AS (
  SELECT event_id, concat('mid_', user_id) AS mid, CAST(user_id AS VARCHAR) AS uid,
         json_extract_string(props, '$.k') AS ar, event_type AS ch, 'v1' AS vc,
         strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr, '00' AS mi, epoch_us(ts) // 1000 AS ts
  FROM events),
start_log AS (SELECT * EXCLUDE (event_id) FROM device_log WHERE ch <> 'error'),
visit AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY dt, mid
             ORDER BY ts, uid, ar, ch, vc, hr, mi) AS rn FROM start_log) WHERE rn = 1)
"""

_WIDE = """
, wide AS (
  SELECT s.order_detail_id, s.order_id, f.order_status, f.create_time, f.user_id, s.sku_id,
         d.order_price AS sku_price, d.sku_num, d.sku_name, f.benefit_reduce_amount, f.feight_fee,
         f.original_total_amount, f.final_total_amount, s.final_cents / 1e2 AS final_detail_amount,
         f.if_first_order, p.name AS province_name, p.area_code AS province_area_code,
         u.age_group AS user_age_group, u.gender_name AS user_gender, s.dt,
         k.spu_id, k.tm_id, k.category3_id, k.spu_name, k.tm_name, k.category3_name
  FROM split s JOIN first_day f ON s.order_id = f.id JOIN order_detail d ON s.order_detail_id = d.id
  LEFT JOIN base_province p ON f.province_id = p.id LEFT JOIN user_info u ON f.user_id = u.id
  LEFT JOIN sku_info k ON s.sku_id = k.id)
"""

_SUM = "CAST(sum({0}) AS BIGINT) / 1e2"


def _sum(column: str = "final_cents") -> str:
    return _SUM.format(column)


_BRANDS = f"""SELECT tm_id AS trademark_id, tm_name AS trademark_name, {_sum()} AS amount
FROM split JOIN sku_info ON sku_id = sku_info.id
WHERE concat(dt, ' 00:00:00') > '1996-01-01 00:00:00' AND concat(dt, ' 00:00:00') < '2000-12-31 00:00:00'
GROUP BY ALL ORDER BY amount DESC, trademark_id LIMIT {{top}}"""

_CARDS = """SELECT 'dau' AS id, CAST(count(*) AS DOUBLE) AS value FROM visit WHERE dt = '{day}'
UNION ALL SELECT 'new_mid', CAST(count(*) AS DOUBLE) FROM
  (SELECT mid, min(dt) AS d FROM visit GROUP BY mid) WHERE d = '{day}'
UNION ALL SELECT 'order_amount', CAST(sum(final_cents) AS BIGINT) / 1e2 FROM split WHERE dt = '{day}'"""

_SERIES = """SELECT h.hr, coalesce(t.v, 0) AS today, coalesce(y.v, 0) AS yesterday
FROM (SELECT lpad(CAST(range AS VARCHAR), 2, '0') AS hr FROM range(24)) h
LEFT JOIN ({per_hour}) t ON t.hr = h.hr AND t.dt = '{today}'
LEFT JOIN ({per_hour}) y ON y.hr = h.hr AND y.dt = '{yesterday}'"""

_WORDS = r"string_split_regex(lower(text), '[^\p{L}\p{N}]+')"

_KEYWORD = (r"list_has_any(string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}]+'), "
            "['x1', 'x2', 'x3', 'x4', 'x5', 'x6', 'x7', 'x8', 'x9', 'x10', 'x11', 'x12'])")

_AMOUNT_HOUR = f"SELECT dt, hr, {_sum()} AS {{0}} FROM split GROUP BY dt, hr"
_BRAND_SUM = f"SELECT tm_id, tm_name, {_sum()} AS amount FROM split JOIN sku_info ON sku_id = sku_info.id GROUP BY ALL"
_SPLIT_ROWS = "SELECT order_id, order_detail_id, final_total_amount, final_cents / 1e2 AS final_detail_amount FROM split"

# Queries over the base views.
_OVER_BASE = {
    "json_parse": "SELECT id, order_id, sku_id, sku_num, order_price, sku_name FROM order_detail",
    "json_roundtrip": """SELECT id, province_id, user_id, order_status, final_total_amount,
        original_total_amount, create_time FROM order_info""",
    "log_route": """SELECT CASE WHEN ch <> 'error' THEN 'log_start' ELSE 'log_event' END AS topic,
        count(*) AS n FROM device_log GROUP BY 1""",
    "start_log_flatten": "SELECT * FROM start_log",
    "event_date_hour": "SELECT mid, ts, dt, hr FROM start_log",
    "order_date_hour": "SELECT id, create_date, create_hour FROM order_info",
    "user_age_group": """SELECT CAST(id AS VARCHAR) AS id, birthday, gender, age_group, gender_name,
        CAST(age AS BIGINT) AS age FROM user_info""",
    "round_half_up": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        floor(l_extendedprice * l_discount * 100.0::DOUBLE + 0.5::DOUBLE) / 1e2 AS up,
        floor(-(l_extendedprice * l_discount) * 100.0::DOUBLE + 0.5::DOUBLE) / 1e2 AS down FROM lineitem""",
    "line_amount": "SELECT id, line / 1e2 AS amount FROM order_detail",
    "cdc_canal_split": """SELECT 'ods_order_detail' AS topic, CAST(id AS VARCHAR) AS id FROM order_detail
        UNION ALL SELECT 'ods_order_info', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus <> 'P'""",
    "cdc_maxwell_split": """SELECT 'ods_order_detail' AS topic, CAST(id AS VARCHAR) AS id FROM order_detail
        UNION ALL SELECT 'ods_order_info', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'O'
        UNION ALL SELECT 'ods_user_info', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal >= 0
        UNION ALL SELECT 'ods_base_province', CAST(id AS VARCHAR) FROM base_province
        UNION ALL SELECT 'ods_sku_info', CAST(id AS VARCHAR) FROM sku_info""",
    "cdc_canal_typed": """SELECT o_orderkey AS id, o_custkey AS user_id, o_orderstatus AS order_status,
        paid / 1e2 AS final_total_amount FROM order_time WHERE o_orderstatus <> 'P'
        UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, paid // 4 / 1e2 FROM order_time
        WHERE o_orderstatus <> 'P'""",
    "dead_letters": """SELECT CAST(o_orderkey AS VARCHAR) AS id, 'unknown' AS user_id, 'P' AS order_status
        FROM orders WHERE o_orderstatus = 'P'
        UNION ALL SELECT CAST(-o_orderkey AS VARCHAR), 'unknown', 'P' FROM orders WHERE o_orderstatus = 'P'""",
    "dim_latest_by_key": """SELECT p_name AS id, p_brand AS tm_name, p_partkey AS version FROM
        (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) AS rn FROM part) WHERE rn = 1""",
    "dim_semi_lookup": """SELECT CAST(id AS VARCHAR) AS id, spu_id, tm_id FROM sku_info
        WHERE id IN (SELECT l_partkey FROM lineitem)""",
    "sku_enrich": "SELECT * REPLACE (CAST(id AS VARCHAR) AS id) FROM sku_info",
    "order_join_province": """SELECT o.id, province_id, name AS province_name,
        area_code AS province_area_code, iso_code AS province_iso_code
        FROM order_info o LEFT JOIN base_province p ON o.province_id = p.id""",
    "order_join_user": """SELECT o.id, user_id, age_group AS user_age_group, gender_name AS user_gender
        FROM order_info o LEFT JOIN user_info u ON o.user_id = u.id""",
    "detail_join_sku": """SELECT d.id, order_id, sku_id, order_price, sku_num, d.sku_name, spu_id, tm_id,
        category3_id, spu_name, tm_name, category3_name
        FROM order_detail d LEFT JOIN sku_info s ON d.sku_id = s.id""",
    "first_order_flag": "SELECT id, user_id, day_flag AS if_first_order FROM first_day",
    "first_order_corrected": "SELECT id, user_id, if_first_order FROM first_day",
    "first_order_users": "SELECT DISTINCT user_id, '1' AS if_consumed FROM order_info",
    "order_detail_join": """SELECT order_id, d.id AS order_detail_id, sku_id, sku_num, create_date AS dt,
        create_time FROM order_detail d JOIN order_info o ON d.order_id = o.id""",
    "order_apportion": _SPLIT_ROWS,
    "order_running_sum": """SELECT order_id, order_detail_id,
        CAST(sum(line) OVER w AS BIGINT) / 1e2 AS origin_sum,
        CAST(sum(final_cents) OVER w AS BIGINT) / 1e2 AS split_sum
        FROM split WINDOW w AS (PARTITION BY order_id ORDER BY rn)""",
    "apportion_balance": """SELECT s = paid AS balanced, count(*) AS n FROM
        (SELECT order_id, CAST(sum(final_cents) AS BIGINT) AS s, max(paid) AS paid FROM split GROUP BY order_id)
        GROUP BY 1""",
    "brand_amount": _BRAND_SUM,
    "brand_topn": _BRANDS.format(top=10),
    "brand_topn_xys": f"SELECT trademark_name AS x, amount AS y, 1 AS s FROM ({_BRANDS.format(top=5)})",
    "order_amount_total": f"SELECT {_sum()} AS amount FROM split WHERE dt = '1998-06-15'",
    "order_amount_hour": _AMOUNT_HOUR.format("amount"),
    "province_sales": f"""SELECT province_name, province_area_code, amount,
        CAST(floor(amount / 100) AS BIGINT) AS band FROM
        (SELECT name AS province_name, area_code AS province_area_code, {_sum()} AS amount
         FROM split s JOIN order_info o ON s.order_id = o.id LEFT JOIN base_province p ON o.province_id = p.id
         GROUP BY ALL)""",
    "gender_share": """SELECT gender_name AS user_gender, count(*) AS n,
        floor(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 1e6 + 0.5::DOUBLE) / 1e6 AS share
        FROM split s JOIN order_info o ON s.order_id = o.id JOIN user_info u ON o.user_id = u.id GROUP BY 1""",
    "age_share": """SELECT age_group AS user_age_group, count(*) AS n,
        floor(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 1e6 + 0.5::DOUBLE) / 1e6 AS share
        FROM split s JOIN order_info o ON s.order_id = o.id JOIN user_info u ON o.user_id = u.id GROUP BY 1""",
    "sale_detail_page": """SELECT s.order_detail_id, s.order_id, o.user_id, s.sku_id,
        gender_name AS user_gender, CAST(age AS BIGINT) AS user_age, user_level, d.order_price AS sku_price,
        d.sku_name, k.tm_id AS sku_tm_id, s.dt, count(*) OVER () AS total
        FROM split s JOIN order_info o ON s.order_id = o.id JOIN order_detail d ON s.order_detail_id = d.id
        LEFT JOIN user_info u ON o.user_id = u.id LEFT JOIN sku_info k ON s.sku_id = k.id
        WHERE s.dt = '1998-06-15' ORDER BY order_detail_id LIMIT 20""",
    "hit_shares": """SELECT kind, value, n, floor(n / CAST(sum(n) OVER (PARTITION BY kind) AS DOUBLE) * 1e6 + 0.5::DOUBLE) / 1e6 AS share
        FROM (SELECT CASE WHEN grouping(gender_name) = 0 THEN 'gender' ELSE 'age' END AS kind,
                     CASE WHEN grouping(gender_name) = 0 THEN gender_name ELSE age_group END AS value, count(*) AS n
              FROM order_detail d JOIN order_info o ON d.order_id = o.id JOIN user_info u ON o.user_id = u.id
              WHERE """ + _KEYWORD.format("d.sku_name") + """ GROUP BY GROUPING SETS ((gender_name), (age_group)))""",
    "dau_first_visit": "SELECT * FROM visit",
    "dau_total": "SELECT count(*) AS n FROM visit WHERE dt = '2024-01-15'",
    "dau_hour": "SELECT dt, hr, count(*) AS n FROM visit GROUP BY dt, hr",
    "new_devices": """SELECT d AS dt, count(*) AS new_mid FROM
        (SELECT mid, min(dt) AS d FROM visit GROUP BY mid) GROUP BY d""",
    "dau_today_yesterday": _SERIES.format(
        per_hour="SELECT dt, hr, count(*) AS v FROM visit GROUP BY dt, hr",
        today="2024-01-15", yesterday="2024-01-14"),
    "amount_today_yesterday": _SERIES.format(
        per_hour=_AMOUNT_HOUR.format("v"), today="1998-06-15", yesterday="1998-06-14"),
    "realtime_total": _CARDS.format(day="2024-01-15"),
    "realtime_total_sales_day": _CARDS.format(day="1998-06-15"),
    "doc_upsert_by_id": """SELECT create_date AS dt, CAST(id AS VARCHAR) AS id, user_id,
        CASE WHEN order_status = 'P' THEN 'ordered' ELSE order_status END AS order_status FROM order_info""",
    # streams: the same result as the batch rule over the same rows
    "stream_dau": "SELECT * FROM visit",
    "stream_first_order": "SELECT id, user_id, if_first_order FROM first_day",
    "stream_dim_refresh": """SELECT d.id, order_id, sku_id, spu_id, tm_id, category3_id, spu_name, tm_name,
        category3_name FROM order_detail d LEFT JOIN sku_info s ON d.sku_id = s.id""",
    "stream_interval_join": """SELECT order_id, d.id AS order_detail_id
        FROM order_detail d JOIN order_time o ON d.order_id = o.o_orderkey
        WHERE abs(epoch(o.moment + to_seconds(CASE WHEN l_returnflag = 'R' THEN 120 ELSE 5 * l_linenumber END)
                        - o.moment)) <= 50""",
    "stream_apportion": _SPLIT_ROWS,
    "stream_dim_versions": r"""SELECT 'user' AS dim, CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS name FROM customer WHERE c_acctbal >= 0
        UNION ALL SELECT 'sku', CAST(p_partkey AS VARCHAR), concat('item ', p_partkey) FROM part WHERE p_size <= 45
        UNION ALL SELECT DISTINCT 'brand', regexp_extract(p_brand, '(\d+)', 1), p_brand FROM part WHERE p_brand < 'Brand#5'""",
    "stream_doc_upsert": "SELECT create_date AS dt, id, user_id, order_status, if_first_order FROM first_day",
    "stream_dead_letters": """SELECT 'split' AS job, 'taken' AS outcome,
            (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') + (SELECT count(*) FROM lineitem)
            + (SELECT count(*) FROM customer WHERE c_acctbal >= 0) AS n
        UNION ALL SELECT 'split', 'kind', count(*) FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 'split', 'empty', count(*) FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT 'split', 'table', count(*) FROM supplier
        UNION ALL SELECT 'split', 'broken', count(*) FROM nation
        UNION ALL SELECT 'users', 'taken', count(*) FROM customer WHERE c_acctbal >= 0
        UNION ALL SELECT 'orders', 'taken', count(*) FROM orders WHERE o_orderstatus = 'O'
        UNION ALL SELECT 'orders', 'number', count(*) FROM orders WHERE o_orderstatus = 'P'
        UNION ALL SELECT 'details', CASE WHEN l_quantity > 40 THEN 'number' ELSE 'taken' END, count(*) FROM lineitem GROUP BY 2
        UNION ALL SELECT 'shares', CASE WHEN l_quantity > 40 THEN 'number' ELSE 'taken' END, count(*) FROM lineitem GROUP BY 2
        UNION ALL SELECT 'visits', 'broken', count(*) FROM events WHERE event_type = 'error'""",
    "stream_hour_rollup": _AMOUNT_HOUR.format("amount"),
    "stream_new_devices": """SELECT d AS dt, count(*) AS new_mid FROM
        (SELECT mid, min(dt) AS d FROM visit GROUP BY mid) GROUP BY d""",
    "stream_day_cards": " UNION ALL ".join(f"""
        SELECT 'cards' AS request, id AS key, value AS today, CAST(NULL AS DOUBLE) AS yesterday, '{day}' AS day FROM ({_CARDS.format(day=day)})
        UNION ALL SELECT 'dau', hr, CAST(today AS DOUBLE), CAST(yesterday AS DOUBLE), '{day}' FROM ({_SERIES.format(
            per_hour="SELECT dt, hr, count(*) AS v FROM visit GROUP BY dt, hr", today=day, yesterday=before)})
        UNION ALL SELECT 'order_amount', hr, CAST(today AS DOUBLE), CAST(yesterday AS DOUBLE), '{day}' FROM ({_SERIES.format(
            per_hour=_AMOUNT_HOUR.format("v"), today=day, yesterday=before)})"""
        for day, before in (("1998-06-15", "1998-06-14"), ("2024-01-15", "2024-01-14"))),
    "stream_unmatched_lines": """SELECT order_id, id AS order_detail_id,
        CASE l_returnflag WHEN 'R' THEN 'unmatched' WHEN 'A' THEN 'late' ELSE 'matched' END AS outcome FROM order_detail""",
    "stream_unfinished_orders": """SELECT order_id, CASE WHEN came = listed THEN 'complete' ELSE 'unfinished' END AS state,
        (listed - came) / 1e2 AS open_amount, (paid - shared) / 1e2 AS unshared
        FROM (SELECT s.order_id, CAST(sum(s.line) AS BIGINT) AS came, CAST(sum(part) AS BIGINT) AS shared, max(s.paid) AS paid,
                     max(s.listed) AS listed
              FROM share s JOIN order_detail d ON s.order_detail_id = d.id
              WHERE l_returnflag <> 'R' AND (s.line <> 0 OR s.listed = 0) GROUP BY s.order_id)""",
    "stream_sliding_window": """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n FROM
        (SELECT time_bucket(INTERVAL 5 SECOND, ts) - to_seconds(5 * range) AS w FROM events, range(10))
        GROUP BY 1""",
    "stream_brand_amount": _BRAND_SUM,
    "stream_idempotent_replay": _BRAND_SUM,
    "stream_layers": _BRAND_SUM,
}

_OVER_WIDE = {
    "order_wide": "SELECT * FROM wide",
    "stream_order_wide": "SELECT * EXCLUDE (final_detail_amount) FROM wide",
}

# Queries straight over the tables.
_PLAIN = {
    "doc_get_by_id": "SELECT * FROM documents WHERE doc_id = 42",
    "doc_search": rf"""SELECT *, regexp_replace(text, '(?i)\b(the|tion)\b', '<em>\1</em>', 'g') AS highlight
        FROM documents WHERE lang = 'en' AND source = 'src3' AND list_has_any({_WORDS}, ['the', 'tion'])
        ORDER BY n_chars DESC, doc_id LIMIT 20""",
    "doc_search_nested": rf"""SELECT *, regexp_replace(text, '(?i)\b(the|tion)\b', '<em>\1</em>', 'g') AS highlight
        FROM documents d WHERE lang = 'en' AND list_has_any({_WORDS}, ['the', 'tion'])
        AND EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1 AND toxic = 0)
        ORDER BY n_chars DESC, doc_id LIMIT 20""",
    "doc_search_index": rf"""SELECT * FROM documents WHERE lang = 'en' AND source = 'src3'
        AND list_has_any({_WORDS}, ['the', 'tion']) ORDER BY n_chars DESC, doc_id LIMIT 20""",
    "doc_page_deep": """SELECT doc_id, n_chars, lang, source FROM (SELECT *, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rn,
            count(*) OVER () AS n FROM documents) WHERE rn > n * 9 // 10 AND rn <= n * 9 // 10 + 20""",
    "doc_page_after": """SELECT doc_id, n_chars, lang, source FROM documents WHERE n_chars < 500 OR (n_chars = 500 AND doc_id > 42)
        ORDER BY n_chars DESC, doc_id LIMIT 20""",
    "doc_search_ascending": rf"""SELECT *, regexp_replace(text, '(?i)\b(the)\b', '<em>\1</em>', 'g') AS highlight
        FROM documents WHERE lang = 'en' AND list_has_any({_WORDS}, ['the'])
        ORDER BY n_chars, doc_id LIMIT 10""",
}


def oracle_sql() -> dict[str, str]:
    out = {name: _BASE + sql for name, sql in _OVER_BASE.items()}
    out.update({name: _BASE + _WIDE + sql for name, sql in _OVER_WIDE.items()})
    out.update(_PLAIN)
    return out
