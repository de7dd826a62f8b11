"""Record schemas. Fixed here, never inferred from data.

Keys of orders, lines and users are longs. Ids of the dimensions are opaque
strings: they are only compared, never computed with.
"""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def extended(base: StructType, **fields) -> StructType:
    """A new schema with more fields (`add` alone would change the given one)."""
    return StructType(base.fields + _struct(**fields).fields)


_s, _l, _d = StringType(), LongType(), DoubleType()

# When a change was made: the source's time, its place in the topic, its place in its record.
VERSION = ("_ts", "_seq", "_pos")


def arriving(base: StructType) -> StructType:
    """A record with its place in the order of changes and the kind of change (see `cdc`)."""
    return extended(base, **dict.fromkeys(VERSION, _l), _op=_s)


def versioned(base: StructType) -> StructType:
    """A stored row with the change it comes from; a deleted one stays as a mark."""
    return extended(base, **dict.fromkeys(VERSION, _l), _deleted=BooleanType())


ORDER_INFO = _struct(
    id=_l, province_id=_l, order_status=_s, user_id=_l,
    final_total_amount=_d, benefit_reduce_amount=_d, original_total_amount=_d, feight_fee=_d,
    expire_time=_s, create_time=_s, operate_time=_s)

ORDER_INFO_ENRICHED = _struct(
    id=_l, province_id=_l, order_status=_s, user_id=_l,
    final_total_amount=_d, benefit_reduce_amount=_d, original_total_amount=_d, feight_fee=_d,
    expire_time=_s, create_time=_s, operate_time=_s,
    create_date=_s, create_hour=_s, if_first_order=_s,
    province_name=_s, province_area_code=_s, province_iso_code=_s,
    user_age_group=_s, user_gender=_s)

ORDER_DETAIL = _struct(
    id=_l, order_id=_l, sku_id=_l, order_price=_d, sku_num=_l, sku_name=_s, create_time=_s)

ORDER_DETAIL_ENRICHED = _struct(
    id=_l, order_id=_l, sku_id=_l, order_price=_d, sku_num=_l, sku_name=_s, create_time=_s,
    spu_id=_s, tm_id=_s, category3_id=_s, spu_name=_s, tm_name=_s, category3_name=_s)

ORDER_WIDE = _struct(
    order_detail_id=_l, order_id=_l, order_status=_s, create_time=_s, user_id=_l,
    sku_id=_l, sku_price=_d, sku_num=_l, sku_name=_s,
    benefit_reduce_amount=_d, feight_fee=_d, original_total_amount=_d, final_total_amount=_d,
    final_detail_amount=_d, if_first_order=_s,
    province_name=_s, province_area_code=_s, user_age_group=_s, user_gender=_s, dt=_s,
    spu_id=_s, tm_id=_s, category3_id=_s, spu_name=_s, tm_name=_s, category3_name=_s)

PROVINCE = _struct(id=_s, name=_s, area_code=_s, iso_code=_s)
USER = _struct(id=_s, user_level=_s, birthday=_s, gender=_s)
TRADEMARK = _struct(id=_s, tm_name=_s)
TRADEMARK_MESSAGE = extended(TRADEMARK, tm_id=_s)   # the source names the key tm_id
CATEGORY3 = _struct(id=_s, name=_s, category2_id=_s)
SPU = _struct(id=_s, spu_name=_s)
SKU = _struct(id=_s, spu_id=_s, price=_s, sku_name=_s, tm_id=_s, category3_id=_s, create_time=_s)

USER_DESCRIBED = extended(USER, age_group=_s, gender_name=_s)
SKU_ENRICHED = extended(SKU, category3_name=_s, spu_name=_s, tm_name=_s)
DONE_ORDER = _struct(order_id=_l, last_id=_l, rest=_l, tm_id=_s, tm_name=_s, dt=_s, hr=_s)
UNFINISHED_ORDER = _struct(order_id=_l, dt=_s, hr=_s, lines=_l, came=_l, listed=_l, paid=_l, shared=_l)
ORDER_DOCUMENT = extended(ORDER_INFO_ENRICHED, dt=_s)
STORED_WIDE = ORDER_WIDE
WINDOW_COUNT = _struct(window_start=TimestampType(), n=_l)

USER_STATUS = _struct(user_id=_l, if_consumed=_s)
FIRST_SEEN = _struct(mid=_s, dt=_s)
BUCKET, LONG = IntegerType(), LongType()

# Sums a stream keeps: of whole numbers (rows or cents) per day and hour, hour null for whole days.
HOUR_SUM = _struct(dt=_s, hr=_s, value=_l)

# A line with its order, or without one.
LINE_OUTCOME = _struct(order_id=_l, order_detail_id=_l, matched=BooleanType())

# A message a job leaves out, and why.
LEFT_OUT = _struct(value=_s, reason=_s)

START_LOG = StructType([
    StructField("common", _struct(mid=_s, uid=_s, ar=_s, ch=_s, vc=_s)),
    StructField("start", _struct(entry=_s, event_id=_l)),
    StructField("ts", _l)])

DAU = _struct(mid=_s, uid=_s, ar=_s, ch=_s, vc=_s, dt=_s, hr=_s, mi=_s, ts=_l)

BRAND_STAT = _struct(stat_time=_s, trademark_id=_s, trademark_name=_s, amount=_d)

# Tables of the source database and the record each one carries.
DIM_SCHEMAS = {
    "base_province": PROVINCE,
    "user_info": USER,
    "base_trademark": TRADEMARK,
    "base_category3": CATEGORY3,
    "spu_info": SPU,
    "sku_info": SKU,
}
FACT_SCHEMAS = {"order_info": ORDER_INFO, "order_detail": ORDER_DETAIL}
