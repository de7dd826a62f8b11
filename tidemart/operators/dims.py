"""Dimension rows and lookups into dimension tables.

Joins leave the choice to Spark, which broadcasts a side whose size is below
`spark.sql.autoBroadcastJoinThreshold` and otherwise shuffles both, splitting hot
keys (see `session.RUNTIME_CONF`). Only the keys of a micro-batch and short lists of
names carry a hint, once they have been counted: their size cannot be known from files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.people import age_group, gender_name


def describe_users(users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Add age group and gender name; `as_of` defaults to today."""
    day = F.current_date() if as_of is None else as_of
    return users.withColumns({
        "age_group": age_group(F.to_date("birthday"), day),
        "gender_name": gender_name(F.col("gender"))})


def enrich_sku(sku: DataFrame, category3: DataFrame, trademark: DataFrame, spu: DataFrame) -> DataFrame:
    """SKU rows with the names of their category, brand and product; misses stay null."""
    c3 = category3.select(F.col("id").alias("category3_id"), F.col("name").alias("category3_name"))
    tm = trademark.select(F.col("id").alias("tm_id"), "tm_name")
    sp = spu.select(F.col("id").alias("spu_id"), "spu_name")
    return (sku.join(c3, "category3_id", "left").join(tm, "tm_id", "left").join(sp, "spu_id", "left")
            .select(*sku.columns, "category3_name", "spu_name", "tm_name"))


def keys_of(facts: DataFrame, fact_key: str, dim_key: str = "id", kind: str = "string") -> DataFrame:
    """The distinct keys some facts refer to, under the dimension's name and type."""
    return facts.select(F.col(fact_key).cast(kind).alias(dim_key)).distinct()


def rows_of_keys(dim: DataFrame, facts: DataFrame, fact_key: str, dim_key: str = "id") -> DataFrame:
    """Only the dimension rows some fact refers to, each once."""
    kind = dim.schema[dim_key].dataType.simpleString()
    return dim.join(keys_of(facts, fact_key, dim_key, kind), dim_key, "left_semi")


def few(rows: DataFrame, most: int) -> bool:
    return rows.limit(most + 1).count() <= most


def broadcast_if_few(keys: DataFrame, most: int = 500_000) -> DataFrame:
    """Keys marked for broadcast when counted to be few, so that the large table they
    are looked up in is not shuffled; more keys take the shuffled join."""
    return F.broadcast(keys) if few(keys, most) else keys
