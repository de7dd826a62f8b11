"""JSON records in and out."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType, StructField, StructType

_BAD = "_unreadable"


def once(value: Column) -> Column:
    """A column computed exactly once per row, for `select`. Spark copies a plain
    expression into every later filter and field that uses it, which is costly for
    JSON; a one-element explode is a step of its own that nothing is moved across."""
    return F.explode(F.array(value))


def _is_number(field: StructField) -> bool:
    return isinstance(field.dataType, NumericType)


def _parsed(df: DataFrame, schema: StructType, value: str, *keep: str) -> DataFrame:
    """`_exact`, the record read with its own types, and `_record`, the record of only those messages that do not read so
    (not `_good`), with numbers as text: many sources write every value as a string. Reading a JSON number as text
    costs Spark several times what reading the number does, so it is left to the messages that need it. A failed reading
    costs more than both: a message that is seen to hold one of its numbers as a text is read with numbers as text at once."""
    loose = [StructField(f.name, StringType()) if _is_number(f) else f for f in schema.fields]

    def read(text: str, fields: list[StructField]) -> Column:
        return F.from_json(F.col(text), StructType([*fields, StructField(_BAD, StringType())]),
                           {"columnNameOfCorruptRecord": _BAD})

    good = F.col("_exact").isNotNull() & F.col(f"_exact.{_BAD}").isNull()
    for f in schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            # a number too large for its type, or none, is judged by its text
            good = good & F.coalesce(F.abs(F.col(f"_exact.{f.name}")) < float("inf"), F.lit(True))
    exact, numbers = read(value, schema.fields), [f.name for f in schema.fields if _is_number(f)]
    if numbers:
        as_text = r'"(?:%s)"\s*:\s*"' % "|".join(re.escape(n) for n in numbers)
        exact = F.when(~F.col(value).rlike(as_text), exact)
    rows = df.select(*keep, F.col(value).alias("_value"), once(exact).alias("_exact"))
    return rows.withColumn("_good", good).select(
        *keep, "_exact", "_good", once(F.when(~F.col("_good"), read("_value", loose))).alias("_record"))


def _field(field: StructField) -> Column:
    value = F.col(f"_record.{field.name}")
    sent = value.try_cast(field.dataType) if _is_number(field) else value
    return F.when(F.col("_good"), F.col(f"_exact.{field.name}")).otherwise(sent).alias(field.name)


def _unreadable(schema: StructType) -> Column:
    """Broken JSON, or a text that is no number where one belongs."""
    bad = F.col("_record").isNull() | F.col(f"_record.{_BAD}").isNotNull()
    for f in schema.fields:
        if _is_number(f):
            sent = F.col(f"_record.{f.name}")
            bad = bad | (sent.isNotNull() & sent.try_cast(f.dataType).isNull())
    return ~F.col("_good") & bad


def parse_records(df: DataFrame, schema: StructType, value: str = "value", *keep: str) -> DataFrame:
    """JSON text to typed columns (and the columns to keep beside them), numbers also
    from text; see `unreadable_records` for what does not fit."""
    return _parsed(df, schema, value, *keep).where(~_unreadable(schema)).select(
        *[_field(f) for f in schema.fields], *keep)


def unreadable_records(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """The messages `parse_records` leaves out, as they came."""
    return _parsed(df, schema, value, value).where(_unreadable(schema)).select(value)


def marked_records(df: DataFrame, schema: StructType, value: str = "value", *keep: str) -> DataFrame:
    """A row per message, read once: the typed columns and the columns to keep, `_reason` null where `parse_records` takes
    it, else `broken` JSON or `number` where a text stands that is none, and then in `_sent` the message."""
    number = F.col("_record").isNotNull() & F.col(f"_record.{_BAD}").isNull()
    reason = F.when(_unreadable(schema), F.when(number, "number").otherwise("broken"))
    rows = _parsed(df.withColumn("_sent", F.col(value)), schema, value, *keep, "_sent")
    return rows.select(*[_field(f) for f in schema.fields], *keep, reason.alias("_reason"),
                       F.when(_unreadable(schema), F.col("_sent")).alias("_sent"))


def split_marked(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The readable rows of `marked_records`, and (value, reason) of the messages left out."""
    out = marked.where(F.col("_reason").isNotNull()).select(F.col("_sent").alias("value"), F.col("_reason").alias("reason"))
    return marked.where(F.col("_reason").isNull()).drop("_reason", "_sent"), out


def split_readable(df: DataFrame, schema: StructType, value: str = "value", *keep: str) -> tuple[DataFrame, DataFrame]:
    """`parse_records`, and beside it (value, reason) of the messages left out (see `marked_records`)."""
    return split_marked(marked_records(df, schema, value, *keep))


def to_record(df: DataFrame, *columns: str) -> Column:
    """One JSON object of the named columns (all of them by default)."""
    return F.to_json(F.struct(*(columns or df.columns)))


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows to topic messages, with a key column when one is named."""
    value = to_record(df).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)
