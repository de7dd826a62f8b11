"""Splitting change records and logs by target topic.

With `arrival`, each message carries where its change stands in the order of changes: the envelope's time `_ts`,
its place in the topic `_seq` (the topic's offset, or the envelope's own `seq` where a topic has none), its place
among the record's rows `_pos`, and the kind of change `_op`. Jobs downstream keep the last change by these, in
whatever order the messages come (see `schemas.VERSION`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.records import once
from tidemart.schemas import DIM_SCHEMAS, FACT_SCHEMAS


def _marked(data: Column, ts: Column, seq: Column, pos: Column, op: Column) -> Column:
    """The fields of the change's place put in front of a JSON object's own."""
    marks = F.to_json(F.struct(ts.alias("_ts"), seq.alias("_seq"), pos.alias("_pos"), op.alias("_op")))
    return F.concat(F.regexp_replace(marks, r"\}$", ","), F.regexp_replace(data, r"^\s*\{", ""))


def _place(envelopes: DataFrame) -> Column:
    """The topic's offset where there is one, else the envelope's own number."""
    return F.coalesce("offset", "e.seq") if "offset" in envelopes.columns else F.col("e.seq")


def split_canal(envelopes: DataFrame, value: str = "value", arrival: bool = False) -> DataFrame:
    """Envelopes `{table, type, data: [..]}`: inserts of any table, one message per row."""
    env = once(F.from_json(value, "table string, type string, ts long, seq long, data array<string>")).alias("e")
    keep = [c for c in ("offset",) if c in envelopes.columns]
    topic = F.concat(F.lit("ods_"), F.col("e.table")).alias("topic")
    inserts = envelopes.select(*keep, env).where(F.col("e.type") == "INSERT")
    if not arrival:
        return inserts.select(topic, F.explode("e.data").alias("value"))
    rows = inserts.select(topic, "e", _place(envelopes).alias("_seq"), F.posexplode("e.data").alias("_pos", "_data"))
    filled = F.coalesce(F.size(F.json_object_keys("_data")), F.lit(0)) > 0
    return rows.where(filled).select("topic", _marked(F.col("_data"), F.col("e.ts"), F.col("_seq"), F.col("_pos"),
                                                      F.lit("insert")).alias("value"))


def _maxwell(envelopes: DataFrame, value: str) -> DataFrame:
    env = once(F.from_json(value, "table string, type string, ts long, seq long, data string")).alias("e")
    keep = [c for c in ("offset",) if c in envelopes.columns]
    # the data must be an object with at least one field
    filled = F.coalesce(F.size(F.json_object_keys("e.data")), F.lit(0)) > 0
    return envelopes.select(F.col(value).alias("_value"), *keep, env).withColumn("_filled", filled)


def split_maxwell(envelopes: DataFrame, value: str = "value", drop_deletes: bool = False, arrival: bool = False) -> DataFrame:
    """Envelopes `{table, type, data: {..}}` with data: inserts of the two fact
    tables, changes of any kind of the six dimension tables, nothing else."""
    table, kind = F.col("e.table"), F.col("e.type")
    wanted = (table.isin(*FACT_SCHEMAS) & (kind == "insert")) | table.isin(*DIM_SCHEMAS)
    if drop_deletes:
        wanted = wanted & (kind != "delete")
    data = F.col("e.data")
    if arrival:
        data = _marked(data, F.col("e.ts"), _place(envelopes), F.lit(0), kind)
    return (_maxwell(envelopes, value).where(wanted & F.col("_filled"))
            .select(F.concat(F.lit("ods_"), table).alias("topic"), data.alias("value")))


def left_out_maxwell(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """(value, reason) of the envelopes `split_maxwell` leaves out: `broken` JSON or none of an envelope, another `table`,
    a `kind` of change that facts do not take, or `empty` data."""
    table, kind = F.col("e.table"), F.col("e.type")
    facts = table.isin(*FACT_SCHEMAS)
    reason = (F.when(table.isNull(), "broken")
              .when(~(facts | table.isin(*DIM_SCHEMAS)), "table")
              .when(facts & ~F.coalesce(kind == "insert", F.lit(False)), "kind")
              .when(~F.col("_filled"), "empty"))
    return (_maxwell(envelopes, value).select(F.col("_value").alias("value"), reason.alias("reason"))
            .where(F.col("reason").isNotNull()))


def route_logs(logs: DataFrame, value: str = "value", start_topic: str = "log_start",
               event_topic: str = "log_event") -> DataFrame:
    """Device logs with a `start` object go to one topic, all others to the second."""
    is_start = F.json_object_keys(F.get_json_object(value, "$.start")).isNotNull()
    topic = F.when(is_start, start_topic).otherwise(event_topic)
    return logs.select(once(topic).alias("topic"), F.col(value).alias("value"))
