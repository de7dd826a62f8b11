"""Message topics: Kafka on a cluster, folders of text files as the local twin.

Both give a streaming DataFrame with a `value` string column. Progress is kept
by the query's checkpoint, so the start position matters on the first run only.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tidemart.sources.tables import fs_path

# JSON messages repeat their field names: files of folder topics are about a tenth of the text.
COMPRESSION = "gzip"


def kafka_topic(spark: SparkSession, servers: str, topic: str, group: str | None = None,
                offsets: dict[int, int] | None = None, max_per_batch: int | None = None) -> DataFrame:
    """Topic from the latest position, or from given offsets per partition."""
    start = json.dumps({topic: {str(p): o for p, o in offsets.items()}}) if offsets else "latest"
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", start))
    if group:
        reader = reader.option("kafka.group.id", group)
    if max_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return reader.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value",
                                    "timestamp")


def write_kafka(messages: DataFrame, servers: str, topic: str) -> DataStreamWriter:
    """Sink for `value` (and `key`) columns of a stream."""
    return (messages.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic))


def file_topic(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Folder of text files, one message per line, oldest file first."""
    reader = spark.readStream.format("text").schema("value string") \
        .option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def messages_writer(messages: DataFrame) -> DataFrameWriter:
    """Writer of a folder topic's files, for `text`."""
    return messages.write.option("compression", COMPRESSION)


def append_file_topic(messages: DataFrame, path: str) -> None:
    """Put a batch of messages at the end of a folder topic."""
    messages_writer(messages.select("value")).mode("append").text(path)


def move_into_topic(spark: SparkSession, folder: str, path: str) -> None:
    """Put a folder of topic files, written by `messages_writer`, at the end of a folder topic without copying it.
    Both must lie in one file system; a folder that is not there had no messages."""
    fs, target = fs_path(spark, path)
    _, source = fs_path(spark, folder)
    fs.mkdirs(target)
    if fs.exists(source) and not fs.rename(source, fs_path(spark, f"{path}/{source.getName()}")[1]):
        raise OSError(f"could not move {folder} into {path}")


def to_console(df: DataFrame, rows: int = 1000) -> DataStreamWriter:
    return df.writeStream.format("console").option("numRows", rows).option("truncate", "false")
