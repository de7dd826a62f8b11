"""Tables the streaming jobs keep.

Every write is keyed by the micro-batch id and replaces what an earlier attempt
of the same batch left behind. Together with the query's checkpoint each batch
counts exactly once, also when it is run again after a lost driver or executor.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructType

from tidemart.schemas import BUCKET, VERSION, extended, versioned
from tidemart.sources.tables import fs_path as _fs_path

BATCH = "batch_id"
BUCKETS = 64            # key ranges of a compacted log
COMPACT_EVERY = 100     # batches between two compactions of a log
FOLDERS = 1000          # folders opened one by one; beyond, the whole table is listed


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return fs.exists(p)


# --- append log -----------------------------------------------------------

def append_batch(df: DataFrame, batch_id: int, path: str, *partitions: str) -> None:
    """Add one micro-batch's rows under `batch_id=<n>`, replacing a former attempt.

    Rows are brought together by partition value first, so that a folder gets few
    files; a value with very many rows is split over several tasks (rebalance)."""
    if partitions:
        df = df.hint("rebalance", *partitions)
    writer = df.write.mode("overwrite")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: StructType,
                 before: int | None = None) -> DataFrame:
    """All committed rows, or only those of earlier batches (for lookups that must
    not see a former attempt of the running batch). Empty before the first write."""
    full = extended(schema, **{BATCH: LongType()})
    if not _exists(spark, path):
        return spark.createDataFrame([], full)
    df = spark.read.schema(full).parquet(path).select(*full.fieldNames())
    bases = _versions(spark, f"{path}.base")
    if bases:
        base = spark.read.schema(full).parquet(f"{path}.base/v={bases[-1]}").select(*full.fieldNames())
        df = df.where(F.col(BATCH) > bases[-1]).unionByName(base)
    return df if before is None else df.where(F.col(BATCH) < before)


def compact_batches(spark: SparkSession, path: str, schema: StructType, upto: int,
                    key: str | None = None, partitions: tuple[str, ...] = (),
                    merge: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Put the rows of all batches up to `upto` into few files, with a `key` only the
    newest row of each, or what `merge` makes of them (with the batch column kept). `upto`
    must be a batch that has been committed.

    Readers change over when the new base is complete. Batch folders the base before
    this one already covered are dropped; the others stay for readers under way.
    """
    done = _versions(spark, f"{path}.base")
    rows = read_batches(spark, path, schema, before=upto + 1)
    if key:
        rows = latest_by_key(rows, key, (*[c for c in VERSION if c in rows.columns], BATCH))
    rows = merge(rows) if merge else rows
    writer = rows.hint("rebalance", *partitions).write.mode("overwrite")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(f"{path}.base/v={upto}")
    if done:
        fs, root = _fs_path(spark, path)
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith(f"{BATCH}=") and int(name[len(BATCH) + 1:]) <= done[-1]:
                fs.delete(status.getPath(), True)


def keep_short(spark: SparkSession, path: str, schema: StructType, batch_id: int, every: int = COMPACT_EVERY,
               **options) -> None:
    """Compact a log on every `every`-th batch, before that batch adds to it: a running batch means that
    the one before it has been committed."""
    if batch_id and batch_id % every == 0 and _exists(spark, path):
        compact_batches(spark, path, schema, batch_id - 1, **options)


# --- logs by key ------------------------------------------------------------
# What each batch adds is one small folder; compaction keeps the rest by key bucket. A
# lookup reads the few latest folders and only the buckets its keys fall into.

def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")


def append_keyed(rows: DataFrame, key: str, batch_id: int, path: str) -> None:
    append_batch(rows.select("*", bucket_of(key)), batch_id, path)


def rows_of_keys(spark: SparkSession, path: str, schema: StructType, keys: DataFrame, before: int | None = None) -> DataFrame:
    """The log's rows of the keys in a one-column frame. Rows added without a bucket are looked at, too."""
    key = keys.columns[0]
    buckets = [r[0] for r in keys.select(bucket_of(key)).distinct().collect()]
    rows = read_batches(spark, path, extended(schema, bucket=BUCKET), before)
    return rows.where(F.col("bucket").isin(buckets) | F.col("bucket").isNull()).join(keys, key, "left_semi")


def latest_rows(spark: SparkSession, path: str, schema: StructType, key: str = "id",
                of: DataFrame | None = None) -> DataFrame:
    """The newest row per key of an append log, or of only the keys in `of` (a one-column frame), which are
    picked before rows are compared. The change made last counts, whichever batch it came in; changes that say
    nothing about that are older than others and follow their batches. Deleted keys have no row."""
    full = versioned(schema)
    rows = read_batches(spark, path, full) if of is None else rows_of_keys(spark, path, full, of)
    return _living(latest_by_key(rows, key, (*VERSION, BATCH))).select(*schema.fieldNames())


def _living(rows: DataFrame) -> DataFrame:
    return rows.where(~F.coalesce("_deleted", F.lit(False)))


# --- tables by folder ---------------------------------------------------------
# Large tables by day: `dt=<day>/batch_id=<n>`. A batch opens the folders of its own days only. Where batches span
# years (a replay of old topics), `by="month"` keeps their number low.

def by_folder(df: DataFrame, by: str) -> DataFrame:
    return df.withColumn("month", F.substring("dt", 1, 7)) if by == "month" else df


def append_folders(df: DataFrame, batch_id: int, path: str, by: str = "dt") -> None:
    """Add one micro-batch's rows under each value's own folder, replacing a former attempt of the batch.

    A batch of very many even folders is written by all tasks; otherwise few tasks write, and a folder with a large
    part of the rows is split over several (rebalance)."""
    df = by_folder(df, by)
    sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)), F.max("n"), F.sum("n")).first()
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    even = sizes[0] > tasks and sizes[1] * tasks <= 4 * sizes[2]
    (df.withColumn(BATCH, F.lit(batch_id).cast("long")).transform(
        lambda d: d.repartition(tasks, by) if even else d.hint("rebalance", by))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by, BATCH).parquet(path))


def read_folders(spark: SparkSession, path: str, schema: StructType, values: list[str | None], by: str = "dt",
                 before: int | None = None) -> DataFrame:
    """The rows under some folders; what lies in other ones is not listed."""
    full = extended(schema, **{BATCH: LongType()})
    fs, root = _fs_path(spark, path)
    there = {s.getPath().getName() for s in fs.listStatus(root)} if fs.exists(root) else set()
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    folders = [f"{path}/{f}" for f in {name(by, v) for v in values} & there] if there else []
    if not folders:
        return spark.createDataFrame([], full)
    df = spark.read.schema(full).option("basePath", path).parquet(*folders).select(*full.fieldNames())
    return df if before is None else df.where(F.col(BATCH) < before)


def folders_of(spark: SparkSession, path: str, schema: StructType, rows: DataFrame, before: int, by: str = "dt") -> DataFrame:
    """What earlier batches stored in the folders `rows` belong to; the whole table where these are very many."""
    if not _exists(spark, path):
        return read_batches(spark, path, schema, before)
    values = [r[0] for r in by_folder(rows, by).select(by).distinct().limit(FOLDERS + 1).collect()]
    if len(values) > FOLDERS:
        return read_batches(spark, path, schema, before)
    return read_folders(spark, path, schema, values, by, before)


# --- documents by id ------------------------------------------------------

def upsert_documents(df: DataFrame, batch_id: int, path: str) -> None:
    """Documents with `dt` and `id`, stored under each row's own day."""
    append_folders(df, batch_id, path)


def read_documents(spark: SparkSession, path: str, schema: StructType, days: list[str] | None = None) -> DataFrame:
    """One document per day and id, the one of the latest batch; of some days only if named, and then
    no other day's folder is opened."""
    docs = read_batches(spark, path, schema) if days is None else read_folders(spark, path, schema, days)
    return latest_documents(docs).select(*schema.fieldNames())


def latest_documents(docs: DataFrame, key: tuple[str, ...] = ("dt", "id"),
                     version: str = BATCH) -> DataFrame:
    """One document per key, the one of the highest version."""
    values = [c for c in docs.columns if c not in key and c != version]
    newest = F.max_by(F.struct(*values), F.col(version)).alias("_doc")
    return docs.groupBy(*key).agg(newest).select(*key, "_doc.*")


# --- small dimension tables -----------------------------------------------
# Rewritten whole by each batch that changes them, so that their size is known and
# Spark can broadcast them. Large ones (users, SKUs) are append logs, read with
# `latest_rows` and kept short by `compact_batches`.

def _versions(spark: SparkSession, path: str) -> list[int]:
    """Ids of the completely written versions of a dimension table, ascending."""
    fs, root = _fs_path(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    found = [int(n[2:]) for n in names if n.startswith("v=")]
    return sorted(v for v in found if _exists(spark, f"{path}/v={v}/_SUCCESS"))


def _dim_rows(spark: SparkSession, path: str, schema: StructType, before: int | None = None) -> DataFrame:
    """The newest complete version with its marks of deleted keys."""
    done = [v for v in _versions(spark, path) if before is None or v < before]
    if not done:
        return spark.createDataFrame([], versioned(schema))
    return spark.read.schema(versioned(schema)).parquet(f"{path}/v={done[-1]}")


def read_dim(spark: SparkSession, path: str, schema: StructType,
             before: int | None = None) -> DataFrame:
    """Newest complete version of a dimension table; empty before the first write."""
    return _living(_dim_rows(spark, path, schema, before)).select(*schema.fieldNames())


def upsert_dim(rows: DataFrame, batch_id: int, path: str, schema: StructType, key: str = "id",
               keep: int = 3) -> None:
    """The change made last per key wins, within the batch and against what is stored; rows may have the
    columns of `schemas.versioned`. A deletion stays as a mark, so that an older change that comes
    later does not bring the key back. Changes that say nothing about their order are older than others,
    and the later batch's counts.

    Writes version `v=<batch_id>` from the newest older one; readers switch when its _SUCCESS mark appears.
    Older versions beyond `keep` are dropped, so a reader that has just opened one can finish."""
    spark = rows.sparkSession
    full = versioned(schema)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in full if f.name not in rows.columns}
    changed = rows.withColumns(missing).select(*full.fieldNames(), F.lit(1).alias("_new"))
    kept = _dim_rows(spark, path, schema, before=batch_id).withColumn("_new", F.lit(0))
    latest_by_key(kept.unionByName(changed), key, (*VERSION, "_new")).drop("_new") \
        .write.mode("overwrite").parquet(f"{path}/v={batch_id}")
    fs, _ = _fs_path(spark, path)
    for old in [v for v in _versions(spark, path) if v < batch_id][:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v={old}"), True)


def latest_by_key(rows: DataFrame, key: str | tuple[str, ...], version: str | tuple[str, ...] = ()) -> DataFrame:
    """The row of the highest version per key, a missing version being the lowest; among equal versions and
    without any, one row per key chosen by its values, the same one on every run."""
    keys = (key,) if isinstance(key, str) else key
    version = (version,) if isinstance(version, str) else version
    values = [c for c in rows.columns if c not in keys]
    body = F.struct(*values)
    rank = F.struct(*version, body)
    return rows.groupBy(*keys).agg(F.max_by(body, rank).alias("_row")) \
        .select(*keys, "_row.*").select(*rows.columns)


# --- raw landing ----------------------------------------------------------

def land_raw(messages: DataFrame, batch_id: int, path: str, day: str = "dt") -> None:
    """Raw message text, one folder per day."""
    messages.select("value", day).hint("rebalance", day).write.mode("overwrite").partitionBy(day) \
        .text(f"{path}/{BATCH}={batch_id}")
