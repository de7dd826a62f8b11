from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.session import new_workdir
from tidemart.sources import sinks
from tidemart.sources.sinks import append_batch, read_batches, read_dim, upsert_dim


def test_a_batch_written_again_counts_once(spark, rows):
    path = new_workdir(spark, "t")
    assert read_batches(spark, path, schemas.USER_STATUS).count() == 0
    first = spark.createDataFrame([(1, "1"), (2, "1")], schemas.USER_STATUS)
    append_batch(first, 0, path)
    append_batch(first, 0, path)
    append_batch(spark.createDataFrame([(3, "1")], schemas.USER_STATUS), 1, path)
    assert rows(read_batches(spark, path, schemas.USER_STATUS), "user_id") == [(1,), (2,), (3,)]
    assert rows(read_batches(spark, path, schemas.USER_STATUS, before=1), "user_id") == [(1,), (2,)]


def test_dimension_upsert_last_write_wins_and_replays(spark, rows):
    path = new_workdir(spark, "t")
    assert read_dim(spark, path, schemas.TRADEMARK).count() == 0

    def brands(*pairs):
        return spark.createDataFrame(list(pairs), schemas.TRADEMARK)
    upsert_dim(brands(("1", "a"), ("2", "b")), 0, path, schemas.TRADEMARK)
    for _ in range(2):
        upsert_dim(brands(("2", "c"), ("3", "d")), 1, path, schemas.TRADEMARK)
    assert rows(read_dim(spark, path, schemas.TRADEMARK)) == [("1", "a"), ("2", "c"), ("3", "d")]
    for n in range(2, 8):
        upsert_dim(brands(("1", f"a{n}")), n, path, schemas.TRADEMARK)
    assert rows(read_dim(spark, path, schemas.TRADEMARK)) == [("1", "a7"), ("2", "c"), ("3", "d")]
    assert len(sinks._versions(spark, path)) == 4


def test_unfinished_dimension_version_is_not_read(spark, rows):
    path = new_workdir(spark, "t")
    upsert_dim(spark.createDataFrame([("1", "a")], schemas.TRADEMARK), 0, path, schemas.TRADEMARK)
    spark.createDataFrame([("1", "half")], schemas.TRADEMARK).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/v=1")
    assert rows(read_dim(spark, path, schemas.TRADEMARK)) == [("1", "a")]


def test_latest_row_per_key(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("a", "z", 2), ("b", None, 1)], "id string, n string, v long")
    assert rows(sinks.latest_by_key(df, "id", "v"), "id", "n") == [("a", "y"), ("b", None)]


def test_document_upsert_by_day_and_id(spark, rows):
    path = new_workdir(spark, "t")
    docs = spark.createDataFrame([("1", "old", "d1"), ("2", "only", "d2")], "id string, body string, dt string")
    sinks.upsert_documents(docs, 0, path)
    sinks.upsert_documents(docs.where(F.col("id") == "1").withColumn("body", F.lit("new")), 1, path)
    got = sinks.latest_documents(read_batches(spark, path, docs.schema))
    assert rows(got, "dt", "id", "body") == [("d1", "1", "new"), ("d2", "2", "only")]


def test_raw_landing_by_day(spark, rows):
    path = new_workdir(spark, "t")
    df = spark.createDataFrame([("m1", "2024-01-01"), ("m2", "2024-01-02")], "value string, dt string")
    sinks.land_raw(df, 0, path)
    back = spark.read.schema("value string, batch_id long, dt string").text(path)
    assert rows(back.where(F.col("dt") == "2024-01-02"), "value") == [("m2",)]


def test_compacted_log_reads_the_same(spark, rows):
    path = new_workdir(spark, "t")

    def put(n, *pairs):
        append_batch(spark.createDataFrame(list(pairs), schemas.TRADEMARK), n, path)

    def state():
        return (rows(sinks.latest_rows(spark, path, schemas.TRADEMARK)),
                read_batches(spark, path, schemas.TRADEMARK, before=2).count())
    put(0, ("1", "a"), ("2", "b"))
    put(1, ("2", "c"))
    put(2, ("3", "d"))
    assert state() == ([("1", "a"), ("2", "c"), ("3", "d")], 3)
    sinks.compact_batches(spark, path, schemas.TRADEMARK, 1)
    assert state() == ([("1", "a"), ("2", "c"), ("3", "d")], 3)
    sinks.compact_batches(spark, path, schemas.TRADEMARK, 2, key="id")
    assert state()[0] == [("1", "a"), ("2", "c"), ("3", "d")]
    assert read_batches(spark, path, schemas.TRADEMARK).count() == 3
    put(3, ("1", "z"))
    of = spark.createDataFrame([("1",), ("9",)], "id string")
    assert rows(sinks.latest_rows(spark, path, schemas.TRADEMARK, of=of)) == [("1", "z")]
    fs, root = sinks._fs_path(spark, path)
    assert sorted(s.getPath().getName() for s in fs.listStatus(root)) == ["batch_id=2", "batch_id=3"]


def test_compacted_log_keeps_its_partitions(spark, rows):
    path = new_workdir(spark, "t")
    df = spark.createDataFrame([("m1", "2024-01-01"), ("m2", "2024-01-02")], "mid string, dt string")
    append_batch(df, 0, path, "dt")
    append_batch(df, 1, path, "dt")
    sinks.compact_batches(spark, path, df.schema, 0, partitions=("dt",))
    got = read_batches(spark, path, df.schema)
    assert rows(got.where(F.col("dt") == "2024-01-02"), "mid", "batch_id") == [("m2", 0), ("m2", 1)]


def change(i, name, ts, seq, pos=0, gone=False):
    return (i, name, ts, seq, pos, gone)


def test_changes_count_in_the_order_they_were_made(spark, rows):
    path = new_workdir(spark, "t")
    full = schemas.versioned(schemas.TRADEMARK)

    def put(n, *changes):
        upsert_dim(spark.createDataFrame(list(changes), full), n, path, schemas.TRADEMARK)
        return rows(read_dim(spark, path, schemas.TRADEMARK))
    # "9" beats the later "1" by its value only; the place in a record decides last
    assert put(0, change("1", "9", 5, 1), change("1", "1", 5, 2), change("2", "a", 5, 1, 0), change("2", "b", 5, 1, 1)) == [
        ("1", "1"), ("2", "b")]
    # an older change that comes later, a deletion, and a change older than the deletion
    assert put(1, change("1", "old", 4, 9), change("2", None, 6, 1, gone=True)) == [("1", "1")]
    assert put(2, change("2", "back", 5, 9)) == [("1", "1")]
    assert put(2, change("2", "back", 5, 9)) == [("1", "1")]
    # a newer one brings the key back; changes that say nothing about their order are older than others
    assert put(3, change("2", "new", 7, 1), change("3", "plain", None, None, None, None)) == [("1", "1"), ("2", "new"), ("3", "plain")]
    assert put(4, change("1", "unknown", None, None, None, None), change("3", "later", None, None, None, None)) == [
        ("1", "1"), ("2", "new"), ("3", "later")]


def test_log_of_changes_in_any_order_and_compacted(spark, rows):
    path = new_workdir(spark, "t")
    full = schemas.versioned(schemas.TRADEMARK)

    def put(n, *changes):
        sinks.keep_short(spark, path, schemas.extended(full, bucket=schemas.BUCKET), n, every=2, key="id", partitions=("bucket",))
        sinks.append_keyed(spark.createDataFrame(list(changes), full), "id", n, path)

    def state(*keys):
        of = spark.createDataFrame([(k,) for k in keys], "id string") if keys else None
        return rows(sinks.latest_rows(spark, path, schemas.TRADEMARK, of=of))
    put(0, change("1", "b", 2, 1), change("2", "x", 1, 1))
    put(1, change("1", "a", 1, 1), change("2", None, 9, 1, gone=True))
    assert state() == [("1", "b")] and state("1") == [("1", "b")] and state("2") == []
    put(2, change("2", "y", 3, 1), change("3", "c", 1, 1))
    put(3, change("1", "z", 2, 2))
    put(4, change("4", "d", 1, 1))
    assert state() == [("1", "z"), ("3", "c"), ("4", "d")] and state("1", "2", "9") == [("1", "z")]
    assert sinks._versions(spark, f"{path}.base") == [1, 3]


def test_lookup_opens_only_the_buckets_of_its_keys(spark, rows):
    path = new_workdir(spark, "t")
    schema = schemas.extended(schemas.FIRST_SEEN, bucket=schemas.BUCKET)
    many = spark.range(2000).select(F.concat(F.lit("m"), "id").alias("mid"), F.lit("2024-01-01").alias("dt"))
    sinks.append_keyed(many, "mid", 0, path)
    sinks.compact_batches(spark, path, schema, 0, partitions=("bucket",))
    found = sinks.rows_of_keys(spark, path, schemas.FIRST_SEEN, spark.createDataFrame([("m7",), ("m8",), ("none",)], "mid string"))
    assert rows(found, "mid") == [("m7",), ("m8",)]
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert any("PartitionFilters: [" in line and "bucket" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)


def test_documents_lie_under_their_own_day(spark, rows):
    path = new_workdir(spark, "t")
    schema = "id string, body string, dt string"
    sinks.upsert_documents(spark.createDataFrame([("1", "a", "2024-01-01"), ("2", "b", "2024-01-02"), ("3", "c", None)], schema), 0, path)
    for _ in range(2):
        sinks.upsert_documents(spark.createDataFrame([("1", "A", "2024-01-01"), ("4", "d", "2024-01-09")], schema), 1, path)
    kind = spark.createDataFrame([], schema).schema
    assert rows(sinks.read_documents(spark, path, kind, ["2024-01-01", "1999-01-01"])) == [("1", "A", "2024-01-01")]
    assert rows(sinks.read_documents(spark, path, kind), "id", "body") == [("1", "A"), ("2", "b"), ("3", "c"), ("4", "d")]
    files = sinks.read_folders(spark, path, kind, ["2024-01-09"]).inputFiles()
    assert files and all("/dt=2024-01-09/batch_id=1/" in f for f in files)
    before = sinks.folders_of(spark, path, kind, spark.createDataFrame([("1", "", "2024-01-01")], schema), 1)
    assert rows(before, "id", "body") == [("1", "a")]
    # a replay over months
    sinks.append_folders(spark.createDataFrame([("1", "a", "2024-01-01"), ("2", "b", "2024-02-02")], schema), 0, f"{path}-m", "month")
    month = spark.createDataFrame([("9", "", "2024-02-20")], schema)
    assert rows(sinks.folders_of(spark, f"{path}-m", kind, month, 1, "month"), "id") == [("2",)]


def test_sums_of_batches_replayed_and_compacted(spark, rows):
    from tidemart.sources import rollups
    path = new_workdir(spark, "t")

    def put(n, *values):
        df = spark.createDataFrame(list(values), "dt string, hr string, v long")
        rollups.add_sums(df, n, path, F.col("v"), F.col("hr"), every=2)

    put(0, ("d1", "00", 1), ("d1", "00", 2), ("d1", "01", 5))
    put(1, ("d1", "00", 10))
    put(1, ("d1", "00", 10))
    want = [("d1", "00", 13), ("d1", "01", 5)]
    assert rows(rollups.read_sums(spark, path)) == want
    put(2, ("d2", None, 7))
    put(3, ("d2", None, -7))
    put(4, ("d1", "01", 1))
    assert rows(rollups.read_sums(spark, path, days=["d1"])) == [("d1", "00", 13), ("d1", "01", 6)]
    assert rows(rollups.read_sums(spark, path, path, days=["d2"])) == [("d2", None, 0)]
    assert sinks._versions(spark, f"{path}.base") == [1, 3]
