"""Fixed virtual slots: records hash into slots, and a versioned map sends slots to shards.

A record's slot never changes; only the map does. Bytes are summed per slot (combined before the
exchange), and rebalancing edits the map: whole slots leave shards above the mean for those below.
Driver work is bounded by the number of slots. Equal texts share a slot, except texts whose copies
together have more than an eighth of a shard, fewer than 8 x shards in number: these are spread by id.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import free_names, named, others, text_of, written

SLOTS = 4096
SPREAD = 8          # a text with more than 1/SPREAD of a shard's bytes or rows is spread

RESULTS = ["size", "text_crc32", "virtual_slot", "shard", "slot"]
MAP_SCHEMA = "version int, virtual_slot int, shard int, bytes long, n_rows long"


def with_slots(df: DataFrame, shards: int, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add size (UTF-8 bytes + 1), text_crc32 (of the empty text for null) and virtual_slot.

    The columns of `df` stay; those named like a result are replaced. Empty tables stay empty.
    """
    text = text_of(named(text_col))
    size = (F.octet_length(text) + 1).cast("long")
    same = F.xxhash64(text)
    hash_, heavy_ = free_names(df, "_text_hash", "_heavy")
    copies = (df.select(same.alias(hash_), size.alias("size")).groupBy(hash_).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")))
    copies = written(copies, "shard-texts")
    total, rows = (x or 0 for x in copies.agg(F.sum("bytes"), F.sum("n")).first())
    parts = shards * SPREAD
    heavy = copies.where((F.col("bytes") > total / parts) | (F.col("n") > max(rows / parts, 1))).select(hash_, F.lit(True).alias(heavy_))
    spread = F.when(F.col(heavy_), F.xxhash64(hash_, named(id_col))).otherwise(F.xxhash64(hash_))
    return (df.select(*others(df, RESULTS), same.alias(hash_), size.alias("size"), F.crc32(text).alias("text_crc32"))
            .join(F.broadcast(heavy), hash_, "left")
            .withColumn("virtual_slot", F.pmod(spread, F.lit(slots)).cast("int"))
            .drop(hash_, heavy_))


def slot_totals(slotted: DataFrame, slots: int = SLOTS) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each virtual slot; at most `slots` entries come to the driver."""
    sums = slotted.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1))).collect()
    found = {r[0]: (r[1], r[2]) for r in sums}
    return {s: found.get(s, (0, 0)) for s in range(slots)}


def first_map(shards: int, slots: int = SLOTS) -> dict[int, int]:
    """The map before any record is known: slots in turn."""
    return {s: s % shards for s in range(slots)}


def rebalance(owner: dict[int, int], size: dict[int, int], shards: int) -> dict[int, int]:
    """An edited map whose shards have near equal sizes.

    Slots leave shards above the mean, largest first while they fit the excess, and go to the least
    loaded shard; then single slots move or change places between the fullest and the emptiest shard
    while that narrows the gap. Slots of shards that no longer exist move too.
    """
    new = dict(owner)
    held: list[list[int]] = [[] for _ in range(shards)]
    loose = []
    for s, k in sorted(new.items()):
        (held[k] if k < shards else loose).append(s)
    load = [sum(size[s] for s in h) for h in held]
    mean = (sum(load) + sum(size[s] for s in loose)) / shards
    for k in range(shards):
        for s in sorted(held[k], key=lambda x: (-size[x], x)):
            if size[s] and load[k] - size[s] >= mean:
                held[k].remove(s)
                load[k] -= size[s]
                loose.append(s)
    heap = [(load[k], k) for k in range(shards)]
    heapq.heapify(heap)
    for s in sorted(loose, key=lambda x: (-size[x], x)):
        _, k = heapq.heappop(heap)
        held[k].append(s)
        load[k] += size[s]
        heapq.heappush(heap, (load[k], k))
    for _ in range(4 * shards):
        top, low = max(range(shards), key=lambda k: (load[k], k)), min(range(shards), key=lambda k: (load[k], k))
        gap = load[top] - load[low]
        best = _best_change(held[top], held[low], size, gap)
        if best is None:
            break
        out, back = best
        held[top].remove(out)
        held[low].append(out)
        if back is not None:
            held[low].remove(back)
            held[top].append(back)
        moved = size[out] - (size[back] if back is not None else 0)
        load[top] -= moved
        load[low] += moved
    for k in range(shards):
        new.update((s, k) for s in held[k])
    return new


def _best_change(full: list[int], empty: list[int], size: dict[int, int], gap: int) -> tuple[int, int | None] | None:
    """The slot to move, or the two to exchange, that bring two shards closest; none if nothing helps."""
    best, found = gap, None
    rest = sorted((size[s], s) for s in empty) + [(0, None)]
    rest.sort(key=lambda x: x[0])
    j = 0
    for out, s in sorted((size[s], s) for s in full):
        while j + 1 < len(rest) and abs(gap - 2 * (out - rest[j + 1][0])) <= abs(gap - 2 * (out - rest[j][0])):
            j += 1
        if out > rest[j][0] and (left := abs(gap - 2 * (out - rest[j][0]))) < best:
            best, found = left, (s, rest[j][1])
    return found


def save_map(spark: SparkSession, path: str, version: int, owner: dict[int, int], totals: dict[int, tuple[int, int]]) -> DataFrame:
    """Add a version of the map to the table at `path`; older versions stay readable."""
    rows = [(version, s, k, *totals[s]) for s, k in sorted(owner.items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return load_map(spark, path, version)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the map, by default the newest."""
    saved = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = saved.agg(F.max("version")).first()[0]
    return saved.where(F.col("version") == version)


def place(slotted: DataFrame, slot_map: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add shard, and slot: the row's place in its shard, 0 to its row count - 1.

    Rows are numbered inside their virtual slot by (id, text_crc32), and a slot starts where the slots
    before it in the shard end. The map has a fixed number of rows and is broadcast.
    """
    before = F.sum("n_rows").over(Window.partitionBy("shard").orderBy("virtual_slot")) - F.col("n_rows")
    before_, inside_ = free_names(slotted, "_before", "_inside")
    starts = slot_map.select("virtual_slot", "shard", before.alias(before_))
    inside = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(named(id_col).asc_nulls_last(), "text_crc32"))
    return (slotted.withColumn(inside_, inside).join(F.broadcast(starts), "virtual_slot")
            .withColumn("slot", (F.col(before_) + F.col(inside_) - 1).cast("long"))
            .drop(before_, inside_))


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard; a shard's rows may come from many tasks."""
    placed.write.partitionBy("shard").parquet(path)
