"""Starting and ending streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

INTERVAL = "5 seconds"


CHANGELOGS = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def start(writer: DataStreamWriter, checkpoint: str, once: bool = False, changelogs: bool = True) -> StreamingQuery:
    """Start with micro-batches every five seconds, or over what is there now only.

    The checkpoint holds the offsets of each batch before it runs and a mark after
    its output, so a restart goes on where the last finished batch ended.

    Without `changelogs`, a batch puts by the files its stores have added, not the changes. That suits state that comes and
    goes whole with every batch, as that of joins: a restart would play all changes of the rounds before back into the
    stores, and until they are put by, the stores hold them in memory and writers wait for room.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=INTERVAL)
    if changelogs:
        return writer.start()
    conf = writer._spark.conf
    before = conf.get(CHANGELOGS)
    conf.set(CHANGELOGS, "false")
    try:
        return writer.start()       # a query keeps the settings it was started with
    finally:
        conf.set(CHANGELOGS, before)


def run_once(writer: DataStreamWriter, checkpoint: str, changelogs: bool = True) -> StreamingQuery:
    """Process everything that is there now and stop; fails if the query fails."""
    query = start(writer, checkpoint, once=True, changelogs=changelogs)
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows the batches of a run dropped because they came after the watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def each_batch(stream: DataFrame, sink: Callable[[DataFrame, int], None],
               mode: str = "append", keep: bool = True) -> DataStreamWriter:
    """A sink function per micro-batch; empty batches are skipped. The batch is
    kept while the sink runs, as sinks read it more than once. `keep=False` is for
    streams without state whose sinks read a topic's files once, or keep what they make of them."""
    def guarded(df: DataFrame, batch_id: int) -> None:
        if keep:
            df.persist()
        try:
            if not df.isEmpty():
                sink(df, batch_id)
        finally:
            if keep:
                df.unpersist()
    return stream.writeStream.outputMode(mode).foreachBatch(guarded)
