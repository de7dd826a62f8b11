"""Connected components of a graph of any size, by alternating large and small stars.

A large star hangs each node's greater neighbours onto its least neighbour, a small star does so with
the node and its smaller neighbours. Both keep the components, and the edges end as stars around each
component's least node. A round is two sums of minima, combined before their exchange, and two joins;
its result is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in `edges` (a, b): the smallest id it is connected with."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    ids = now
    state = None
    while (new := now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()) != state:
        state = new
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(lower.select("a", F.col("m").alias("b"))).distinct())
        now = written(small, "edges")
    roots = ids.select(F.col("b").alias("id")).union(ids.select("a")).distinct()
    return (roots.join(now.withColumnRenamed("a", "id"), "id", "left")
            .select("id", F.coalesce("b", "id").alias("component")))
