"""Exact top-k by inner product through a pivot-distance index.

Inner products become distances: a vector x gets one more component sqrt(M - |x|^2), M the largest
squared norm, a query gets 0, and then |q - x|^2 = |q|^2 + M - 2 q.x. The index keys every vector by
its nearest pivot and its distance to it; a pivot's distances are cut into annuli. A query first
searches the annuli nearest to it, which gives a lower bound on its k-th score. An annulus of pivot p
with distances [a, b] holds no vector nearer than max(a - d(q, p), d(q, p) - b); annuli that cannot
reach the bound are left out, the others are searched. Ties at the bound are searched too.

Queries and vectors meet as packed blocks (annulus by annulus), scored by integer matrix products, and
only each block's k best leave it. No side is broadcast or collected but the pivots and annuli, whose
number is a parameter. A large annulus, or one vector repeated many times, is many blocks; they meet the
queries by annulus and run of CHUNK blocks, so that no annulus is one task's work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import named, written

PIVOTS = 32         # rows with the smallest seeded hashes of their ids
ANNULI = 8          # of each pivot, by quantiles of the distance
BLOCK = 1024        # vectors or queries in a block, about
FIRST = 2           # annuli searched first, nearest lower bound first
CHUNK = 16          # blocks of an annulus that meet its queries under one key
LARGE = 9.2e18      # components and scores beyond 64 bits count as the nearest number inside


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component."""
    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(LARGE)), F.lit(-LARGE))).cast("long")
    return F.transform(vector, whole)


def _matrix(vectors: pd.Series | list, dim: int) -> np.ndarray:
    """Rows padded with zeros to the common width."""
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _distances(m: np.ndarray, lift: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x = np.column_stack([m.astype(np.float64), lift])
    d = (x**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(d, 0))


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          pivots: int = PIVOTS, annuli: int = ANNULI, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each row where `queries` holds.

    Vectors that are null or hold null or non-finite components take no part; shorter ones count as
    padded with zeros. A row is not its own candidate: rows that repeat the query's id are none either.
    Of several rows of one id the best score counts for a candidate, and the smallest vector asks for a query.
    Ties go to the smaller id. Fewer candidates than k give fewer rows; an empty table gives none.
    """
    rows = written(
        vectors.where(usable(named(vec_col)) & named(id_col).isNotNull())
        .select(named(id_col).cast("long").alias("vec_id"), quantised(named(vec_col)).alias("x"), queries.alias("is_query"))
        .withColumn("norm", F.aggregate("x", F.lit(0.0), lambda a, b: a + b.cast("double") * b.cast("double"))), "topk-rows")
    spark = rows.sparkSession
    head = rows.agg(F.max("norm"), F.max(F.size("x"))).first()
    out = "query_id long, rank int, vec_id long, score long"
    if head[0] is None:
        return spark.createDataFrame([], out)
    most, dim = float(head[0]), int(head[1])
    # what rounding can take from a distance and from a score's bound
    near, far = 1e-6 * most**0.5 + 1e-6, 1e-9 * most + 1e-3
    sample = [r[0] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("x").limit(pivots).collect()]
    base = _matrix(sample, dim).astype(np.float64)
    base = np.unique(np.column_stack([base, np.sqrt(np.maximum(most - (base**2).sum(1), 0))]), axis=0)

    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = _distances(_matrix(b["x"], dim), np.sqrt(np.maximum(most - b["norm"].to_numpy(float), 0)), base)
            yield b.assign(pivot=d.argmin(1).astype("int32"), distance=d.min(1))

    index = written(rows.mapInPandas(key, "vec_id long, x array<long>, is_query boolean, norm double, pivot int, distance double"), "topk-index")
    cuts = [i / annuli for i in range(1, annuli)]
    bounds = {r[0]: r[1] for r in index.groupBy("pivot").agg(F.percentile_approx("distance", cuts)).collect()}
    edges = spark.createDataFrame([(p, [float(x) for x in sorted(set(b))]) for p, b in bounds.items()], "pivot int, edges array<double>")
    ringed = (index.join(F.broadcast(edges), "pivot")
              .withColumn("ring", F.col("pivot") * annuli + F.size(F.filter("edges", lambda e: e < F.col("distance")))))
    rings = ringed.groupBy("ring").agg(F.first("pivot").alias("pivot"), F.min("distance").alias("a"), F.max("distance").alias("b"),
                                       F.count(F.lit(1)).alias("n")).collect()
    ring_ids = np.array([r["ring"] for r in rings])
    ring_pivot, low, high = np.array([r["pivot"] for r in rings]), np.array([r["a"] for r in rings]), np.array([r["b"] for r in rings])
    counts = spark.createDataFrame([(r["ring"], max(1, -(-r["n"] // block))) for r in rings], "ring int, blocks int")
    data = (ringed.join(F.broadcast(counts), "ring")
            .groupBy("ring", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("blocks")).alias("block"))
            .agg(F.collect_list(F.struct("vec_id", "x")).alias("rows"))
            .withColumn("chunk", F.floor(F.col("block") / CHUNK).cast("int")))
    data = written(data, "topk-blocks")
    chunks = spark.createDataFrame([(r["ring"], max(0, -(-r["n"] // block) - 1) // CHUNK) for r in rings], "ring int, last int")

    def ring_bounds(b: pd.DataFrame) -> np.ndarray:
        """For each query and annulus, a distance that no vector in it falls below."""
        d = _distances(_matrix(b["x"], dim), np.zeros(len(b)), base)[:, ring_pivot]
        return np.maximum(np.maximum(low[None] - d, d - high[None]), 0)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            least = ring_bounds(b)
            order = np.argsort(least, axis=1, kind="stable")[:, :FIRST]
            yield b[["vec_id", "x"]].assign(ring=list(ring_ids[order])).explode("ring").astype({"ring": "int32"})

    def remaining(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            least = ring_bounds(b)
            order = np.argsort(least, axis=1, kind="stable")
            norm = b["norm"].to_numpy(float)[:, None]
            reach = (norm + most - np.maximum(least - near, 0) ** 2) / 2 + far + 1e-9 * norm
            wanted = reach >= b["bound"].to_numpy(float)[:, None]
            np.put_along_axis(wanted, order[:, :FIRST], False, axis=1)
            yield b[["vec_id", "x"]].assign(ring=[ring_ids[w] for w in wanted]).explode("ring").dropna(subset=["ring"]).astype({"ring": "int32"})

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for found, asked in zip(b["rows"], b["queries"], strict=True):
                ids = np.array([r["vec_id"] for r in found])
                order = np.argsort(ids, kind="stable")
                ids, m = ids[order], _matrix([r["x"] for r in found], dim)[order]
                q_ids, q = np.array([r["vec_id"] for r in asked]), _matrix([r["x"] for r in asked], dim)
                products = _products(q, m)
                new = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
                if len(new) < len(ids):
                    ids, products = ids[new], np.maximum.reduceat(products, new, axis=1)
                own = q_ids[:, None] == ids[None]
                products[own] = np.iinfo(np.int64).min
                best = np.argsort(~products, axis=1, kind="stable")[:, :k]   # ~x falls as x grows, as -x, but cannot overflow
                s = np.take_along_axis(products, best, axis=1)
                real = ~np.take_along_axis(own, best, axis=1)
                yield pd.DataFrame({"query_id": np.repeat(q_ids, best.shape[1])[real.ravel()], "vec_id": ids[best].ravel()[real.ravel()],
                                    "score": s.ravel()[real.ravel()]})

    def search(asked: DataFrame) -> DataFrame:
        packed = (asked.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(parts)))
                  .groupBy("ring", "part").agg(F.collect_list(F.struct("vec_id", "x")).alias("queries"))
                  .join(F.broadcast(chunks), "ring").withColumn("chunk", F.explode(F.sequence(F.lit(0), "last"))))
        scored = packed.join(data, ["ring", "chunk"]).select("rows", "queries").mapInPandas(score, "query_id long, vec_id long, score long")
        return best_of(scored)

    def best_of(scored: DataFrame) -> DataFrame:
        place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        scored = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return scored.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)

    asked = (index.where("is_query").groupBy("vec_id").agg(F.min(F.struct("x", "norm")).alias("least"))
             .select("vec_id", "least.x", "least.norm"))
    parts = max(1, -(-asked.count() // block))
    pair = "vec_id long, x array<long>, ring int"
    first = written(search(asked.select("vec_id", "x", "norm").mapInPandas(nearest, pair)).select("query_id", "vec_id", "score"), "topk-first")
    bound = (first.groupBy("query_id").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n"))
             .select("query_id", F.when(F.col("n") == k, F.col("low")).alias("bound")))
    later = (asked.join(bound, asked["vec_id"] == bound["query_id"], "left")
             .select("vec_id", "x", "norm", F.coalesce(F.col("bound").cast("double"), F.lit(-float("inf"))).alias("bound"))
             .mapInPandas(remaining, pair))
    rest = search(later).select("query_id", "vec_id", "score")
    return best_of(first.unionByName(rest)).select("query_id", "rank", "vec_id", "score")


def _products(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact integer products: through floating point where every sum is below 2^53, in whole numbers of any size
    where one could leave 64 bits."""
    reach = float(np.abs(q.astype(np.float64)).max()) * float(np.abs(m.astype(np.float64)).max()) * q.shape[1] if m.size and q.size else 0.0
    if reach < 2**53:
        return (q.astype(np.float64) @ m.T.astype(np.float64)).astype(np.int64)
    if reach < 2**62:
        return q @ m.T
    most = int(LARGE)
    return np.clip(q.astype(object) @ m.T.astype(object), -most, most).astype(np.int64)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
