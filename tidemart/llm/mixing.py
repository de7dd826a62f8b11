"""Mix sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

Every source gets budget x weight / weights of all. A source above its cap (most passes over it) is
clamped and the excess goes to the rest by weight, until none is above its cap: a few sums over the
table of sources. A source whose target is r times its size is repeated floor(r) times as a whole; the
fraction goes to the rows with the smallest seeded hashes, up to the row at whose middle the fraction
is reached. The hash that ends it is found from sums per 1/4096 of the hash range and then inside one
of these parts, so that no source is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import free_names, n_words, named, others, text_of, written

SHARE = 1.5         # of all words
MOST = 2            # passes over a source
WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SEED = "mix-1"
HASH_BITS = 60
PART_BITS = 12

RESULTS = ["size", "source_size", "target", "taken", "copies"]


def row_hash(doc_id: Column, text: Column, seed: str) -> Column:
    """60 bits that depend on seed, id and text only."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), doc_id.cast("string"), F.md5(text_of(text).cast("binary"))).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def weights_in_order(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, weight): the sources by code point, null last, get the weights in turn.

    The place of a source is its place in its range plus the sizes of the ranges before it.
    """
    ranged = written(totals.select("source").repartitionByRange(F.col("source").asc_nulls_last())
                     .withColumn("range", F.spark_partition_id()), "source-order")
    before = (ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.sum("n").over(Window.orderBy("range")) - F.col("n")).drop("n"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())) - 1 + F.col("before")
    turn = F.array(*[F.lit(w) for w in weights])
    return ranged.join(before, "range").select("source", turn[F.pmod(place, F.lit(len(weights))).cast("int")].alias("weight"))


def plan_mix(sized: DataFrame, weights: DataFrame | None = None, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target, whole, cut): which rows of a source are taken how often.

    `sized` has source, size and hash. Weights default to WEIGHTS in order of the sources.
    """
    parts = written(sized.groupBy("source", F.shiftright("hash", HASH_BITS - PART_BITS).alias("part"))
                    .agg(F.sum("size").alias("size")), "mix-parts")
    totals = parts.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = written(totals, "mix-totals")
    weights = weights_in_order(totals) if weights is None else weights
    w = weights.select(F.col("source").alias("_source"), F.col("weight").cast("double").alias("weight"))
    stats = written(totals.join(w, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
                    .withColumn("cap", (F.col("source_size") * most).cast("double")), "mix-stats")
    level = _level(stats, share)
    target = F.least(F.col("cap"), F.lit(level) * F.col("weight"))
    goal = (stats.withColumn("target", target)
            .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
            .withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
            .drop("weight", "cap"))
    goal = written(goal, "mix-goal")
    return _with_cut(goal, parts, sized)


def _level(stats: DataFrame, share: float) -> float:
    """The target per unit of weight at which the budget is met, given the caps."""
    row = stats.agg(F.sum("source_size"), F.sum("weight")).first()
    if not row[0] or not row[1]:
        return 0.0
    budget, level, clamped = share * row[0], 0.0, 0.0
    free = row[1]
    while True:
        level = (budget - clamped) / free
        over = F.col("weight") * F.lit(level) > F.col("cap")
        now, rest = stats.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)),
                              F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        if rest == 0.0:
            return float("inf") if now < budget else level
        if now == clamped:
            return level
        clamped, free = now, rest


def _with_cut(goal: DataFrame, parts: DataFrame, sized: DataFrame) -> DataFrame:
    """Add `cut`: rows of the source whose hash is at most this one are taken once more."""
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    running = F.sum("size").over(Window.partitionBy("source").orderBy("part"))
    reached = parts.withColumn("upto", running).withColumn("before", running - F.col("size"))
    edge = written(
        reached.alias("p").join(goal.alias("g"), same("p", "g"))
        .where("extra > 0 AND before < extra AND extra <= upto")
        .select("g.source", "part", (F.col("extra") - F.col("before")).alias("left")), "mix-edge")
    inside = (sized.withColumn("part", F.shiftright("hash", HASH_BITS - PART_BITS)).alias("s")
              .join(edge.alias("e"), same("s", "e") & (F.col("s.part") == F.col("e.part")))
              .groupBy(F.col("e.source").alias("source"), "e.part", "e.left", "hash").agg(F.sum("size").alias("size")))
    middle = F.sum("size").over(Window.partitionBy("source").orderBy("hash")) - F.col("size") / 2
    last = (inside.withColumn("middle", middle).where(F.col("middle") <= F.col("left"))
            .groupBy("source").agg(F.max("hash").alias("last")))
    start = F.shiftleft(F.col("part"), HASH_BITS - PART_BITS) - 1
    cuts = (edge.alias("e").join(last.alias("l"), same("e", "l"), "left")
            .select("e.source", F.coalesce("last", start).alias("cut")))
    return written(goal.alias("g").join(cuts.alias("c"), same("g", "c"), "left")
                   .select("g.*", F.coalesce("cut", F.lit(-1).cast("long")).alias("cut")), "mix-plan")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: DataFrame | None = None, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """All rows and columns of `df`, with size, source_size, target, taken and copies added.

    Size is the number of words; null text has none. Null is a source of its own, last in order.
    Equal rows share their fate. A source without words has target 0. An empty table gives an
    empty one. Columns of `df` named like a result are replaced.
    """
    hashed = row_hash(named(id_col), named(text_col), seed)
    narrow = written(df.select(named(source_col).alias("source"), n_words(named(text_col)).alias("size"),
                               hashed.alias("hash")), "mix-sizes")
    hash_, source, whole, cut = free_names(df, "_hash", "_source", "_whole", "_cut")
    plan = plan_mix(narrow, weights, share, most).select(F.col("source").alias(source), "source_size", "target",
                                                         F.col("whole").alias(whole), F.col("cut").alias(cut))
    rows = df.select(*others(df, set(RESULTS) - {id_col, text_col, source_col}), hashed.alias(hash_),
                     n_words(named(text_col)).alias("size"))
    return (rows.join(plan, named(source_col).eqNullSafe(F.col(source)))
            .withColumn("copies", F.col(whole) + (F.col(hash_) <= F.col(cut)).cast("long"))
            .withColumn("taken", F.col("size") * F.col("copies"))
            .drop(hash_, source, whole, cut))


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself, with the columns of `df`: a row taken twice stands there twice, one not taken not at all."""
    packed = df.select(F.struct(*[named(c) for c in df.columns]).alias("_row"), named(id_col).alias("_id"),
                       named(text_col).alias("_text"), named(source_col).alias("_from"))
    return (mix(packed, "_id", "_text", "_from").where("copies > 0")
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
            .select("_row.*"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5('mix-1|' || doc_id || '|' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS hash
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
stats AS (
  SELECT source, source_size, CAST(source_size * 2 AS DOUBLE) AS cap,
         CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight
  FROM totals),
steps AS (
  SELECT cap, weight, cap / weight AS ratio,
         (SELECT CAST(sum(source_size) AS DOUBLE) FROM totals) * 1.5
           - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS budget,
         sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM stats),
level AS (SELECT min_by(budget / free, ratio) AS level FROM steps WHERE budget / free * weight <= cap),
goal AS (
  SELECT source, source_size, least(cap, level * weight) AS target FROM stats, level),
goals AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM goal),
runs AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size AS extra,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash) - s.size / 2 AS middle
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN extra > 0 AND middle <= extra THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM runs
"""
