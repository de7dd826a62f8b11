"""Exact copies by sorting contents: ranges of normalised bytes, equals adjacent, the smallest id stays.

Rows are dealt by range over (first bytes, digest, salt) of their normalised text, whose splitters
Spark samples; a key has a fixed small width however long the text is. Inside a range Spark's
external sort puts equal texts next to each other, and the window compares whole neighbouring texts.
No further exchange is needed, as the range holds every row of a (digest, salt).

A digest with more than 1/4096 of the rows is hot: its rows get a salt and so lie in several ranges.
There are fewer than 4096 such digests and 8192 salts in all, so they are broadcast. Their count and
smallest id come from the counting pass, which is combined before its exchange; across the salts of
one digest equality is that of SHA-256 digests, inside a salt it is compared in full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import SPACE, free_names, named, others, text_of

PARTS = 4096        # a text with more than 1/PARTS of all rows is split
LEAST_HOT = 100     # and has at least so many rows
PREFIX_BYTES = 16

RESULTS = ["keep_id", "group_size", "kept", "text_sha256"]


def mark_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of `df`, with keep_id, group_size, kept and text_sha256 added.

    Null text is the empty text. Null ids come last; keep_id is null only if a group has no other
    id. Of rows that repeat one id, exactly one is kept. An empty table gives an empty one. Columns
    of `df` named like a result are replaced.
    """
    norm = F.regexp_replace(text_of(named(text_col)), SPACE, " ")
    digest = F.unhex(F.sha2(norm, 256))
    sha, prefix, salt, salts, full, place, first, count, hot_size, hot_id = free_names(
        df, "_sha", "_prefix", "_salt", "_salts", "_norm", "_place", "_first", "_count", "_hot_size", "_hot_id")
    limit = max(df.count() / PARTS, LEAST_HOT)
    hot = (df.select(digest.alias(sha), named(id_col).alias("id"))
           .groupBy(sha).agg(F.count(F.lit(1)).alias(hot_size), F.min("id").alias(hot_id))
           .where(F.col(hot_size) > limit)
           .withColumn(salts, F.ceil(F.col(hot_size) / limit)))
    dealt = (df.select(*others(df, RESULTS), digest.alias(sha),
                       F.substring(norm.cast("binary"), 1, PREFIX_BYTES).alias(prefix))
             .join(F.broadcast(hot), sha, "left")
             .withColumn(salt, F.coalesce(F.pmod(F.xxhash64(named(id_col)), F.col(salts)), F.lit(0)))
             .repartitionByRange(prefix, sha, salt)
             .withColumn(full, norm))
    equal = Window.partitionBy(prefix, sha, salt, full).orderBy(named(id_col).asc_nulls_last())
    whole = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = (dealt.withColumn(place, F.row_number().over(equal))
            .withColumn(first, F.first(named(id_col)).over(whole))
            .withColumn(count, F.count(F.lit(1)).over(whole)))
    is_hot = F.col(hot_size).isNotNull()
    keep = F.when(is_hot, F.col(hot_id)).otherwise(F.col(first))
    return seen.select(
        *others(df, RESULTS), keep.alias("keep_id"),
        F.when(is_hot, F.col(hot_size)).otherwise(F.col(count)).alias("group_size"),
        ((F.col(place) == 1) & keep.eqNullSafe(named(id_col))).alias("kept"),
        F.lower(F.hex(sha)).alias("text_sha256"))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of `df`."""
    marked = mark_copies(df.select(F.struct(*[named(c) for c in df.columns]).alias("_row"),
                                   named(id_col).alias("_key"), named(text_col).alias("_text")), "_key", "_text")
    return marked.where("kept").select("_row.*")


ORACLE = r"""
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size, sha256(norm) AS text_sha256
      FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
            FROM documents))
"""
