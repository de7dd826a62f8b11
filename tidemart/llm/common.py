"""Helpers shared by the operators: names, tables in the shared folder, splits, bounded lookups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import new_workdir

# The white space that parts words, in the regular expressions of Spark, DuckDB and Python.
SPACE = r"[\x20\x09-\x0D]+"
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def named(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def others(df: DataFrame, taken: Iterable[str]) -> list[Column]:
    """The columns of `df` whose names do not clash with the given output names."""
    names = {x.lower() for x in taken}
    return [named(c) for c in df.columns if c.lower() not in names]


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of `df` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def text_of(column: Column) -> Column:
    """A text with null as the empty one."""
    return F.coalesce(column.cast("string"), F.lit(""))


def bounded_batches(df: DataFrame) -> DataFrame:
    """Hand tasks' rows to Python by BATCH_BYTES at most, unless the session says how many: 10,000 long texts at a time are
    held by the JVM outside its heap, and once more by the worker."""
    spark = df.sparkSession
    if not spark.sparkContext.getConf().contains(BATCH_CONF):
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    return df


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write `df` to the folder all executors share, and read it from there."""
    spark = df.sparkSession
    path = new_workdir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % k


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    t = text_of(text)
    edges = (F.substring(t, 1, 1).rlike(SPACE).cast("long")
             + F.substring(t, -1, 1).rlike(SPACE).cast("long"))
    return F.when(F.length(t) == 0, F.lit(0).cast("long")).otherwise(F.size(F.split(t, SPACE)).cast("long") - edges)
