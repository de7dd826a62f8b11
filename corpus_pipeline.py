"""The corpus pipeline: reject bad documents, drop copies, mix the sources and encode what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import exact_dedup, jaccard, mixing, pieces, quality
from tidemart.llm.common import bounded_batches, table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones of them, does not reject."""
    docs = bounded_batches(docs)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal normalised texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return jaccard.keep_first(bounded_batches(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights; a document taken twice stands there twice."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of each document; those of a repeated document repeat."""
    return pieces.sample(docs)


STAGES = [("quality", keep_good), ("exact_copies", drop_copies), ("near_copies", drop_near_copies),
          ("mixing", mix_sources), ("pieces", encode)]

# A trained network, seeded 64-bit hashes and sampled segmentations have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
