"""The registered queries of this folder and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import (exact_dedup, fill_middle, jaccard, language, lexical, mixing, pieces, pii, quality, sharding, suffix_tree,
                          token_files, topk)
from tidemart.llm.common import id_remainder, table, written
from tidemart.session import new_workdir


def op1_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = 16
    slotted = written(sharding.with_slots(table(spark, sf_dir, "documents").select("doc_id", "text"), shards).drop("text"), "shard-rows")
    totals = sharding.slot_totals(slotted)
    path = new_workdir(spark, "shard-map")
    owner = sharding.first_map(shards)
    sharding.save_map(spark, path, 1, owner, totals)
    owner = sharding.rebalance(owner, {s: t[0] for s, t in totals.items()}, shards)
    slot_map = sharding.save_map(spark, path, 2, owner, totals)
    return sharding.place(slotted, slot_map).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op2_combination_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_surrogate_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_random_index_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op5_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


def op6_content_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op7_viterbi_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.label(docs, language.fit(docs)).drop("spans")


def op8_gumbel_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (pieces.sample(docs).withColumn("n_pieces", F.size("ids"))
            .withColumn("ids_crc32", F.crc32(F.concat_ws(",", F.col("ids").cast("array<string>")))).drop("ids"))


def op9_water_filling_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_suffix_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    train = docs.where(id_remainder(F.col("doc_id"), suffix_tree.FOLDS) != suffix_tree.HELD_OUT)
    return suffix_tree.score(docs, suffix_tree.fit(train))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_workdir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    rows = token_files.digests(token_files.read_documents(spark, path))
    return token_files.with_start(rows, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op12_range_maximum_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.top_documents(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_rotated_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(back, 256).alias("restored_sha256"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in (
        op1_slot_sharding, op2_combination_jaccard, op3_surrogate_pii, op4_random_index_quality, op5_pivot_topk, op6_content_sort_dedup, op7_viterbi_language, op8_gumbel_pieces, op9_water_filling_mix,
        op10_suffix_tree_score, op11_token_files, op12_range_maximum_search, op13_rotated_middle)}


def llm_oracle_sql() -> dict[str, str]:
    return {"op5_pivot_topk": topk.ORACLE, "op6_content_sort_dedup": exact_dedup.ORACLE,
            "op9_water_filling_mix": mixing.ORACLE, "op12_range_maximum_search": lexical.ORACLE,
            "op13_rotated_middle": fill_middle.ORACLE}
