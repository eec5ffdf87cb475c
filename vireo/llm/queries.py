"""The queries that apply each operator to its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.llm import conversations, decontaminate, minhash, mixing, multi_index, packing, pii, quality, runs, sharding, store, tagpaths, topk
from vireo.llm.common import settle, table
from vireo.llm.sql import SQL


def op1_norm_sorted_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = settle(topk.integer_vectors(table(spark, sf_dir, "embeddings")), "integer-vectors")
    return topk.top_inner_products(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op2_content_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.starts_and_checksums(store.write_store(table(spark, sf_dir, "documents")))


def op3_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagpaths.main_texts(table(spark, sf_dir, "pages"))


def op4_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark, table(spark, sf_dir, "documents"))


def op5_multinomial_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, sf_dir, "documents"))


def op6_multi_index_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_superminhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_signature_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    audited, rows = conversations.repaired(conversations.damaged(table(spark, sf_dir, "conversations")))
    empty = F.sha2(F.lit("").cast("binary"), 256)
    named = audited.join(conversations.digests(rows).withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id")), "left")
    return named.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def op12_name_doubling_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, sf_dir, "documents"), runs.planted_words)
    hashed = lambda c: F.sha2(c.cast("binary"), 256)
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), runs.strongest("runs").alias("best"), hashed(runs.listed("runs")).alias("runs_sha256"), hashed(F.col("collapsed")).alias("collapsed_sha256"))
    milli = F.expr("(1000 * best.length) div best.period")
    return found.select("doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"), milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op13_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.exact_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_norm_sorted_topk, op2_content_store, op3_tag_path_text, op4_hash_tree_shards, op5_multinomial_mix, op6_multi_index_neardup,
        op7_compression_quality, op8_superminhash_neardup, op9_personal_data, op10_harmonic_packing, op11_signature_repair, op12_name_doubling_runs, op13_positional_index)}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
