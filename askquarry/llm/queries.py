"""The registered queries of the operators, each over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askquarry.llm import alignment, exact_dup, licenses, mixing, near_dup, packing, quality, secrets, sharding, spelling, substrings, toxicity, vector_dup

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), near_dup.WORDS_3).drop("k1", "k2")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    digest = F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, secrets.written(F.col("spans")).alias("spans"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dup.exact_duplicates(table(spark, sf_dir, "documents")).drop("row")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dup.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxic_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("passages").cast("long").alias("n_passages"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_best_fit_packing,
    op2_substring_dedup,
    op3_license_scan,
    op4_quality_classifier,
    op5_minhash_near_dedup,
    op6_secret_scan,
    op7_exact_dedup,
    op8_embedding_near_dedup,
    op9_mixing,
    op10_sharding,
    op11_spelling_variants,
    op12_toxicity,
    op13_token_alignment,
)}
