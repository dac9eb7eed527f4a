"""One query per operator, applied to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, decontamination, exact_dedup, fill_middle, langid, near_dedup, packing, passages, secret_scan, suffix_dedup, topk, toxicity
from .common import id_bucket, table

RANKS = "byte_bpe_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bucket = table(spark, sf_dir, "documents"), id_bucket("doc_id", 3)
    model = langid.fit(docs, train=bucket != 1)
    return langid.identify(docs, model).select(
        "doc_id", (bucket == 1).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bucket = table(spark, sf_dir, "documents"), id_bucket("doc_id", 5)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), train=bucket != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (bucket == 0).alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.shared_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", F.size("passages").cast("long").alias("n_passages"), "passages")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"), words=3, numerator=85)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored("form", "output"), 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_top_k, op3_packing, op4_language, op5_toxicity, op6_passages, op7_secrets, op8_bpe, op9_near_dedup, op10_suffix_dedup,
    op11_centroids, op12_decontamination, op13_fill_middle)}
