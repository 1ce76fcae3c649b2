"""The queries of the package: each operator over its whole table, with the parameters of its production use."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from clinlake.llm import (
    ann, chat, collocations, decontaminate, ga_packing, near_dup, packing, quality, secret_scan, sharding, site_text, url_filter, whitening,
)
from clinlake.llm.common import table


def op1_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 100 = 0"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_site_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_text.main_text(table(spark, sf_dir, "pages")).drop("host")


def op4_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).drop("text_md5")


def op5_typed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = f"{chat.END}{chat.START}assistant ok"
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return chat.digests(chat.format_conversations(rows.unionByName(control)))


def op6_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", F.round("p_bad_quality", 6).alias("p_bad_quality"), F.round("p_toxic", 6).alias("p_toxic"), "kept")


def op7_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


def op8_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_extendible_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.with_directory(table(spark, sf_dir, "documents"), sharding.QUERY_BYTE_LIMIT)


def op10_filter_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.listed_by_words(url_filter.domains(pages)))


def op11_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(table(spark, sf_dir, "documents"))


def op13_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ga_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_adaptive_scan, op2_decontamination, op3_site_text, op4_lsh_forest, op5_typed_parts,
        op6_weak_labels, op7_ownership, op8_bin_slack, op9_extendible_hashing, op10_filter_cascade,
        op11_qdwh_whitening, op12_phrase_collocations, op13_genetic_packing,
    ]
    return {f.__name__: f for f in named} | {"pipeline": corpus_pipeline.run}
