"""The corpus pipeline: documents through quality, near duplicates, decontamination and secrets to packed windows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import decontaminate, near_dup, packing, quality, secret_scan
from clinlake.llm.common import stage, table

#: Ids are broadcast only when they are counted below this (32 MB).
BROADCAST_IDS = 4_000_000


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is not among ids; a null id never is."""
    gone = stage(ids.where("doc_id is not null").select(ids["doc_id"].alias("__llm_id")).distinct(), "gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"] == gone["__llm_id"], "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality that are not toxic."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, the one with the smallest id.

    Documents without an id stay; of repeated rows (id and text) one stays.
    """
    found = stage(near_dup.near_duplicates(docs), "classes")
    gone = found.where("not kept").select(F.col("doc_id").alias("__llm_id"), F.col("text_md5").alias("__llm_text")).distinct()
    gone = stage(gone, "gone")
    if gone.count() <= BROADCAST_IDS // 4:
        gone = F.broadcast(gone)
    kept = docs.join(gone, (docs["doc_id"] == gone["__llm_id"]) & (F.md5(docs["text"]) == gone["__llm_text"]), "left_anti")
    if found.where("kept and doc_id is not null").groupBy("doc_id", "text_md5").count().where("count > 1").limit(1).count():
        kept = kept.where("doc_id is null").unionByName(kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"]))
    return kept


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontaminate.passages(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by marks."""
    return secret_scan.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in windows of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: Trained models, sketches and tokens are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
