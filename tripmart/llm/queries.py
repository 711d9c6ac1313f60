"""Registered queries of this package: each takes (spark, data folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (
    adaptive_quality,
    compression_quality,
    curriculum,
    dart_minhash,
    filter_audit,
    hard_negatives,
    pii_semicrf,
    ppm_score,
    ring_sharding,
    suffix_decontam,
    token_rollup,
    toxic_segments,
    url_templates,
)
from tripmart.llm.common import drop, read, remove, settle, shared_folder


def op1_pii_semicrf(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    return pii_semicrf.digest(pii_semicrf.find_spans(documents, pii_semicrf.train(documents)))


def op2_ppm_score(spark: SparkSession, folder: str) -> DataFrame:
    return ppm_score.score(read(spark, folder, "documents"))


def op3_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    return url_templates.judge(read(spark, folder, "pages"))


def op4_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    return dart_minhash.classes(documents).select("doc_id", "class_id", "class_rows")


def op5_adaptive_quality(spark: SparkSession, folder: str) -> DataFrame:
    return adaptive_quality.judge(read(spark, folder, "documents"), [F.col("doc_id")])


def op6_ring_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return ring_sharding.shard(read(spark, folder, "documents"))


def op7_toxic_segments(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    model = toxic_segments.train(documents, read(spark, folder, "labels"))
    return toxic_segments.digest(toxic_segments.find_segments(documents, model))


def op8_suffix_decontam(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    found = suffix_decontam.find_matches(documents, read(spark, folder, "benchmark"))
    return suffix_decontam.digest(found)


def op9_curriculum(spark: SparkSession, folder: str) -> DataFrame:
    ordered = curriculum.sequence(curriculum.mix(read(spark, folder, "documents")))
    return curriculum.digest(curriculum.gathered(ordered))


def op10_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after loading all documents, recounting some, deleting some, and doing it again."""
    store = f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}"
    token_rollup.open_store(spark, store)
    documents = read(spark, folder, "documents")
    counted = settle(documents.select("doc_id", "source", "lang", *[
        token_rollup.token_count(F.col("text"), name).alias(name) for name in token_rollup.TOKENIZERS]), "token-counts")

    def change(op: str, rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.lit(op).alias("op"), "doc_id", "source", "lang", F.lit(name).alias("tokenizer"),
                           F.col(name).alias("tokens"))

    poor = read(spark, folder, "labels").where("quality = 0").select(
        F.lit("delete").alias("op"), "doc_id", *[F.lit(None).cast("string").alias(k) for k in token_rollup.KEYS],
        F.lit(None).cast("long").alias("tokens"))
    batches = {"load": change("insert", counted, "words-1"),
               "recount": change("revise", counted.where("lang <> 'en'"), "words-2"), "withdraw": poor}
    for batch in (*batches, "recount", "load"):  # the last two are repeated and must change nothing
        token_rollup.commit(spark, store, batch, batches[batch])
    totals = settle(token_rollup.totals(spark, store), "rollup-totals")
    remove(spark, [store])
    drop(counted)
    return totals


def op11_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    model = compression_quality.train(documents, read(spark, folder, "labels"))
    return compression_quality.digest(compression_quality.score(documents, model))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    counts = filter_audit.mask_counts(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return filter_audit.audit(counts)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(read(spark, folder, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in (
        op1_pii_semicrf, op2_ppm_score, op3_url_templates, op4_dart_minhash, op5_adaptive_quality,
        op6_ring_sharding, op7_toxic_segments, op8_suffix_decontam, op9_curriculum, op10_token_rollup,
        op11_compression_quality, op12_filter_audit, op13_hard_negatives,
    )}
