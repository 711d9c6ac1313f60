"""From raw documents to shards: five stages, each a Parquet table that the next one reads.

Every stage but the last returns the columns of its documents, whatever their names.  NULLs in
any column, empty and very long texts, repeated rows and ties are handled as the operators say
in their docstrings: a NULL text is an empty one (and fails the quality rules), a NULL id or
source is a value like any other, repeated rows are near duplicates.  An empty table gives
empty tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm.adaptive_quality import keep_good
from tripmart.llm.common import SETTLED, read, remove, shared_folder
from tripmart.llm.curriculum import training_rows
from tripmart.llm.dart_minhash import deduplicate
from tripmart.llm.ring_sharding import shard
from tripmart.llm.suffix_decontam import decontaminate

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Intermediate tables of the stage that ran last, by application.
_LEFT: dict[str, list[str]] = {}


def staged(stage: Stage) -> Stage:
    """A stage that first deletes the intermediate tables of the one before.

    They stay if ``docs`` still read them, as when stages are chained without being written.
    """
    @wraps(stage)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        names = [path.rsplit("/", 1)[1] for path in _LEFT.get(application, [])]
        used = {part for file in docs.inputFiles() for part in file.split("/")}
        if used.isdisjoint(names):
            remove(spark, _LEFT.pop(application, []))
        before = len(SETTLED)
        out = stage(spark, docs, sf_dir)
        _LEFT[application] = _LEFT.get(application, []) + SETTLED[before:]
        return out

    return begin


@staged
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and their group's thresholds."""
    return keep_good(docs)


@staged
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates."""
    return deduplicate(docs)


@staged
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of a benchmark item occurs."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


@staged
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them, some twice and some not at all, in training order."""
    return training_rows(docs)


@staged
def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document of the mix."""
    return shard(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", sharding),
]

# SQL cannot express the stages by signatures and by the ring: see the brute-force test.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
