"""Silver and gold tables: partitioned writes and read-back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.sources.listing import delete, exists, list_files

#: Size that the files of a partition should have, and how many more of them may lie there.
FILE_BYTES = 128 << 20
SPARE_FILES = 2


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    replace: str = "table",
    in_place: bool = False,
    drop: Sequence[str] = (),
) -> None:
    """Overwrite a partitioned Parquet table.

    ``replace="table"`` drops everything that was there; ``"partitions"`` only the
    partitions that ``df`` holds.  The rows of a partition are brought together first:
    adaptive execution splits a partition that is too large for one task and merges
    small ones.  With ``in_place`` they are written by the task that has them, for rows
    that nearly all lie with their like already: nothing is shuffled, and only partitions
    left with many small files are put together afterwards.  Columns in ``drop`` are not
    stored, because ``path`` says them.
    """
    repair(df.sparkSession, path, keys)
    mode = {"table": "static", "partitions": "dynamic"}[replace]
    _write(df if in_place else df.hint("rebalance", *keys), path, keys, mode, drop)
    if in_place:
        compact(df.sparkSession, path, keys)


def _write(df: DataFrame, path: str, keys: Sequence[str], mode: str, drop: Sequence[str] = ()) -> None:
    (
        df.drop(*drop)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*keys)
        .parquet(path)
    )


def scattered(spark: SparkSession, path: str, spare: int = SPARE_FILES) -> list[str]:
    """Partition folders with more files than their size asks for; only names come back."""
    files = list_files(spark, path).withColumn("folder", F.regexp_replace("path", "/[^/]+$", ""))
    found = files.groupBy("folder").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    crowded = F.col("files") > F.ceil(F.col("bytes") / FILE_BYTES) + spare
    return sorted(r.folder for r in found.filter(crowded).select("folder").collect())


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}__compact"


def repair(spark: SparkSession, path: str, keys: Sequence[str]) -> bool:
    """Finish or drop a compaction that broke off; True if there was one.

    The copy beside the table is whole once Spark has marked it (``_SUCCESS``).  From then on
    it is the record of what is to be done: its partitions are put in their place again,
    whatever part of that had happened.  A copy without the mark has not replaced anything.
    """
    beside = _beside(path)
    if not exists(spark, beside):
        return False
    if exists(spark, f"{beside}/_SUCCESS"):
        _write(spark.read.parquet(beside).hint("rebalance", *keys), path, keys, "dynamic")
        spark.catalog.refreshByPath(path)
    delete(spark, beside)
    return True


def compact(spark: SparkSession, path: str, keys: Sequence[str], spare: int = SPARE_FILES) -> int:
    """Rewrite scattered partitions; returns how many there were.

    They are written beside the table first and then put in their place.  A run that breaks
    off loses nothing: the next write to the table, or ``repair``, finishes its work.
    """
    repair(spark, path, keys)
    folders = scattered(spark, path, spare)
    if folders:
        found = spark.read.option("basePath", path).parquet(*folders)
        _write(found.hint("rebalance", *keys), _beside(path), keys, "static")
        repair(spark, path, keys)
    return len(folders)


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite an unpartitioned Parquet table."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, refresh: bool = False) -> DataFrame:
    """A silver or gold table; ``refresh`` drops what Spark remembers of its files."""
    if refresh:
        spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)
