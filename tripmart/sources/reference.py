"""Reference tables: zone lookup, zone rings, grid lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import RING_SCHEMA
from tripmart.sources.listing import exists


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with the id as int; a malformed id becomes NULL and joins nothing."""
    raw = spark.read.option("header", True).csv(path)
    return raw.withColumn("LocationID", F.col("LocationID").try_cast("int"))


def load_zones(spark: SparkSession, csv_path: str, table_path: str) -> DataFrame:
    """Zone lookup as a reference table, written on the first call only.

    A table without its ``_SUCCESS`` comes from a write that broke off and is replaced.
    """
    if not exists(spark, f"{table_path}/_SUCCESS"):
        read_zone_csv(spark, csv_path).write.mode("overwrite").parquet(table_path)
    return spark.read.parquet(table_path)


def read_rings(spark: SparkSession, path: str) -> DataFrame:
    """Zone outlines, one closed ring per row, in lon/lat degrees.

    Several rings of one id (parts, holes) combine by the even-odd rule.
    """
    return spark.read.schema(RING_SCHEMA).parquet(path)


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    """Grid lookup with its contract types, whatever integers the file holds."""
    return spark.read.parquet(path).select(
        F.col("grid_lon_idx").cast("bigint"),
        F.col("grid_lat_idx").cast("bigint"),
        F.col("LocationID").try_cast("int"),
    )
