"""Hourly weather: landed JSON, bronze Parquet, silver Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import WEATHER_JSON_SCHEMA, WEATHER_VARIABLES
from tripmart.sources.listing import list_partition_files, plain_path, with_footers


def read_weather_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed answers of the weather service: one JSON object per file, named by ``source``."""
    return (
        spark.read.schema(WEATHER_JSON_SCHEMA)
        .option("multiLine", True)
        .json(path)
        .withColumns({"source": F.col("_metadata.file_name"),
                      "path": plain_path("_metadata.file_path", encoded=True)})
    )


def parse_weather_text(df: DataFrame, column: str) -> DataFrame:
    """The same objects held as text in a column."""
    return df.withColumn("hourly", F.from_json(column, WEATHER_JSON_SCHEMA)["hourly"])


def hourly_rows(payloads: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Object of parallel arrays to one row per hour.

    Arrays are zipped by position; a shorter array gives NULL at its missing end, an
    array that is missing or null gives NULL throughout, and so does an unreadable time.
    ``keep`` names columns of the payload row to carry along.
    """
    def values(name: str, kind: str) -> Column:
        return F.coalesce(F.col(f"hourly.{name}"), F.array().cast(f"array<{kind}>")).alias(name)

    zipped = F.arrays_zip(
        values("time", "string"), *[values(name, kind) for name, kind in WEATHER_VARIABLES.items()]
    )
    hours = payloads.select(*keep, F.explode(zipped).alias("h"))
    return hours.select(
        *keep,
        F.col("h.time").try_cast("timestamp_ntz").alias("datetime_local"),
        *[F.col(f"h.{name}").alias(name) for name in WEATHER_VARIABLES],
    )


def scan_bronze_weather(spark: SparkSession, root: str) -> list[DataFrame]:
    """Landed months, one frame per set of equal columns.

    A month whose codes have gaps may hold them as doubles where others hold
    integers; reading both with one schema would fail.
    """
    files = with_footers(list_partition_files(spark, root, ("year", "month")))
    files = files.filter(F.col("columns").isNotNull())
    groups = files.groupBy("columns").agg(F.sort_array(F.collect_set("path")).alias("paths"))
    # Only file names reach the driver, a few per month, to name each scan.
    return [spark.read.parquet(*group.paths) for group in groups.collect()]
