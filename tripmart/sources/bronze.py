"""Scans of bronze trips, one per schema era instead of one per file."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.contracts import ORIGIN_FILE, ORIGIN_ROW, PARTITION_KEYS, RESERVED_COLUMNS


@dataclass(frozen=True)
class Era:
    """All bronze months of one vehicle type whose files have the same columns."""

    vehicle_type: str
    columns: tuple[str, ...]
    locations: tuple[str, ...]


def eras(inventory: DataFrame) -> list[Era]:
    """Group an inventory (vehicle_type, columns, location) into eras.

    Only folder names reach the driver: one per vehicle type and month, as needed
    to name the scan.
    """
    grouped = (
        inventory.groupBy("vehicle_type", "columns")
        .agg(F.sort_array(F.collect_set("location")).alias("locations"))
        .orderBy("vehicle_type", F.col("locations")[0])
    )
    return [
        Era(row.vehicle_type, tuple(row.columns), tuple(row.locations))
        for row in grouped.collect()
    ]


def scan_era(spark: SparkSession, root: str, era: Era) -> DataFrame:
    """Source columns of one era plus (source_file, source_row), the row's identity.

    Spark takes the schema from one footer, which is right because every file of
    the era has the same one; nothing is merged.  The identity is that of the file the
    row was landed from, so it outlives another landing; bronze that something else laid
    out has none and is known by its own files.
    """
    base = root.rstrip("/")
    folders = [f"{base}/{location}" for location in era.locations]
    schema = spark.read.option("basePath", base).parquet(folders[0]).schema
    for name, kind in zip(RESERVED_COLUMNS, (T.StringType(), T.LongType())):
        if name not in schema.names:
            schema = schema.add(name, kind)
    raw = spark.read.schema(schema).option("basePath", base).parquet(*folders)
    source_file = F.concat_ws(
        "/",
        *[F.col(key).cast("string") for key in PARTITION_KEYS],
        F.coalesce(ORIGIN_FILE, "_metadata.file_name"),
    )
    return raw.withColumns({
        "source_file": source_file,
        "source_row": F.coalesce(ORIGIN_ROW, "_metadata.row_index"),
    }).drop(*PARTITION_KEYS, *RESERVED_COLUMNS)
