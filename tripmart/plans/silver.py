"""Bronze to silver: typed weather, and trips with zones, measures and weather."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import GRID_RESOLUTION, PARTITION_KEYS, VEHICLE_TYPES
from tripmart.operators.harmonize import (
    has_coordinates,
    harmonize,
    typed_weather,
    union_eras,
)
from tripmart.operators.ingest import latest_entries
from tripmart.operators.metrics import add_trip_metrics
from tripmart.operators.weather_join import join_weather
from tripmart.operators.zones import resolve_zones, zone_cells
from tripmart.sources.bronze import eras, scan_era
from tripmart.sources.listing import stored_rows
from tripmart.sources.tables import read_table, write_partitioned
from tripmart.sources.weather import scan_bronze_weather

IDENTITY = ("source_file", "source_row")


def silver_weather(bronze: DataFrame) -> DataFrame:
    """Weather with a wall-clock timestamp and its year and month."""
    hour = F.col("datetime_local").cast("timestamp_ntz")
    return bronze.withColumn("datetime_local", hour).withColumns({
        "year": F.year(hour), "month": F.month(hour),
    })


class SilverCounts:
    """What a build of silver trips did, counted while it was written: no scan of its own.

    ``rows_in`` and ``rows_out``, the trip ends resolved by recorded id, by grid cell and not
    at all, and the trips whose hour has weather.
    """

    def __init__(self) -> None:
        self._parts: list[Observation] = []

    def part(self) -> Observation:
        self._parts.append(Observation())
        return self._parts[-1]

    def totals(self) -> dict[str, int]:
        """Sums over all eras; waits for the build, so ask for them after it."""
        found: Counter[str] = Counter()
        for part in self._parts:
            found.update(part.get)
        return dict(found)


def silver_trips(
    sources: Sequence[tuple[str, DataFrame]],
    grid: DataFrame,
    weather: DataFrame,
    keep: Sequence[str] = IDENTITY,
    resolution: float = GRID_RESOLUTION,
    cells_at_most: int | None = None,
    hours_at_most: int | None = None,
    counts: SilverCounts | None = None,
) -> DataFrame:
    """Silver trips from (vehicle type, source frame) pairs, one pair per era.

    Zones are resolved before the union, so only eras that have coordinates pay for
    the two grid lookups.  No step adds or drops a trip.  With bounds on the rows of ``grid``
    and ``weather`` no job runs while the query is built, unless they are too many to broadcast
    unseen: then the distinct cells or hours are counted, so that no trip is shuffled for few.
    """
    gps = [has_coordinates(frame, vehicle_type) for vehicle_type, frame in sources]
    cells = zone_cells(grid, at_most=cells_at_most) if any(gps) else None
    located = [
        resolve_zones(
            harmonize(frame, vehicle_type, keep=keep), cells if has else None, resolution,
            counts and counts.part(),
        )
        for (vehicle_type, frame), has in zip(sources, gps)
    ]
    return join_weather(
        add_trip_metrics(union_eras(located)), weather, at_most=hours_at_most, counts=counts and counts.part()
    )


def bronze_sources(
    spark: SparkSession, root: str, manifest: DataFrame
) -> list[tuple[str, DataFrame]]:
    """One scan per era over the months the manifest holds.

    A vehicle type without a name table is an error: its trips would be missing.
    """
    inventory = latest_entries(manifest).filter(F.col("row_count") > 0)
    strange = inventory.filter(
        F.col("vehicle_type").isNull() | ~F.col("vehicle_type").isin(*VEHICLE_TYPES)
    ).select("vehicle_type").distinct().collect()
    if strange:
        raise ValueError(f"landed vehicle types without source names: {sorted(str(r[0]) for r in strange)}")
    return [(era.vehicle_type, scan_era(spark, root, era)) for era in eras(inventory)]


def bronze_weather(spark: SparkSession, root: str) -> DataFrame:
    """All landed hours with their contract types."""
    return union_eras([typed_weather(frame) for frame in scan_bronze_weather(spark, root)])


def build_silver_weather(spark: SparkSession, bronze_path: str, silver_path: str) -> DataFrame:
    write_partitioned(
        silver_weather(bronze_weather(spark, bronze_path)), silver_path, ("year", "month")
    )
    return read_table(spark, silver_path, refresh=True)


def build_silver_trips(
    spark: SparkSession,
    bronze_path: str,
    manifest: DataFrame,
    grid: DataFrame,
    weather: DataFrame,
    silver_path: str,
    types: Sequence[str] | None = None,
) -> DataFrame:
    """Write silver trips and read them back; raises when there is nothing to read.

    A file holds trips of its own month, but for a few strays, so the task that scans it
    writes them: bronze is read once and not shuffled.

    With ``types`` only those vehicle types are rebuilt and the others stay.  Whole
    types, because a file may hold trips of any month: the folder of each is replaced
    with all its months.
    """
    return build_counted(spark, bronze_path, manifest, grid, weather, silver_path, types)[0]


def build_counted(
    spark: SparkSession,
    bronze_path: str,
    manifest: DataFrame,
    grid: DataFrame,
    weather: DataFrame,
    silver_path: str,
    types: Sequence[str] | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """``build_silver_trips`` and its ``SilverCounts``; raises if a trip was added or lost.

    The counts come from the writes themselves.
    """
    scope = manifest if types is None else manifest.filter(F.col("vehicle_type").isin(*types))
    sources = bronze_sources(spark, bronze_path, scope)
    bounds = {"cells_at_most": stored_rows(grid), "hours_at_most": stored_rows(weather)}
    counts = SilverCounts()
    if types is None:
        trips = silver_trips(sources, grid, weather, **bounds, counts=counts)
        write_partitioned(trips, silver_path, PARTITION_KEYS, in_place=True)
    for kind in types or ():
        trips = silver_trips([s for s in sources if s[0] == kind], grid, weather, **bounds, counts=counts)
        write_partitioned(
            trips, f"{silver_path}/vehicle_type={kind}", PARTITION_KEYS[1:],
            in_place=True, drop=("vehicle_type",),
        )
    totals = counts.totals()
    if totals["rows_in"] != totals["rows_out"]:
        raise RuntimeError(f"trips were added or lost: {totals}")
    return read_table(spark, silver_path, refresh=True), totals
