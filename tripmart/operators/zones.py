"""Zone of each trip end: the recorded id, else the grid cell of its coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripmart.contracts import GRID_RESOLUTION, GRID_ROW_BOUND, LOCATION_COLUMNS
from tripmart.functions import cell_index
from tripmart.operators.joins import broadcast_within


def one_zone_per_cell(grid: DataFrame) -> DataFrame:
    """The lowest zone id of each cell, so that a join can never multiply trips."""
    return grid.groupBy("grid_lon_idx", "grid_lat_idx").agg(
        F.min("LocationID").alias("LocationID")
    )


def locate(
    df: DataFrame,
    cells: DataFrame,
    longitude: str,
    latitude: str,
    into: str,
    resolution: float = GRID_RESOLUTION,
) -> DataFrame:
    """Left-join the zone of one coordinate pair as column ``into``."""
    side = cells.select(
        F.col("grid_lon_idx").alias("__lon"),
        F.col("grid_lat_idx").alias("__lat"),
        F.col("LocationID").alias(into),
    )
    here = (cell_index(F.col(longitude), resolution) == F.col("__lon")) & (
        cell_index(F.col(latitude), resolution) == F.col("__lat")
    )
    return df.join(side, here, "left").drop("__lon", "__lat")


def zone_cells(
    grid: DataFrame, row_bound: int | None = GRID_ROW_BOUND, at_most: int | None = None
) -> DataFrame:
    """The grid made ready for joining: unique cells, broadcast when within bound.

    The cells are counted if the rows of the grid are unknown or beyond the bound.
    """
    return broadcast_within(one_zone_per_cell(grid), row_bound, at_most, recount=True)


def resolve_zones(
    trips: DataFrame,
    cells: DataFrame | None,
    resolution: float = GRID_RESOLUTION,
    counts: Observation | None = None,
) -> DataFrame:
    """``pickup_zone_id`` and ``dropoff_zone_id`` in place of the location columns.

    Without cells (an era that has no coordinates) no join is planned at all.  ``counts``
    observes ``rows_in`` and how the two ends of each trip were resolved: ``ends_by_id``,
    ``ends_by_cell`` and ``ends_unresolved``.
    """
    if cells is None:
        nowhere = F.lit(None).cast("int")
        located = trips.withColumns({"__pu": nowhere, "__do": nowhere})
    else:
        located = trips
        for end, into in (("pickup", "__pu"), ("dropoff", "__do")):
            located = locate(
                located, cells, f"{end}_longitude", f"{end}_latitude", into, resolution
            )
    if counts is not None:
        located = located.observe(counts, F.count(F.lit(1)).alias("rows_in"), *end_counts())
    return located.withColumns({
        "pickup_zone_id": F.coalesce("pu_location_id", "__pu"),
        "dropoff_zone_id": F.coalesce("do_location_id", "__do"),
    }).drop("__pu", "__do", *LOCATION_COLUMNS)


def end_counts() -> list[Column]:
    """Trip ends by what resolved them: the recorded id, else the cell, else nothing."""
    ends = [(F.col(f"{e}_location_id"), F.col(f"__{e}")) for e in ("pu", "do")]
    how = {
        "ends_by_id": [i.isNotNull() for i, _ in ends],
        "ends_by_cell": [i.isNull() & c.isNotNull() for i, c in ends],
        "ends_unresolved": [i.isNull() & c.isNull() for i, c in ends],
    }
    return [(F.count_if(a) + F.count_if(b)).alias(name) for name, (a, b) in how.items()]
