"""Origin-destination flows at any grain, and their matrix."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.contracts import ZONE_ROW_BOUND
from tripmart.operators.counting import count_by
from tripmart.operators.joins import broadcast_within

ENDS = ("pickup", "dropoff")
OTHER, UNKNOWN = "other", "unknown"


def flows(
    rows: DataFrame, place: str, weight: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """How many go from which ``place`` to which, by vehicle type and ``keys``.

    ``rows`` are trips, or finer flows whose own count is ``weight``.
    """
    return count_by(rows, ["vehicle_type", *(f"{end}_{place}" for end in ENDS), *keys], weight)


def flows_by_zone(trips: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Flows between zones, of trips with both ends known."""
    return flows(trips.dropna(subset=[f"{end}_zone_id" for end in ENDS]), "zone_id", keys=keys)


def with_boroughs(
    rows: DataFrame, zones: DataFrame, row_bound: int | None = ZONE_ROW_BOUND
) -> DataFrame:
    """Borough of either end beside its zone id; NULL for a zone without a lookup row."""
    lookup = broadcast_within(
        zones.dropna(subset=["LocationID"]).groupBy("LocationID").agg(F.min("Borough").alias("name")),
        row_bound,
    )

    def named(df: DataFrame, end: str) -> DataFrame:
        side = lookup.toDF(f"{end}_zone_id", f"{end}_borough")
        return df.join(side, f"{end}_zone_id", "left")

    return reduce(named, ENDS, rows)


def flows_by_borough(
    zone_flows: DataFrame, zones: DataFrame, row_bound: int | None = ZONE_ROW_BOUND
) -> DataFrame:
    """Flows between boroughs from those between zones: the lookup never meets the trips."""
    return flows(with_boroughs(zone_flows, zones, row_bound), "borough", "nb_courses")


def flow_matrix(
    rows: DataFrame,
    destinations: Sequence[str],
    origin: str = "pickup_borough",
    destination: str = "dropoff_borough",
) -> DataFrame:
    """One row per origin, one column per destination, and the row's total.

    Destinations that are not listed share the column ``other``, missing ones are in
    ``unknown``: every row adds up.
    """
    column = (
        F.when(F.col(destination).isNull(), UNKNOWN)
        .when(F.col(destination).isin(*destinations), F.col(destination))
        .otherwise(OTHER)
    )
    names = [*destinations, OTHER, UNKNOWN]
    grid = (
        rows.withColumn("__column", column).groupBy(origin).pivot("__column", names)
        .agg(F.sum("nb_courses"))
    )
    cells = [F.coalesce(F.col(f"`{name}`"), F.lit(0)) for name in names]
    return grid.select(
        origin,
        *[cell.alias(name) for cell, name in zip(cells, names)],
        reduce(lambda a, b: a + b, cells).alias("total"),
    )
