"""Rides by weekday and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.counting import count_by, count_by_calendar


def rides_by_dow_hour(trips: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Trips per (type, year, weekday, hour) of the pickup, and ``keys``."""
    return count_by_calendar(
        trips, "pickup_datetime", ("day_of_week", "hour_of_day"), keys=("vehicle_type", "year", *keys)
    )


def add_rides(parts: DataFrame) -> DataFrame:
    """Rides of several parts of the trips as those of all of them."""
    return count_by(parts, ["vehicle_type", "year", "day_of_week", "hour_of_day"], "nb_courses")


def heatmap(rides: DataFrame, year: int) -> DataFrame:
    """One year as a grid: a row per weekday, columns ``h0`` to ``h23``.

    On the stored table, partitioned by year, the filter prunes to one folder.
    """
    hours = list(range(24))
    grid = (
        rides.filter(F.col("year") == year)
        .groupBy("day_of_week")
        .pivot("hour_of_day", hours)
        .agg(F.sum("nb_courses"))
    )
    return grid.select(
        "day_of_week",
        *[F.coalesce(F.col(str(h)), F.lit(0)).alias(f"h{h}") for h in hours],
    )
