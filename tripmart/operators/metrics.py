"""Derived trip columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import hour_of, minutes_between, price_per_km


def add_trip_metrics(trips: DataFrame) -> DataFrame:
    """Duration, price per km, and the calendar columns of the pickup time."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return trips.withColumns({
        "trip_duration_min": minutes_between(pickup, dropoff),
        "price_per_km": price_per_km(F.col("total_amount"), F.col("trip_distance")),
        "year": F.year(pickup),
        "month": F.month(pickup),
        "pickup_hour_ts": hour_of(pickup),
    })
