"""Price gap by weather."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.contracts import MAX_PRICE_PER_KM
from tripmart.functions import percent_gap, valid_price, weather_bucket


def bucket_sums(
    trips: DataFrame, ceiling: float = MAX_PRICE_PER_KM, keys: Sequence[str] = ()
) -> DataFrame:
    """Sum and count of prices per (type, weather bucket) and ``keys``; such rows add up."""
    usable = valid_price(F.col("price_per_km"), ceiling) & F.col("temperature_2m").isNotNull()
    return (
        trips.filter(usable)
        .groupBy("vehicle_type", weather_bucket().alias("weather_bucket"), *keys)
        .agg(F.sum("price_per_km").alias("__sum"), F.count("*").alias("nb_courses"))
    )


def add_buckets(sums: DataFrame) -> DataFrame:
    """``bucket_sums`` of several parts of the trips as those of all of them."""
    return sums.groupBy("vehicle_type", "weather_bucket").agg(
        F.sum("__sum").alias("__sum"), F.sum("nb_courses").alias("nb_courses")
    )


def gaps(buckets: DataFrame) -> DataFrame:
    """Mean price per (type, bucket) against the mean over everything.

    The general mean is a scalar subquery over those few rows, so it costs no second
    pass and no round trip through the driver program.
    """
    general = buckets.agg(F.sum("__sum").cast("double") / F.sum("nb_courses")).scalar()
    compared = buckets.select(
        "vehicle_type",
        "weather_bucket",
        (F.col("__sum").cast("double") / F.col("nb_courses")).alias("prix_moyen_bucket"),
        "nb_courses",
        general.alias("prix_moyen_general"),
    )
    return compared.withColumn(
        "ecart_pct", percent_gap(F.col("prix_moyen_bucket"), F.col("prix_moyen_general"))
    )


def price_by_weather(trips: DataFrame, ceiling: float = MAX_PRICE_PER_KM) -> DataFrame:
    """Price gap by weather; the trips are aggregated once, to sums and counts per bucket."""
    return gaps(bucket_sums(trips, ceiling))
