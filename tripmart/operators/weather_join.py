"""Weather of the hour in which a trip began."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripmart.contracts import TRIP_WEATHER, WEATHER_ROW_BOUND
from tripmart.operators.joins import broadcast_within


def one_row_per_hour(weather: DataFrame, variables: Sequence[str] = TRIP_WEATHER) -> DataFrame:
    """Fullest record of each hour, the least one of several: no trip is multiplied."""
    lacking = reduce(lambda a, b: a + b, [F.col(v).isNull().cast("int") for v in variables])
    return (
        weather.filter(F.col("datetime_local").isNotNull())
        .groupBy("datetime_local")
        .agg(F.min(F.struct(lacking.alias("__lacking"), *variables)).alias("record"))
        .select("datetime_local", *[F.col("record")[v].alias(v) for v in variables])
    )


def join_weather(
    trips: DataFrame,
    weather: DataFrame,
    variables: Sequence[str] = TRIP_WEATHER,
    row_bound: int | None = WEATHER_ROW_BOUND,
    at_most: int | None = None,
    counts: Observation | None = None,
) -> DataFrame:
    """Left join on the wall-clock hour; every trip stays exactly once.

    ``at_most`` is a number of hours that ``weather`` cannot exceed, if known; beyond the bound
    its distinct hours are counted.  ``counts`` observes ``rows_out`` and ``hours_matched`` while the result is computed.
    """
    hours = one_row_per_hour(weather, variables).withColumnRenamed(
        "datetime_local", "pickup_hour_ts"
    )
    if counts is not None:
        hours = hours.withColumn("__hour", F.lit(True))
    side = broadcast_within(hours, row_bound, at_most, recount=True)
    joined = trips.join(side, "pickup_hour_ts", "left")
    if counts is None:
        return joined
    return joined.observe(
        counts, F.count(F.lit(1)).alias("rows_out"), F.count("__hour").alias("hours_matched")
    ).drop("__hour")
