"""A third of all rows under one key, with every broadcast switched off."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripmart.operators.weather_join import join_weather
from tripmart.operators.zones import resolve_zones, zone_cells
from tripmart.plans.prices import in_eligible_zones

ROWS = 120_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def shuffled(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    """Rows by column values, and the plan that ran."""
    counts = {}
    for row in df.collect():
        counts[row[-1]] = counts.get(row[-1], 0) + 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    return counts, plan.split("== Initial Plan ==")[0]


def hot(value, other):
    return F.when(F.col("id") % 3 == 0, value).otherwise(other)


def test_hot_cell_is_split(shuffled):
    grid = shuffled.range(400).select(
        (F.col("id") % 20 - 74000).alias("grid_lon_idx"),
        (F.floor(F.col("id") / 20) + 40700).alias("grid_lat_idx"),
        (F.col("id") + 1).cast("int").alias("LocationID"),
    )
    trips = shuffled.range(0, ROWS, 1, 8).select(
        "id",
        F.lit(None).cast("int").alias("pu_location_id"),
        F.lit(0).alias("do_location_id"),
        hot(-74.0, -74.0 + F.col("id") % 20 * 0.001).alias("pickup_longitude"),
        hot(40.7, 40.7 + F.floor(F.col("id") / 20) % 20 * 0.001).alias("pickup_latitude"),
        F.lit(None).cast("double").alias("dropoff_longitude"),
        F.lit(None).cast("double").alias("dropoff_latitude"),
    )
    out = resolve_zones(trips, zone_cells(grid, row_bound=0))
    counts, plan = executed(out.select("id", "pickup_zone_id"))
    assert "SortMergeJoin(skew=true)" in plan and "Broadcast" not in plan
    assert sum(counts.values()) == ROWS and counts[1] >= ROWS // 3


def test_hot_hour_is_split(shuffled):
    start = F.lit(datetime(2019, 1, 1)).cast("timestamp_ntz")
    hour = start + F.make_dt_interval(F.lit(0), (F.col("id") % 500).cast("int"))
    trips = shuffled.range(0, ROWS, 1, 8).select("id", hot(start, hour).alias("pickup_hour_ts"))
    weather = shuffled.range(500).select(
        (start + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("datetime_local"),
        F.col("id").cast("double").alias("rain"),
    )
    counts, plan = executed(join_weather(trips, weather, ["rain"], row_bound=0).select("id", "rain"))
    assert "SortMergeJoin(skew=true)" in plan and "Broadcast" not in plan
    assert sum(counts.values()) == ROWS and None not in counts and counts[0.0] >= ROWS // 3


def test_hot_zone_is_split(shuffled):
    trips = shuffled.range(0, ROWS, 1, 8).select(
        "id", hot(7, F.col("id") % 200).cast("int").alias("pickup_zone_id"))
    zones = trips.groupBy("pickup_zone_id").count().filter("count > 0")
    counts, plan = executed(in_eligible_zones(trips, zones).select("id", "pickup_zone_id"))
    assert "skew=true" in plan and "Broadcast" not in plan
    assert sum(counts.values()) == ROWS and counts[7] >= ROWS // 3


def test_few_cells_and_hours_of_many_rows_shuffle_no_trip(shuffled):
    """The rows of the lookups are beyond the bounds, what is joined is not."""
    start = F.lit(datetime(2019, 1, 1)).cast("timestamp_ntz")
    hour = start + F.make_dt_interval(F.lit(0), (F.col("id") % 30).cast("int"))
    grid = shuffled.range(5000).select(
        (F.col("id") % 20 - 74000).alias("grid_lon_idx"), F.lit(40700).cast("long").alias("grid_lat_idx"),
        (F.col("id") + 1).cast("int").alias("LocationID"))
    weather = shuffled.range(5000).select(hour.alias("datetime_local"), (F.col("id") % 30).cast("double").alias("rain"))
    trips = shuffled.range(0, 1000, 1, 8).select(
        "id", hour.alias("pickup_hour_ts"), F.lit(None).cast("int").alias("pu_location_id"),
        F.lit(0).alias("do_location_id"), (-74.0 + F.col("id") % 40 * 0.001).alias("pickup_longitude"),
        F.lit(40.7).alias("pickup_latitude"), F.lit(None).cast("double").alias("dropoff_longitude"),
        F.lit(None).cast("double").alias("dropoff_latitude"))
    cells = zone_cells(grid, row_bound=100, at_most=5000)
    out = join_weather(resolve_zones(trips, cells), weather, ["rain"], row_bound=100, at_most=5000)
    got = out.select("id", "pickup_zone_id", "rain").collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert sorted(map(tuple, got)) == [(k, k % 40 + 1 if k % 40 < 20 else None, k % 30) for k in range(1000)]
