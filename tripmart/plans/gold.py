"""Report tables on storage: each is written from silver and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.plans.flows import flows_by_borough, flows_by_zone
from tripmart.plans.prices import price_sample
from tripmart.plans.rides import rides_by_dow_hour
from tripmart.plans.surcharges import surcharge_evolution
from tripmart.plans.weather_prices import price_by_weather
from tripmart.sources.tables import read_table, write_partitioned, write_table


def build_surcharges(spark: SparkSession, trips: DataFrame, path: str) -> DataFrame:
    write_partitioned(surcharge_evolution(trips), path, ["supplement"])
    return read_table(spark, path, refresh=True)


def build_flows(
    spark: SparkSession, trips: DataFrame, zones: DataFrame, zone_path: str, borough_path: str
) -> tuple[DataFrame, DataFrame]:
    """Both grains; the borough table is computed from the stored zone table."""
    write_table(flows_by_zone(trips), zone_path)
    by_zone = read_table(spark, zone_path, refresh=True)
    write_table(flows_by_borough(by_zone, zones), borough_path)
    return by_zone, read_table(spark, borough_path, refresh=True)


def build_price_sample(
    spark: SparkSession, trips: DataFrame, path: str, **options
) -> tuple[DataFrame, int]:
    """The sample and its size, counted on the stored table."""
    write_partitioned(price_sample(trips, **options), path, ["pickup_zone_id"])
    stored = read_table(spark, path, refresh=True)
    return stored, stored.count()


def build_rides(spark: SparkSession, trips: DataFrame, path: str) -> DataFrame:
    write_partitioned(rides_by_dow_hour(trips), path, ["year"])
    return read_table(spark, path, refresh=True)


def build_price_by_weather(
    spark: SparkSession, trips: DataFrame, path: str, **options
) -> DataFrame:
    write_table(price_by_weather(trips, **options), path)
    return read_table(spark, path, refresh=True)
