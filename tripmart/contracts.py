"""Fixed values and schemas shared by every operator.

Everything here is data: what a source file may call a column, which types the
harmonised table has, and the thresholds the reports use.  Thresholds are only
defaults; each operator takes them as parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Vehicle types, in processing order, and first published month.
# ---------------------------------------------------------------------------
SERVICE_START = {
    "yellow": (2009, 1),
    "green": (2013, 8),
    "fhv": (2015, 1),
    "fhvhv": (2019, 2),
}
VEHICLE_TYPES = tuple(SERVICE_START)

# Default scope of an ingest run.
DEFAULT_YEARS = (2009, 2016, 2019, 2025)
DEFAULT_MONTHS = (1, 6)
HISTORY_START = (2009, 1)

# Zone grid.
GRID_RESOLUTION = 0.001
LON_MIN, LON_MAX = -74.30, -73.65
LAT_MIN, LAT_MAX = 40.45, 40.95

# Measures and report thresholds.
KM_PER_MILE = 1.60934
MAX_PRICE_PER_KM = 50
MIN_ZONE_TRIPS = 5000
SAMPLE_FRACTION = 0.01
SAMPLE_SEED = 42
SAMPLE_YEARS = None  # every year, and trips without one; a list leaves the others out

# Hourly weather variables in the landed JSON.
WEATHER_VARIABLES = {
    "temperature_2m": "double",
    "precipitation": "double",
    "rain": "double",
    "snowfall": "double",
    "weathercode": "bigint",
    "windspeed_10m": "double",
    "relativehumidity_2m": "double",
}
# The six of them that travel with a trip.
TRIP_WEATHER = (
    "temperature_2m",
    "precipitation",
    "rain",
    "snowfall",
    "weathercode",
    "windspeed_10m",
)

# Weather buckets, strongest first: (label, variable, exceeds).
WEATHER_BUCKETS = (
    ("neige", "snowfall", 0),
    ("pluie_forte", "precipitation", 2),
    ("pluie_legere", "precipitation", 0),
    ("vent_fort", "windspeed_10m", 40),
)
CALM_BUCKET = "normal"

# Where a landed row came from: file name and place in it, the same however often it is landed.
ORIGIN_FILE, ORIGIN_ROW = "__file", "__row"
RESERVED_COLUMNS = (ORIGIN_FILE, ORIGIN_ROW)

# Name contract of a monthly source file: type, year, month and, if the month
# comes in parts, the number of the part.  Names with the mark that do not fit are reported.
TRIP_FILE_PATTERN = r"^(\w+?)_tripdata_(\d{4})-(0[1-9]|1[0-2])(?:[._-](?:part[._-]?)?(\d+))?\.parquet$"
TRIP_FILE_MARK = "tripdata"

# ---------------------------------------------------------------------------
# Bounds for broadcasting.  A side is only hinted after its rows were counted
# and found within the bound (see operators.joins.broadcast_within).
# ---------------------------------------------------------------------------
GRID_ROW_BOUND = 2_000_000  # two bigint keys and an int: < 100 MB in a hash map
ZONE_ROW_BOUND = 100_000
WEATHER_ROW_BOUND = 1_000_000  # hours: more than a century
QUANTILE_ROW_BOUND = 1_000_000  # (zone, year, bin) triples


@dataclass(frozen=True)
class TripField:
    """One canonical trip column: its type and its names per vehicle type."""

    name: str
    type: str
    names: dict[str, tuple[str, ...]] = field(default_factory=dict)


def _metered(*names: str, fhvhv: str | None = None) -> dict[str, tuple[str, ...]]:
    """Same names on both metered services, optionally one on fhvhv."""
    out = {"yellow": names, "green": names[:1]}
    if fhvhv:
        out["fhvhv"] = (fhvhv,)
    return out


# Canonical columns with candidate source names, first hit wins.
# Names after the first one on "yellow" are those of the oldest published files.
TRIP_FIELDS = (
    TripField("pickup_datetime", "timestamp_ntz", {
        "yellow": ("tpep_pickup_datetime", "pickup_datetime", "Trip_Pickup_DateTime"),
        "green": ("lpep_pickup_datetime",),
        "fhv": ("pickup_datetime",),
        "fhvhv": ("pickup_datetime",),
    }),
    TripField("dropoff_datetime", "timestamp_ntz", {
        "yellow": ("tpep_dropoff_datetime", "dropoff_datetime", "Trip_Dropoff_DateTime"),
        "green": ("lpep_dropoff_datetime",),
        "fhv": ("dropOff_datetime", "dropoff_datetime"),
        "fhvhv": ("dropoff_datetime",),
    }),
    TripField("pu_location_id", "int", {
        "yellow": ("PULocationID",),
        "green": ("PULocationID",),
        "fhv": ("PUlocationID", "PULocationID"),
        "fhvhv": ("PULocationID",),
    }),
    TripField("do_location_id", "int", {
        "yellow": ("DOLocationID",),
        "green": ("DOLocationID",),
        "fhv": ("DOlocationID", "DOLocationID"),
        "fhvhv": ("DOLocationID",),
    }),
    TripField("pickup_longitude", "double", _metered("pickup_longitude", "Start_Lon")),
    TripField("pickup_latitude", "double", _metered("pickup_latitude", "Start_Lat")),
    TripField("dropoff_longitude", "double", _metered("dropoff_longitude", "End_Lon")),
    TripField("dropoff_latitude", "double", _metered("dropoff_latitude", "End_Lat")),
    TripField("passenger_count", "int", _metered("passenger_count")),
    TripField("trip_distance", "double", _metered("trip_distance", fhvhv="trip_miles")),
    TripField("fare_amount", "double",
              _metered("fare_amount", "Fare_Amt", fhvhv="base_passenger_fare")),
    TripField("tip_amount", "double", _metered("tip_amount", "Tip_Amt", fhvhv="tips")),
    TripField("tolls_amount", "double",
              _metered("tolls_amount", "Tolls_Amt", fhvhv="tolls")),
    # fhvhv files carry no total: the base fare stands in for it.
    TripField("total_amount", "double",
              _metered("total_amount", "Total_Amt", fhvhv="base_passenger_fare")),
)

# Surcharges that appeared over time, with their source names.
SURCHARGES = {
    "improvement_surcharge": ("improvement_surcharge",),
    "congestion_surcharge": ("congestion_surcharge",),
    "airport_fee": ("airport_fee", "Airport_fee"),
    "cbd_congestion_fee": ("cbd_congestion_fee", "congestion_fee_cbd"),
}
FLAG_SUFFIX = "_disponible"

LOCATION_COLUMNS = (
    "pu_location_id",
    "do_location_id",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
)
PARTITION_KEYS = ("vehicle_type", "year", "month")

RING_SCHEMA = "LocationID int, ring array<struct<x:double,y:double>>"
MANIFEST_SCHEMA = (
    "vehicle_type string, year int, month int, source string, row_count bigint, "
    "ingested_at timestamp, columns array<string>, location string"
)
WEATHER_MANIFEST_SCHEMA = (
    "year int, month int, source string, row_count bigint, ingested_at timestamp"
)
# Which answers are known: a file as it was, the month most of its hours lie in (NULL if none
# can be read), how many hours it has and how many of them lie outside that month.
WEATHER_ANSWER_SCHEMA = (
    "answer string, modified timestamp, length bigint, source string, year int, month int, "
    "hours bigint, outside bigint"
)

WEATHER_JSON_SCHEMA = T.StructType([
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [
            T.StructField(
                name,
                T.ArrayType(T.LongType() if kind == "bigint" else T.DoubleType()),
            )
            for name, kind in WEATHER_VARIABLES.items()
        ]
    ))
])


def flag_of(surcharge: str) -> str:
    return surcharge + FLAG_SUFFIX
