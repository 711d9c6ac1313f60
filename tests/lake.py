"""Hand-made source files: trips of several eras, weather answers, zones."""

import json
import os
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq

TIME = pa.timestamp("us")


def at(text):
    return None if text is None else datetime.fromisoformat(text)


def write(root, vehicle_type, year, month, columns, nested=True):
    """One monthly source file; ``columns`` maps name to (arrow type, values)."""
    folder = os.path.join(root, f"{year:04d}", f"{month:02d}") if nested else root
    os.makedirs(folder, exist_ok=True)
    table = pa.table({name: pa.array(values, kind) for name, (kind, values) in columns.items()})
    path = os.path.join(folder, f"{vehicle_type}_tripdata_{year:04d}-{month:02d}.parquet")
    pq.write_table(table, path)
    return table.num_rows


def put_table(path, arrays):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(arrays), path)


def yellow_gps(pickups):
    n = len(pickups)
    inside = (-73.995, 40.705)
    return {
        "tpep_pickup_datetime": (TIME, [at(p) for p in pickups]),
        "tpep_dropoff_datetime": (TIME, [at("2016-01-01 12:00:00")] * n),
        "pickup_longitude": (pa.float64(), [inside[0], 1e300, None, 0.0][:n]),
        "pickup_latitude": (pa.float64(), [inside[1], 40.7, None, 0.0][:n]),
        "dropoff_longitude": (pa.float64(), [inside[0]] * n),
        "dropoff_latitude": (pa.float64(), [inside[1]] * n),
        "passenger_count": (pa.int64(), [1] * n),
        "trip_distance": (pa.float64(), [1.0, 0.0, None, float("nan")][:n]),
        "fare_amount": (pa.float64(), [10.0] * n),
        "tip_amount": (pa.float64(), [1.0] * n),
        "tolls_amount": (pa.float64(), [0.0] * n),
        "total_amount": (pa.float64(), [16.0934] * n),
        "improvement_surcharge": (pa.float64(), [0.3, 0.0, None, 0.3][:n]),
    }


def yellow_loc(pickups, kind=pa.int32(), fee="airport_fee", late=False):
    n = len(pickups)
    columns = {
        "tpep_pickup_datetime": (TIME, [at(p) for p in pickups]),
        "tpep_dropoff_datetime": (TIME, [at("2019-01-05 10:30:00")] * n),
        "PULocationID": (kind, [(10 + i) for i in range(n)]),
        "DOLocationID": (kind, [20] * n),
        "passenger_count": (pa.float64(), [1.0] * n),
        "trip_distance": (pa.float64(), [2.0] * n),
        "fare_amount": (pa.float64(), [20.0] * n),
        "tip_amount": (pa.float64(), [0.0] * n),
        "tolls_amount": (pa.float64(), [0.0] * n),
        "total_amount": (pa.float64(), [30.0] * n),
        "improvement_surcharge": (pa.float64(), [0.3] * n),
        "congestion_surcharge": (pa.float64(), [2.5, 0.0, None, 2.5][:n]),
        # A column that was never filled has no type of its own in real files.
        fee: (pa.float64() if late else pa.null(), [None] * n),
    }
    if late:
        columns["cbd_congestion_fee"] = (pa.float64(), [0.75] * n)
    return columns


def green(pickups):
    n = len(pickups)
    return {
        "lpep_pickup_datetime": (TIME, [at(p) for p in pickups]),
        "lpep_dropoff_datetime": (TIME, [at("2019-01-05 09:00:00")] * n),
        "PULocationID": (pa.int64(), [30] * n),
        "DOLocationID": (pa.int64(), [None] * n),
        "trip_distance": (pa.float64(), [1.0] * n),
        "total_amount": (pa.float64(), [8.0] * n),
    }


def fhv(pickups):
    n = len(pickups)
    return {
        "pickup_datetime": (TIME, [at(p) for p in pickups]),
        "dropOff_datetime": (TIME, [at("2019-01-05 11:00:00")] * n),
        "PUlocationID": (pa.float64(), [40.0, None, 41.0][:n]),
        "DOlocationID": (pa.float64(), [40.0] * n),
    }


def fhvhv(pickups):
    n = len(pickups)
    return {
        "pickup_datetime": (TIME, [at(p) for p in pickups]),
        "dropoff_datetime": (TIME, [at("2019-02-01 01:00:00")] * n),
        "PULocationID": (pa.int64(), [50] * n),
        "DOLocationID": (pa.int64(), [51] * n),
        "trip_miles": (pa.float64(), [3.0] * n),
        "base_passenger_fare": (pa.float64(), [12.0] * n),
        "tips": (pa.float64(), [1.0] * n),
        "tolls": (pa.float64(), [0.0] * n),
        "congestion_surcharge": (pa.float64(), [2.75] * n),
        "airport_fee": (pa.float64(), [0.0] * n),
    }


def sources(root):
    """Primary and fallback folders; returns rows per (type, year, month)."""
    near, far = os.path.join(root, "near"), os.path.join(root, "far")
    counts = {}

    def put(folder, kind, year, month, columns, nested=True):
        counts[kind, year, month] = write(folder, kind, year, month, columns, nested)

    put(near, "yellow", 2016, 1, yellow_gps(
        ["2016-01-01 10:00:00", "2016-01-01 11:30:00", None, "2015-12-31 23:59:59"]))
    put(near, "yellow", 2016, 2, yellow_gps(["2016-02-01 00:00:00", "2016-02-03 04:05:06"]))
    put(near, "yellow", 2019, 1, yellow_loc(
        ["2019-01-05 10:00:00", "2019-01-05 10:15:00", "2019-01-05 11:00:00"]))
    put(near, "yellow", 2019, 2, yellow_loc(
        ["2019-02-05 10:00:00"], pa.int64(), "Airport_fee", late=True))
    put(near, "green", 2019, 1, green(["2019-01-05 08:30:00"] * 2))
    put(near, "fhv", 2019, 1, fhv(["2019-01-05 10:20:00"] * 3))
    put(far, "fhvhv", 2019, 2, fhvhv(["2019-02-01 00:10:00"] * 2), nested=False)
    # Also in the fallback, with another row count: the primary must win.
    write(far, "green", 2019, 1, green(["2019-01-01 00:00:00"] * 7), nested=False)
    # Before the service started: never looked at.
    write(near, "fhvhv", 2019, 1, fhvhv(["2019-01-01 00:00:00"]))
    return near, far, counts


HOURS = {
    # time: temperature, precipitation, rain, snowfall, wind
    "2016-01-01T10:00": (1.0, 0.0, 0.0, 0.5, 10.0),
    "2016-01-01T11:00": (2.0, 3.0, 3.0, None, 10.0),
    "2019-01-05T08:00": (4.0, 0.0, 0.0, 0.0, 45.0),
    "2019-01-05T10:00": (5.0, 1.0, 1.0, 0.0, 10.0),
    "2019-02-01T00:00": (6.0, 0.0, 0.0, 0.0, 40.0),
}


def weather(root, repeated=True):
    """One JSON answer per month, the hour 10:00 of 2019-01-05 twice."""
    os.makedirs(root, exist_ok=True)
    months = {}
    for time, values in HOURS.items():
        months.setdefault(time[:7], []).append((time, values))
    if repeated:
        months["2019-01"].append(("2019-01-05T10:00", (9.0, 9.0, 9.0, 9.0, 9.0)))
    for month, hours in months.items():
        names = ("temperature_2m", "precipitation", "rain", "snowfall", "windspeed_10m")
        body = {"time": [t for t, _ in hours]}
        for k, name in enumerate(names):
            body[name] = [v[k] for _, v in hours]
        body["weathercode"] = [3] * len(hours)
        body["relativehumidity_2m"] = [50.0] * len(hours)
        with open(os.path.join(root, f"weather_{month}.json"), "w") as handle:
            json.dump({"latitude": 40.7, "hourly_units": {"time": "iso8601"}, "hourly": body},
                      handle, indent=1)
