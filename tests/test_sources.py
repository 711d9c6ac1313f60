import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tripmart.operators.sampling import keyed_sample, keyed_sample_by
from tripmart.sources.reference import load_zones, read_grid, read_rings, read_zone_csv
from tripmart.sources.tables import read_table, write_partitioned, write_table
from tripmart.sources.weather import hourly_rows, parse_weather_text, read_weather_json


def test_zone_csv_by_header_with_bad_ids(spark, path):
    with open(path("z.csv"), "w") as handle:
        handle.write('"Borough","LocationID","Zone"\n"EWR",1,"Newark"\n"Unknown","N/A","?"\n')
    got = read_zone_csv(spark, path("z.csv"))
    assert rows(got.select("LocationID", "Borough")) == [(1, "EWR"), (None, "Unknown")]
    assert dict(got.dtypes)["LocationID"] == "int"


def test_zone_table_is_written_once(spark, path):
    with open(path("z.csv"), "w") as handle:
        handle.write("LocationID,Borough\n1,EWR\n")
    assert load_zones(spark, path("z.csv"), path("zones")).count() == 1
    with open(path("z.csv"), "a") as handle:
        handle.write("2,Queens\n")
    assert load_zones(spark, path("z.csv"), path("zones")).count() == 1


def test_rings_and_grid_round_trip(spark, path):
    rings = spark.createDataFrame(
        [(1, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)])],
        "LocationID int, ring array<struct<x:double,y:double>>")
    rings.write.parquet(path("rings"))
    assert rows(read_rings(spark, path("rings"))) == rows(rings)
    # Ids of another integer type are cast.
    spark.createDataFrame([(1, 2, 3)], "grid_lon_idx int, grid_lat_idx int, LocationID bigint"
                          ).write.parquet(path("grid"))
    got = read_grid(spark, path("grid"))
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "int"]
    assert rows(got) == [(1, 2, 3)]


PAYLOAD = {
    "hourly": {
        "time": ["2019-03-10T02:00", "2019-03-10T03:00"],
        "temperature_2m": [1.5, None],
        "precipitation": [0.1, 0.2],
        "rain": [0.1],  # shorter than the others
        "snowfall": [0, 0],
        "weathercode": [61, 3],
        "windspeed_10m": [10.0, 20.0],
        "relativehumidity_2m": [80, 81],
    },
    "hourly_units": {"time": "iso8601"},
}
HOURS = [
    (datetime(2019, 3, 10, 2), 1.5, 0.1, 0.1, 0.0, 61, 10.0, 80.0),
    (datetime(2019, 3, 10, 3), None, 0.2, None, 0.0, 3, 20.0, 81.0),
]


def test_weather_json_to_hours_in_any_zone(spark, path, zoned):
    with open(path("w.json"), "w") as handle:
        json.dump(PAYLOAD, handle, indent=2)
    text = spark.createDataFrame([(json.dumps(PAYLOAD),)], "body string")
    for zone in ("UTC", "America/New_York"):
        zoned(zone)
        assert rows(hourly_rows(read_weather_json(spark, path("w.json")))) == HOURS
        assert rows(hourly_rows(parse_weather_text(text, "body"))) == HOURS


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", 2019, 1, 1.0), ("a", 2019, 1, 2.0), ("b", 2019, 2, 3.0), ("b", None, None, 4.0)],
        "vehicle_type string, year int, month int, v double")


def test_partitioned_write_keeps_null_partitions(spark, table, path):
    keys = ("vehicle_type", "year", "month")
    write_partitioned(table.repartition(4), path("t"), keys)
    back = read_table(spark, path("t"))
    assert rows(back.select(*table.columns)) == rows(table)
    files = [r.f for r in back.select(F.input_file_name().alias("f")).distinct().collect()]
    assert len(files) == 3  # one per partition
    assert any("__HIVE_DEFAULT_PARTITION__" in f for f in files)


def test_replacing_partitions_or_the_table(spark, table, path):
    keys = ("vehicle_type", "year", "month")
    write_partitioned(table, path("t"), keys)
    one = table.filter("v = 3").withColumn("v", F.lit(30.0))
    write_partitioned(one, path("t"), keys, replace="partitions")
    assert sorted(r.v for r in read_table(spark, path("t"), True).collect()) == [1.0, 2.0, 4.0, 30.0]
    write_partitioned(one, path("t"), keys)
    assert [r.v for r in read_table(spark, path("t"), True).collect()] == [30.0]


def test_plain_table_overwrite(spark, table, path):
    write_table(table, path("t"))
    write_table(table.filter("v > 2"), path("t"))
    assert read_table(spark, path("t"), refresh=True).count() == 2


def test_keyed_sample_is_a_plain_filter(spark):
    df = spark.range(10_000).withColumn("year", (F.col("id") % 3 + 2018).cast("int"))
    got = keyed_sample(df, ["id"], 0.1)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == rows(keyed_sample(df.repartition(13), ["id"], 0.1))
    by = keyed_sample_by(df, "year", {2018: 1.0, 2019: 0.1}, ["id"])
    counts = dict(rows(by.groupBy("year").count()))
    assert counts[2018] == 3334 and 250 < counts[2019] < 420 and 2020 not in counts
