"""Cases in which rows used to vanish or change."""

import json
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import lake
from helpers import DATA, rows
from tripmart.catalog.queries import _QUERIES
from tripmart.catalog.roles import Tables
from tripmart.contracts import WEATHER_VARIABLES
from tripmart.plans import landing, prices, silver
from tripmart.sources import tables
from tripmart.sources.listing import columns_of, list_month_files, with_footers
from tripmart.sources.reference import load_zones
from tripmart.sources.weather import hourly_rows, parse_weather_text


def land(spark, path, near, **options):
    return dict(rows(landing.ingest_trips(
        spark, list_month_files(spark, near), None, path("bronze"), path("manifest"),
        years=(2019,), months=(1, 2), **options)))


def trips(spark, path, **options):
    grid = spark.createDataFrame([], "grid_lon_idx bigint, grid_lat_idx bigint, LocationID int")
    hours = spark.createDataFrame([], "datetime_local timestamp_ntz, " + ", ".join(
        f"{n} {k}" for n, k in WEATHER_VARIABLES.items()))
    manifest = landing.open_manifest(spark, path("manifest"))
    return silver.build_silver_trips(spark, path("bronze"), manifest, grid, hours, path("silver"), **options)


def test_a_month_in_two_files_keeps_both(spark, path):
    near = path("near")
    lake.write(f"{near}/a", "green", 2019, 1, lake.green(["2019-01-05 08:00:00"] * 2), nested=False)
    lake.write(f"{near}/b", "green", 2019, 1, lake.green(["2019-01-06 08:00:00"] * 3), nested=False)
    assert land(spark, path, near)["ingested"] == 1
    assert landing.open_manifest(spark, path("manifest")).first().row_count == 5
    assert trips(spark, path).count() == 5


def test_parts_with_other_columns_are_an_error(spark, path):
    near = path("near")
    lake.write(f"{near}/a", "green", 2019, 1, lake.green(["2019-01-05 08:00:00"]), nested=False)
    other = lake.green(["2019-01-06 08:00:00"]) | {"tip_amount": (pa.float64(), [1.0])}
    lake.write(f"{near}/b", "green", 2019, 1, other, nested=False)
    with pytest.raises(ValueError, match="differ in columns"):
        land(spark, path, near)


def test_unknown_vehicle_types_are_an_error(spark, path):
    lake.write(path("near"), "boat", 2019, 1, lake.green(["2019-01-05 08:00:00"]))
    land(spark, path, path("near"), starts={"boat": (2019, 1)})
    with pytest.raises(ValueError, match="boat"):
        trips(spark, path)


def test_a_rebuilt_type_loses_strays_that_are_gone(spark, path):
    near = path("near")
    lake.write(near, "green", 2019, 1, lake.green(["2019-01-05 08:00:00", "2018-12-31 23:00:00"]))
    lake.write(near, "fhv", 2019, 1, lake.fhv(["2019-01-05 10:20:00"] * 3))
    land(spark, path, near)
    assert trips(spark, path).count() == 5
    lake.write(near, "green", 2019, 1, lake.green(["2019-01-05 08:00:00"]))
    land(spark, path, near, force=True)
    again = trips(spark, path, types=["green"])
    assert rows(again.groupBy("vehicle_type").count()) == [("fhv", 3), ("green", 1)]


def test_landing_again_keeps_identities_and_samples(spark, path):
    times = [f"2019-01-{1 + k % 28:02d} 08:00:00" for k in range(200)]
    lake.write(path("near"), "green", 2019, 1, lake.green(times))
    seen = []
    for _ in range(2):
        land(spark, path, path("near"), force=True)
        got = trips(spark, path)
        seen.append((rows(got.select("source_file", "source_row")),
                     rows(prices.price_sample(got.withColumn("price_per_km", got.source_row + 1.0), 1e9, 1, 0.3))))
    assert seen[0] == seen[1] and len(set(seen[0][0])) == 200 and 30 < len(seen[0][1]) < 90


def test_unreadable_files_are_reported_and_the_others_land(spark, path):
    near = path("near")
    lake.write(near, "green", 2019, 1, lake.green(["2019-01-05 08:00:00"]))
    folder = f"{near}/2019/02"
    os.makedirs(folder)
    table = pa.table({"pickup_datetime": pa.array([lake.at("2019-02-01 00:00:00")], pa.timestamp("ns"))})
    pq.write_table(table, f"{folder}/fhv_tripdata_2019-02.parquet", version="2.6")
    with open(f"{folder}/green_tripdata_2019-02.parquet", "wb") as handle:
        handle.write(b"no parquet")
    bad = 1 + (columns_of(spark, f"{folder}/fhv_tripdata_2019-02.parquet")[0] is None)
    with pytest.warns(UserWarning, match="green_tripdata_2019-02"):
        got = land(spark, path, near)
    assert got["unreadable"] == bad and got["ingested"] == 3 - bad


def answer(times, **arrays):
    return json.dumps({"hourly": {"time": times} | arrays})


def test_answers_with_gaps_keep_every_hour(spark):
    times = ["2019-01-01T00:00", "not a time", "2019-01-01T02:00"]
    bodies = [answer(times, rain=[1.0, 2.0]), answer(times, rain=None, weathercode=[1, 2, 3])]
    got = hourly_rows(parse_weather_text(spark.createDataFrame([(b,) for b in bodies], "body string"), "body"))
    assert got.count() == 6 and got.filter("datetime_local is null").count() == 2
    assert rows(got.select("rain").dropna()) == [(1.0,), (2.0,)]


def test_a_stray_hour_marks_no_month(spark, path):
    os.makedirs(path("json"))

    def put(name, times):
        with open(f"{path('json')}/{name}.json", "w") as handle:
            handle.write(answer(times, rain=[0.5] * len(times)))

    def run():
        return dict(rows(landing.ingest_weather(spark, path("json"), path("b"), path("m"))))

    put("january", ["2019-01-31T22:00", "2019-01-31T23:00", "2019-02-01T00:00"])
    assert run() == {"ingested": 1, "hours_outside": 1}
    put("february", ["2019-02-01T00:00", "2019-02-01T01:00", "2019-02-01T02:00"])
    assert run() == {"skipped": 1, "ingested": 1}
    hours = silver.bronze_weather(spark, path("b")).select("datetime_local").distinct()
    assert hours.count() == 5


def test_zones_survive_a_first_write_that_broke_off(spark, path):
    with open(path("z.csv"), "w") as handle:
        handle.write("LocationID,Borough\n1,A\n")
    os.makedirs(path("zones") + "/_temporary")
    assert load_zones(spark, path("z.csv"), path("zones")).count() == 1


def test_hours_of_an_answer_without_readable_times_are_counted(spark, path):
    os.makedirs(path("json"))
    for name, times in (("january", ["2019-01-01T00:00"]), ("unreadable", ["no time", "none either"])):
        with open(f"{path('json')}/{name}.json", "w") as handle:
            handle.write(answer(times, rain=[0.5] * len(times)))
    got = dict(rows(landing.ingest_weather(spark, path("json"), path("b"), path("m"))))
    assert got == {"ingested": 1, "hours_outside": 2}


def test_parts_of_equal_name_in_two_folders_have_identities_of_their_own(spark, path):
    near = path("near")
    for part in ("a", "b"):
        lake.write(f"{near}/{part} +%41é", "green", 2019, 1, lake.green(["2019-01-05 08:00:00"] * 3), nested=False)
    seen = []
    for _ in range(2):
        land(spark, path, near, force=True)
        seen.append(rows(trips(spark, path).select("source_file", "source_row")))
    assert seen[0] == seen[1] and len(set(seen[0])) == 6
    assert {f for f, _ in seen[0]} == {
        f"green/2019/1/{part} +%41é/green_tripdata_2019-01.parquet" for part in ("a", "b")}
    # The same files below another root are the same rows.
    os.rename(near, path("moved"))
    land(spark, path, path("moved"), force=True)
    assert rows(trips(spark, path).select("source_file", "source_row")) == seen[0]


def test_a_month_in_numbered_parts_lands_whole_and_strays_are_named(spark, path):
    near = path("near")
    for folder, n in (("a", 2), ("b", 4)):
        lake.write(f"{near}/{folder}", "green", 2019, 1, lake.green(["2019-01-05 08:00:00"] * n), nested=False)
    table = pq.read_table(f"{near}/a/green_tripdata_2019-01.parquet")
    names = ("green_tripdata_2019-02_part2", "green_tripdata_2019-02-3", "green_tripdata_2019-02.part-00001",
             "green_tripdata_2019-01_part2")
    for name in names:
        pq.write_table(table, f"{near}/{name}.parquet")
    pq.write_table(table.slice(0, 1), f"{near}/a/green_tripdata_2019-01_part7.parquet")
    for stray in ("green_tripdata_2019-13", "green_tripdata_2019-1", "Green_TripData 2019", "zones"):
        pq.write_table(table, f"{near}/{stray}.parquet")
    with pytest.warns(UserWarning, match="green_tripdata_2019-13"):
        got = land(spark, path, near)
    assert got == {"ingested": 2, "not_published": 5, "unplaced": 3}
    months = landing.open_manifest(spark, path("manifest")).select("month", "row_count")
    assert rows(months) == [(1, 9), (2, 6)] and trips(spark, path).count() == 15


def test_many_footers_are_opened_at_once(spark, path):
    os.makedirs(path("near"))
    for k in range(600):
        pq.write_table(pa.table({"v": pa.array([1.0] * (k % 3), pa.float64()), f"c{k % 4}": pa.array([k] * (k % 3), pa.int64())}),
                       f"{path('near')}/green_tripdata_2019-01_part{k}.parquet")
    files = list_month_files(spark, path("near"))
    started = time.monotonic()
    found = with_footers(files).groupBy("columns").agg({"*": "count", "row_count": "sum"}).collect()
    assert time.monotonic() - started < 15
    assert sorted(r["columns"][0] for r in found) == [f"c{k} bigint" for k in range(4)]
    assert {r["count(1)"] for r in found} == {150} and sum(r["sum(row_count)"] for r in found) == 600


def test_a_storage_that_does_not_answer_is_an_error_and_not_a_bad_file(spark, path):
    lake.write(path("near"), "green", 2019, 1, lake.green(["2019-01-05 08:00:00"]), nested=False)
    files = list_month_files(spark, path("near"))
    names = spark.createDataFrame(files.collect(), files.schema)
    os.rename(path("near"), path("away"))
    with pytest.raises(OSError, match="does not give"):
        with_footers(names)


def test_a_known_answer_is_never_parsed_again(spark, path, monkeypatch):
    os.makedirs(path("json"))
    real, parsed = landing.read_weather_json, []

    def put(name, times):
        with open(f"{path('json')}/{name}.json", "w") as handle:
            handle.write(answer(times, rain=[0.5] * len(times)))

    def spy(spark, paths):
        parsed.append(sorted(p.rsplit("/", 1)[1] for p in paths))
        return real(spark, paths)

    def run(**options):
        parsed.clear()
        return dict(rows(landing.ingest_weather(spark, path("json"), path("b"), path("m"), **options)))

    monkeypatch.setattr(landing, "read_weather_json", spy)
    for month in (1, 2, 3):
        put(f"m{month}", [f"2019-{month:02d}-01T0{h}:00" for h in range(month)])
    put("nothing", [])
    assert run(limit=2) == {"ingested": 2} and parsed == [["m1.json", "m2.json", "m3.json", "nothing.json"]]
    # What lies in a known file is not looked at, so it may even be broken.
    known = f"{path('json')}/m1.json"
    before = os.stat(known)
    with open(known, "w") as handle:
        handle.write("#" * before.st_size)
    os.utime(known, ns=(before.st_atime_ns, before.st_mtime_ns))
    assert run(limit=2) == {"skipped": 2} and parsed == []
    # An answer whose month was out of scope is read when its month is landed.
    assert run() == {"skipped": 2, "ingested": 1} and parsed == [["m3.json"]]
    put("m4", ["2019-04-01T00:00"])
    assert run() == {"skipped": 3, "ingested": 1} and parsed == [["m4.json"]]
    assert run() == {"skipped": 4} and parsed == []
    assert silver.bronze_weather(spark, path("b")).count() == 1 + 2 + 3 + 1
    assert not os.path.exists(path("b") + "__incoming")
    # A changed file is a new answer; its month is landed again only by force.
    put("m2", ["2019-02-01T00:00"] * 5)
    assert run() == {"skipped": 4} and parsed == [["m2.json"]]
    os.remove(known)
    assert run(force=True) == {"ingested": 3}
    assert silver.bronze_weather(spark, path("b")).filter("month(datetime_local) = 2").count() == 5


def test_counts_of_a_silver_build_come_with_its_writes(spark, path):
    near = path("near")
    lake.write(near, "yellow", 2019, 1, lake.yellow_gps(["2019-01-05 08:00:00", "2019-01-05 09:10:00", None, "2019-01-07 08:00:00"]))
    lake.write(near, "green", 2019, 1, lake.green(["2019-01-05 08:30:00", "2018-12-31 23:00:00"]))
    land(spark, path, near)
    manifest = landing.open_manifest(spark, path("manifest"))
    lookup = "grid_lon_idx bigint, grid_lat_idx bigint, LocationID int"
    spark.createDataFrame([(-73995, 40705, 161)], lookup).write.parquet(path("grid"))
    spark.createDataFrame([(lake.at("2019-01-05 08:00:00"), *[1.0] * 4, 3, 1.0, 1.0)], "datetime_local timestamp_ntz, " + ", ".join(
        f"{n} {WEATHER_VARIABLES[n]}" for n in ("temperature_2m", "precipitation", "rain", "snowfall", "weathercode",
                                                 "windspeed_10m", "relativehumidity_2m"))).write.parquet(path("w"))
    read = spark.read.parquet
    built, counts = silver.build_counted(spark, path("bronze"), manifest, read(path("grid")), read(path("w")), path("s"))
    ends = {r[0]: r[1] for r in built.groupBy("vehicle_type").agg(
        F.count("pickup_zone_id") + F.count("dropoff_zone_id")).collect()}
    by_id, by_cell = ends["green"], ends["yellow"]  # only the yellow file has coordinates
    assert by_id and by_cell and counts == {
        "rows_in": 6, "rows_out": 6, "ends_by_id": by_id, "ends_by_cell": by_cell,
        "ends_unresolved": 12 - by_id - by_cell, "hours_matched": built.filter("temperature_2m is not null").count()}
    _, of_type = silver.build_counted(
        spark, path("bronze"), manifest, read(path("grid")), read(path("w")), path("s"), types=["green", "yellow"])
    assert of_type == counts


def test_a_compaction_that_broke_off_is_finished_by_the_next_write(spark, path, monkeypatch):
    df = spark.range(400).selectExpr("id", "id % 2 as k").repartition(8)
    real, calls = tables._write, []

    def fail_at(n):
        def write(frame, to, *rest):
            calls.append(to)
            if len(calls) == n:
                raise RuntimeError("lost the driver")
            return real(frame, to, *rest)
        return write

    for n, left in ((2, False), (3, True)):  # in the copy beside the table; when it is put in place
        table = path(f"t{n}")
        calls.clear()
        with monkeypatch.context() as patch:
            patch.setattr(tables, "_write", fail_at(n))
            with pytest.raises(RuntimeError):
                tables.write_partitioned(df, table, ["k"], in_place=True)
        assert os.path.exists(f"{table}__compact/_SUCCESS") == left
        if left:  # the worst case: the partition has gone, and only the copy is whole
            os.rename(f"{table}/k=0", path("gone"))
        assert tables.repair(spark, table, ["k"]) == left
        assert spark.read.parquet(table).count() == 400 and not os.path.exists(f"{table}__compact")
        assert not tables.repair(spark, table, ["k"])


@pytest.mark.parametrize("name", ["silver_trips", "silver_rides", "weather_join", "grid_resolve", "zone_coalesce",
                                  "price_quantiles", "trips_in_eligible_zones"])
def test_no_job_runs_while_a_query_is_built(spark, name):
    opened = Tables(spark, DATA)
    for table in ("lineitem", "orders", "part", "events", "nation", "supplier"):
        getattr(opened, table)  # reading a schema is a job
    context = spark.sparkContext
    context.setJobGroup(f"build-{name}", "")
    _QUERIES[name](opened)
    context.setJobGroup("other", "")
    assert not context.statusTracker().getJobIdsForGroup(f"build-{name}")
