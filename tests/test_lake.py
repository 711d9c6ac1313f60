"""Source files to silver and the reports, on files with drifting schemas."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import lake
from helpers import rows
from tripmart.contracts import PARTITION_KEYS, SURCHARGES, flag_of
from tripmart.operators import ingest
from tripmart.plans import gold, landing, rides, silver, surcharges, weather_prices
from tripmart.sources.bronze import eras
from tripmart.sources.listing import list_month_files, list_partition_files, rows_per_file
from tripmart.sources.tables import read_table, scattered, write_partitioned

SCOPE = {"years": (2016, 2019), "months": (1, 2)}


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.near, self.far, self.counts = lake.sources(root)
        self.bronze, self.manifest_path = f"{root}/bronze/trips", f"{root}/bronze/manifest"
        self.silver = f"{root}/silver/trips"

    def ingest(self, **options):
        return dict(rows(landing.ingest_trips(
            self.spark, list_month_files(self.spark, self.near),
            list_month_files(self.spark, self.far),
            self.bronze, self.manifest_path, **{**SCOPE, **options},
        )))

    def manifest(self):
        return landing.open_manifest(self.spark, self.manifest_path)


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    """A lake taken all the way to silver, once for the module."""
    root = str(tmp_path_factory.mktemp("lake"))
    it = Lake(spark, root)
    it.outcome = it.ingest()
    lake.weather(f"{root}/json")
    it.weather_outcome = landing.ingest_weather(
        spark, f"{root}/json", f"{root}/bronze/weather", f"{root}/wm")
    it.weather = silver.build_silver_weather(spark, f"{root}/bronze/weather", f"{root}/silver/w")
    it.grid = spark.createDataFrame(
        [(-73995, 40705, 161), (-73995, 40705, 170)],
        "grid_lon_idx bigint, grid_lat_idx bigint, LocationID int",
    )
    it.trips = silver.build_silver_trips(
        spark, it.bronze, it.manifest(), it.grid, it.weather, it.silver
    )
    return it


def test_listing_reads_names_in_any_layout(full, spark):
    near = rows(list_month_files(spark, full.near).select(*PARTITION_KEYS))
    assert ("yellow", 2016, 1) in near and ("fhvhv", 2019, 1) in near and len(near) == 7
    assert rows(list_month_files(spark, full.far).select(*PARTITION_KEYS)) == [
        ("fhvhv", 2019, 2), ("green", 2019, 1)]


def test_outcome_counts_every_month_in_scope(full):
    # yellow, green, fhv: 4 months each; fhvhv: only 2019-02.
    assert full.outcome == {"ingested": 7, "not_published": 6}


def test_manifest_rows(full):
    got = {tuple(r[:3]): (r.row_count, r.source) for r in full.manifest().select(
        *PARTITION_KEYS, "row_count", "source").collect()}
    assert {k: v[0] for k, v in got.items()} == full.counts
    assert got["green", 2019, 1][1].startswith("primary:")
    assert got["fhvhv", 2019, 2][1].startswith("fallback:")


def test_absent_columns_stay_absent_in_bronze(full, spark):
    base = f"{full.bronze}/vehicle_type=yellow"
    early = spark.read.parquet(f"{base}/year=2016/month=1").columns
    late = spark.read.parquet(f"{base}/year=2019/month=2").columns
    assert "congestion_surcharge" not in early and "PULocationID" not in early
    assert "cbd_congestion_fee" in late and "Airport_fee" in late


def test_bronze_keeps_every_row(full, spark):
    files = list_partition_files(spark, full.bronze)
    assert rows(files.select(*PARTITION_KEYS).distinct()) == sorted(full.counts, key=repr)
    counted = rows_per_file(spark.read.parquet(full.bronze)).agg(F.sum("row_count")).first()[0]
    assert counted == sum(full.counts.values())


def test_one_scan_per_era_not_per_file(full):
    found = eras(full.manifest())
    assert len(found) == 6  # the two 2016 files share one
    assert sorted(len(e.locations) for e in found) == [1, 1, 1, 1, 1, 2]


def test_second_run_lands_nothing(full):
    before = full.manifest().count()
    assert full.ingest() == {"skipped": 7, "not_published": 6}
    assert full.manifest().count() == before


def test_silver_keeps_every_trip(full):
    assert full.trips.count() == sum(full.counts.values())
    per_type = dict(rows(full.trips.groupBy("vehicle_type").count()))
    assert per_type == {"yellow": 10, "green": 2, "fhv": 3, "fhvhv": 2}
    assert full.trips.select("source_file", "source_row").distinct().count() == 17


def test_silver_columns_and_types(full):
    kinds = dict(full.trips.dtypes)
    assert kinds["pickup_datetime"] == kinds["pickup_hour_ts"] == "timestamp_ntz"
    assert kinds["pickup_zone_id"] == kinds["dropoff_zone_id"] == "int"
    assert kinds["weathercode"] == "bigint" and kinds["year"] == kinds["month"] == "int"
    assert "pickup_longitude" not in kinds and "pu_location_id" not in kinds
    assert "relativehumidity_2m" not in kinds
    assert "void" not in kinds.values()


def test_silver_zones(full):
    gps = full.trips.filter("vehicle_type = 'yellow' and source_file like '%/2016/%'")
    assert rows(gps.groupBy("pickup_zone_id", "dropoff_zone_id").count()) == [
        (161, 161, 2), (None, 161, 4)]
    assert rows(full.trips.filter("vehicle_type = 'fhv'").select("pickup_zone_id")) == [
        (40,), (41,), (None,)]


def test_silver_flags_follow_the_file(full):
    flags = full.trips.groupBy("vehicle_type", F.year("pickup_datetime").alias("y")).agg(
        *[F.max(flag_of(s)).alias(s) for s in SURCHARGES])
    got = {(r.vehicle_type, r.y): tuple(r[s] for s in SURCHARGES) for r in flags.collect()}
    assert got["yellow", 2016] == (True, False, False, False)
    assert got["yellow", 2019] == (True, True, True, True)
    assert got["fhv", 2019] == (False, False, False, False)
    assert got["fhvhv", 2019] == (False, True, True, False)
    # The column was there in 2019-01 but never filled: missing, not absent.
    fee = full.trips.filter("vehicle_type = 'yellow' and year = 2019 and month = 1")
    assert rows(fee.select("airport_fee", "airport_fee_disponible").distinct()) == [(None, True)]
    for s in SURCHARGES:
        assert full.trips.filter(~F.col(flag_of(s)) & F.col(s).isNotNull()).isEmpty()


def test_silver_partitions_follow_the_pickup_time(full, spark):
    got = rows(full.trips.filter("vehicle_type = 'yellow'").groupBy("year", "month").count())
    assert got == [
        (2015, 12, 1), (2016, 1, 2), (2016, 2, 2), (2019, 1, 3), (2019, 2, 1), (None, None, 1)]


def test_silver_measures(full):
    gps = full.trips.filter("source_file like 'yellow/2016/1/%'").orderBy("source_row")
    got = gps.select("price_per_km", "trip_duration_min").collect()
    assert abs(got[0].price_per_km - 10.0) < 1e-9
    assert [r.price_per_km for r in got[1:]] == [None, None, None]  # zero, NULL, NaN miles
    assert [r.trip_duration_min for r in got[:3]] == [120.0, 30.0, None]


def test_silver_weather_once_per_hour(full):
    assert full.weather.count() == 6  # bronze keeps the repeated hour
    hit = full.trips.filter("pickup_hour_ts = timestamp_ntz'2019-01-05 10:00:00'")
    assert rows(hit.groupBy("vehicle_type", "temperature_2m").count()) == [
        ("fhv", 5.0, 3), ("yellow", 5.0, 2)]
    missing = full.trips.filter("pickup_hour_ts = timestamp_ntz'2019-01-05 11:00:00'")
    assert rows(missing.select("temperature_2m")) == [(None,)]


def test_weather_bronze_has_all_variables(full, spark):
    bronze = silver.bronze_weather(spark, f"{full.root}/bronze/weather")
    assert bronze.columns[0] == "datetime_local" and len(bronze.columns) == 8
    assert bronze.filter("relativehumidity_2m = 50.0").count() == 6


def test_weather_lands_once(full, spark):
    again = landing.ingest_weather(
        spark, f"{full.root}/json", f"{full.root}/bronze/weather", f"{full.root}/wm")
    assert rows(full.weather_outcome) == [("ingested", 3)]
    assert rows(again) == [("skipped", 3)]
    marks = landing.open_manifest(spark, f"{full.root}/wm", landing.WEATHER_MANIFEST_SCHEMA)
    assert rows(marks.select("year", "month", "row_count", "source")) == [
        (2016, 1, 2, "weather_2016-01.json"), (2019, 1, 3, "weather_2019-01.json"),
        (2019, 2, 1, "weather_2019-02.json")]


def test_weather_months_with_other_types(spark, path):
    """Codes with a gap are doubles in their month; a variable may lack altogether."""
    for month, code, more in ((1, pa.array([61, 3]), {}),
                              (2, pa.array([61.0, None]), {"rain": pa.array([0.5, 1.0])})):
        hours = [lake.at(f"2019-{month:02d}-01 0{h}:00:00") for h in (0, 1)]
        lake.put_table(f"{path('b')}/year=2019/month={month:02d}/weather.parquet", {
            "datetime_local": pa.array(hours, lake.TIME), "weathercode": code, **more})
    got = silver.bronze_weather(spark, path("b"))
    assert dict(got.dtypes)["weathercode"] == "bigint" and len(got.columns) == 8
    assert rows(got.select("weathercode", "rain")) == [
        (3, None), (61, 0.5), (61, None), (None, 1.0)]
    with pytest.raises(ValueError):
        silver.bronze_weather(spark, path("nowhere"))


def test_weather_scope_limit_and_force(spark, path):
    lake.weather(path("json"))
    scope = ingest.calendar_months(spark, (2019, 2016), (1, 3))

    def run(**options):
        return dict(rows(landing.ingest_weather(
            spark, path("json"), path("bronze"), path("marks"), scope, **options)))

    assert run(limit=2) == {"ingested": 2}  # 2019-01 and 2019-02
    assert run(limit=4) == {"skipped": 2, "not_published": 1, "ingested": 1}
    assert run() == {"skipped": 3, "not_published": 3}
    assert run(force=True) == {"ingested": 3, "not_published": 3}
    assert silver.bronze_weather(spark, path("bronze")).count() == 6


def test_missing_source_folder_means_nothing_published(spark, path):
    nowhere = list_month_files(spark, path("nowhere"))
    assert nowhere.isEmpty()
    got = landing.ingest_trips(
        spark, nowhere, None, path("bronze"), path("manifest"), years=(2016,), months=(1, 1))
    assert rows(got) == [("not_published", 3)]


def test_reports_from_silver(full):
    heat = rides.rides_by_dow_hour(full.trips)
    assert heat.agg(F.sum("nb_courses")).first()[0] == 16  # one trip has no pickup time
    evolution = surcharges.surcharge_evolution(full.trips)
    one = evolution.filter(
        "vehicle_type = 'yellow' and year = 2019 and month = 1 "
        "and supplement = 'congestion_surcharge'").first()
    assert (one.montant_moyen, one.montant_total, one.nb_courses) == (1.25, 2.5, 3)
    gap = weather_prices.price_by_weather(full.trips)
    assert {r.weather_bucket for r in gap.collect()} == {
        "neige", "vent_fort", "pluie_legere", "normal"}


def test_stored_reports(full, spark, path):
    zones = spark.createDataFrame(
        [(z, "A" if z < 50 else "B") for z in (10, 11, 12, 20, 40, 50, 51, 161)],
        "LocationID int, Borough string")
    got = gold.build_surcharges(spark, full.trips, path("s"))
    assert rows(got) == rows(surcharges.surcharge_evolution(full.trips).select(*got.columns))
    by_zone, by_borough = gold.build_flows(spark, full.trips, zones, path("fz"), path("fb"))
    both = full.trips.filter("pickup_zone_id is not null and dropoff_zone_id is not null")
    for table in (by_zone, by_borough):
        assert table.agg(F.sum("nb_courses")).first()[0] == both.count()
    sample, size = gold.build_price_sample(
        spark, full.trips, path("p"), minimum=2, fraction=1.0, years=(2016, 2019))
    assert size == sample.count() == full.trips.filter(
        "price_per_km > 0 and price_per_km < 50 and pickup_zone_id in (161, 50, 30, 10)"
    ).groupBy("pickup_zone_id").count().filter("count >= 2").agg(F.sum("count")).first()[0]
    heat = gold.build_rides(spark, full.trips, path("h"))
    assert heat.agg(F.sum("nb_courses")).first()[0] == 16
    gap = gold.build_price_by_weather(spark, full.trips, path("w"))
    assert gap.count() == weather_prices.price_by_weather(full.trips).count() > 0


def test_silver_write_scans_each_era_once_without_a_shuffle(full, spark):
    sources = silver.bronze_sources(spark, full.bronze, full.manifest())
    trips = silver.silver_trips(sources, full.grid, full.weather)
    plan = trips._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") - plan.count("datetime_local") // 99 >= len(sources)
    files = [r for r in trips.inputFiles() if "/bronze/trips/" in r]
    assert len(files) == len(set(files)) and "RebalancePartitions" not in plan.split("Join")[0]
    assert len({(r.source_file, r.source_row) for r in full.trips.collect()}) == 17


def test_scattered_partitions_are_put_together(spark, path):
    df = spark.range(400).selectExpr("id", "id % 2 as k").repartition(8)
    write_partitioned(df.filter("k = 0 or id < 40"), path("t"), ["k"], in_place=True)
    assert scattered(spark, path("t")) == [] and not os.path.exists(path("t") + "__compact")
    assert rows(spark.read.parquet(path("t")).groupBy("k").count()) == [(0, 200), (1, 20)]


def test_inventory_without_a_manifest(full, spark):
    """A bronze table laid out by others gives the same silver."""
    manifest = landing.manifest_of_existing(spark, full.bronze, marked_only=False)
    assert {tuple(r[:3]): r.row_count for r in manifest.select(
        *PARTITION_KEYS, "row_count").collect()} == full.counts
    sources = silver.bronze_sources(spark, full.bronze, manifest)
    assert len(sources) == 6
    assert silver.silver_trips(sources, full.grid, full.weather).count() == 17


def test_inventory_from_markers(spark, path):
    """Padded folders, one file and one marker per month; unmarked months do not count."""
    root = path("bronze")
    for month, marked in ((1, True), (2, False), (3, True)):
        folder = f"{root}/vehicle_type=green/year=2019/month={month:02d}"
        lake.write(folder, "green", 2019, month,
                   lake.green([f"2019-{month:02d}-05 08:00:00"] * month), nested=False)
        if marked:
            with open(f"{folder}/_SUCCESS", "w") as handle:
                handle.write('{"source": "local:x", "row_count": 9, '
                             '"ingested_at": "2025-01-02T03:04:05.000006+00:00"}')
    manifest = landing.manifest_of_existing(spark, root)
    assert rows(manifest.select("month", "source", "row_count", "location")) == [
        (1, "local:x", 1, "vehicle_type=green/year=2019/month=01"),
        (3, "local:x", 3, "vehicle_type=green/year=2019/month=03")]
    assert str(manifest.select(F.date_format("ingested_at", "yyyy-MM-dd HH:mm")).first()[0]) == (
        "2025-01-02 03:04")
    ((kind, frame),) = silver.bronze_sources(spark, root, manifest)
    assert (kind, frame.count()) == ("green", 4)


def test_weather_inventory_from_markers(full, spark, path):
    every = landing.weather_manifest_of_existing(
        spark, f"{full.root}/bronze/weather", marked_only=False)
    assert rows(every.select("year", "month", "row_count", "source")) == [
        (2016, 1, 2, "existing"), (2019, 1, 3, "existing"), (2019, 2, 1, "existing")]
    assert landing.weather_manifest_of_existing(spark, f"{full.root}/bronze/weather").isEmpty()


def test_month_with_two_schemas_is_scanned_by_file(spark, path):
    root = path("bronze")
    base = f"{root}/vehicle_type=yellow/year=2019/month=01"
    for name, columns in (("a", lake.yellow_loc(["2019-01-05 10:00:00"])),
                          ("b", lake.yellow_gps(["2019-01-05 10:00:00"]))):
        lake.write(f"{base}-{name}", "yellow", 2019, 1, columns, nested=False)
        spark.read.parquet(f"{base}-{name}").write.mode("append").parquet(base)
    # Only the padded folder itself is a partition; the scratch folders are not.
    manifest = landing.manifest_of_existing(spark, root, marked_only=False)
    assert manifest.count() == 2
    found = silver.bronze_sources(spark, root, manifest)
    trips = silver.union_eras([silver.harmonize(f, k) for k, f in found])
    assert rows(trips.select("pu_location_id", "airport_fee_disponible")) == [
        (10, True), (None, False)]


def test_force_limit_and_replacement(spark, path):
    it = Lake(spark, path("lake"))
    assert it.ingest(limit=3) == {"ingested": 3}  # yellow 2016-01, 2016-02, 2019-01
    # The limit counts months already there, so nothing new is reached ...
    assert it.ingest(limit=3) == {"skipped": 3}
    # ... unless only new months count.
    assert it.ingest(limit_new=1) == {"skipped": 3, "ingested": 1}
    assert it.manifest().count() == 4
    assert it.ingest(limit=2, force=True) == {"ingested": 2}
    assert it.manifest().count() == 6
    latest = ingest.latest_entries(it.manifest())
    assert latest.count() == 4
    got = spark.read.parquet(it.bronze + "/vehicle_type=yellow/year=2016/month=1").count()
    assert got == 4  # replaced, not doubled


def test_crash_before_marking_is_repaired_by_the_next_run(spark, path, monkeypatch):
    it = Lake(spark, path("lake"))

    def crash(*args):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(landing, "append_manifest", crash)
        with pytest.raises(RuntimeError):
            it.ingest()
    assert it.manifest().isEmpty()
    assert it.ingest() == {"ingested": 7, "not_published": 6}
    total = sum(it.counts.values())
    assert rows_per_file(spark.read.parquet(it.bronze)).agg(F.sum("row_count")).first()[0] == total


def test_rebuild_of_some_types_leaves_the_others(full, spark, path):
    def build(manifest, **options):
        return silver.build_silver_trips(
            spark, full.bronze, manifest, full.grid, full.weather, path("silver"), **options)

    assert build(full.manifest()).count() == 17
    assert build(full.manifest(), types=["green", "fhv"]).count() == 17
    assert build(full.manifest().filter("vehicle_type = 'green'")).count() == 2


def test_empty_manifest_fails(full, spark):
    nothing = full.manifest().filter("false")
    with pytest.raises(ValueError):
        silver.build_silver_trips(
            spark, full.bronze, nothing, full.grid, full.weather, full.root + "/none")
