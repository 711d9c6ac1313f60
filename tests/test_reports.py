import math
import random
import statistics
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tripmart.contracts import SURCHARGES, flag_of
from tripmart.operators.weather_join import join_weather, one_row_per_hour
from tripmart.plans import flows, prices, rides, surcharges, weather_prices

PRICES = "pickup_zone_id int, year int, price_per_km double, source_file string, source_row bigint"


# --- flows -----------------------------------------------------------------


@pytest.fixture
def flow_trips(spark):
    data = [("yellow", 1, 2)] * 3 + [("yellow", 2, 2), ("green", 1, 2), ("green", 1, 9),
                                     ("yellow", None, 2), ("yellow", 1, None)]
    return spark.createDataFrame(
        data, "vehicle_type string, pickup_zone_id int, dropoff_zone_id int")


@pytest.fixture
def zones(spark):
    # Zone 9 has no row; id NULL comes from a malformed line and must join nothing.
    return spark.createDataFrame(
        [(1, "Bronx"), (2, "Queens"), (2, "Queens"), (None, "Nowhere")],
        "LocationID int, Borough string")


def test_flows_by_zone_need_both_ends(flow_trips):
    assert rows(flows.flows_by_zone(flow_trips)) == [
        ("green", 1, 2, 1), ("green", 1, 9, 1), ("yellow", 1, 2, 3), ("yellow", 2, 2, 1)]


@pytest.mark.parametrize("bound", [None, 0, 10])
def test_flows_by_borough_keep_unknown_zones(flow_trips, zones, bound):
    by_zone = flows.flows_by_zone(flow_trips)
    by_borough = flows.flows_by_borough(by_zone, zones, bound)
    assert rows(by_borough) == [
        ("green", "Bronx", "Queens", 1), ("green", "Bronx", None, 1),
        ("yellow", "Bronx", "Queens", 3), ("yellow", "Queens", "Queens", 1)]
    total = lambda df: df.agg(F.sum("nb_courses")).first()[0]
    assert total(by_zone) == total(by_borough) == 6


def test_flow_matrix_total_covers_unlisted_destinations(flow_trips, zones):
    by_borough = flows.flows_by_borough(flows.flows_by_zone(flow_trips), zones)
    matrix = flows.flow_matrix(by_borough, ["Queens", "Bronx"])
    assert matrix.columns == ["pickup_borough", "Queens", "Bronx", "other", "unknown", "total"]
    for r in matrix.collect():
        assert sum(r[1:-1]) == r.total
    assert rows(matrix.select("pickup_borough", "Queens", "Bronx", "total")) == [("Bronx", 4, 0, 5), ("Queens", 1, 0, 1)]


# --- surcharges ------------------------------------------------------------


@pytest.fixture
def surcharge_trips(spark):
    data = [
        # type, year, month, congestion, there
        ("yellow", 2019, 1, None, False),
        ("yellow", 2019, 1, None, False),
        ("yellow", 2019, 2, 2.5, True),
        ("yellow", 2019, 2, 0.0, True),
        ("yellow", 2019, 2, None, True),
        ("green", 2019, 2, None, True),
    ]
    df = spark.createDataFrame(
        data, "vehicle_type string, year int, month int, congestion_surcharge double, "
              "congestion_surcharge_disponible boolean")
    for s in SURCHARGES:
        if s != "congestion_surcharge":
            df = df.withColumn(s, F.lit(None).cast("double")).withColumn(flag_of(s), F.lit(False))
    return df


def test_surcharge_evolution(surcharge_trips):
    got = surcharges.surcharge_evolution(surcharge_trips)
    assert got.columns == ["vehicle_type", "year", "month", "supplement",
                           "montant_moyen", "montant_total", "nb_courses"]
    assert rows(got) == [
        ("green", 2019, 2, "congestion_surcharge", None, None, 1),
        ("yellow", 2019, 2, "congestion_surcharge", 1.25, 2.5, 3)]


def test_surcharge_evolution_scans_once(surcharge_trips, path):
    surcharge_trips.write.parquet(path("t"))
    stored = surcharge_trips.sparkSession.read.parquet(path("t"))
    plan = surcharges.surcharge_evolution(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_surcharge_availability(surcharge_trips):
    got = surcharges.surcharge_availability(surcharge_trips)
    assert rows(got.filter("supplement = 'congestion_surcharge'")) == [
        ("green", "congestion_surcharge", 1, 1, 1.0),
        ("yellow", "congestion_surcharge", 1, 2, 0.5)]
    assert got.filter("supplement = 'airport_fee' and share > 0").isEmpty()


# --- rides -----------------------------------------------------------------


def test_rides_and_heatmap(spark):
    data = [
        ("yellow", 2019, datetime(2019, 1, 6, 8, 59)),  # a Sunday
        ("yellow", 2019, datetime(2019, 1, 6, 8, 0)),
        ("green", 2019, datetime(2019, 1, 6, 8, 30)),
        ("yellow", 2019, datetime(2019, 1, 5, 23, 0)),  # a Saturday
        ("yellow", 2020, datetime(2020, 1, 1, 0, 0)),
        ("yellow", None, None),
    ]
    trips = spark.createDataFrame(
        data, "vehicle_type string, year int, pickup_datetime timestamp_ntz")
    got = rides.rides_by_dow_hour(trips)
    assert rows(got) == [
        ("green", 2019, 1, 8, 1), ("yellow", 2019, 1, 8, 2), ("yellow", 2019, 7, 23, 1),
        ("yellow", 2020, 4, 0, 1)]
    grid = rides.heatmap(got, 2019)
    assert grid.columns == ["day_of_week", *[f"h{h}" for h in range(24)]]
    by_day = {r.day_of_week: r for r in grid.collect()}
    assert set(by_day) == {1, 7}
    assert (by_day[1].h8, by_day[1].h9, by_day[7].h23) == (3, 0, 1)


def test_heatmap_prunes_to_one_year(spark, path):
    spark.createDataFrame(
        [("y", 2019, 1, 1, 5), ("y", 2020, 1, 1, 6)],
        "vehicle_type string, year int, day_of_week int, hour_of_day int, nb_courses bigint",
    ).write.partitionBy("year").parquet(path("heat"))
    grid = rides.heatmap(spark.read.parquet(path("heat")), 2019)
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert rows(grid.select("h1")) == [(5,)]


# --- weather ---------------------------------------------------------------


def test_repeated_hour_gives_one_whole_record(spark):
    hour = datetime(2019, 11, 3, 1)
    weather = spark.createDataFrame(
        [(hour, 5.0, 1.0), (hour, 4.0, 9.0), (hour, 4.0, None), (None, 0.0, 0.0)],
        "datetime_local timestamp_ntz, temperature_2m double, rain double")
    got = one_row_per_hour(weather, ["temperature_2m", "rain"])
    assert rows(got) == [(hour, 4.0, 9.0)]  # the least of the full records
    lone = one_row_per_hour(weather.filter("rain is null"), ["temperature_2m", "rain"])
    assert rows(lone) == [(hour, 4.0, None)]
    trips = spark.createDataFrame([(i, hour) for i in range(9)],
                                  "id int, pickup_hour_ts timestamp_ntz")
    for bound in (None, 0, 5):
        assert join_weather(trips, weather, ["temperature_2m", "rain"], bound).count() == 9


@pytest.fixture
def weather_trips(spark):
    data = [
        ("yellow", 10.0, 1.0, 0.0, 0.0, 0.0),
        ("yellow", 20.0, 1.0, 0.0, 5.0, 0.0),
        ("green", 30.0, 1.0, 0.0, 5.0, 0.0),
        ("green", 50.0, 1.0, 0.0, 5.0, 0.0),  # at the ceiling: out
        ("green", 0.0, 1.0, 0.0, 5.0, 0.0),
        ("green", None, 1.0, 0.0, 5.0, 0.0),
        ("green", 25.0, None, 0.0, 5.0, 0.0),  # no weather: out
    ]
    return spark.createDataFrame(
        data, "vehicle_type string, price_per_km double, temperature_2m double, "
              "snowfall double, precipitation double, windspeed_10m double")


def test_price_by_weather(weather_trips):
    got = weather_prices.price_by_weather(weather_trips)
    assert got.columns == ["vehicle_type", "weather_bucket", "prix_moyen_bucket", "nb_courses",
                           "prix_moyen_general", "ecart_pct"]
    assert rows(got) == [
        ("green", "pluie_forte", 30.0, 1, 20.0, 50.0),
        ("yellow", "normal", 10.0, 1, 20.0, -50.0),
        ("yellow", "pluie_forte", 20.0, 1, 20.0, 0.0)]
    weighted = sum(r.prix_moyen_bucket * r.nb_courses for r in got.collect())
    assert weighted / 3 == 20.0


def test_price_by_weather_of_nothing(weather_trips):
    assert rows(weather_prices.price_by_weather(weather_trips.filter("false"))) == []


# --- prices ----------------------------------------------------------------


@pytest.fixture
def priced(spark):
    rng = random.Random(3)
    data = []
    for zone, size in ((1, 900), (2, 300), (3, 40)):
        for i in range(size):
            # A hot price: a third of zone 1 has the very same value.
            price = 7.5 if zone == 1 and i % 3 == 0 else rng.uniform(0.01, 49.0)
            data.append((zone, rng.choice((2018, 2019, 2020)), price, f"f{zone}", i))
    data += [(1, 2019, 50.0, "x", 1), (1, 2019, 0.0, "x", 2), (1, 2019, None, "x", 3),
             (None, 2019, 5.0, "x", 4), (2, 1999, 5.0, "x", 5), (2, None, 5.0, "x", 6)]
    return spark.createDataFrame(data, PRICES)


def test_eligible_zones_count_usable_trips_of_all_years(priced):
    usable = prices.priced_trips(priced)
    assert rows(prices.zone_volumes(usable)) == [(1, 900), (2, 302), (3, 40)]
    assert rows(prices.eligible_zones(usable, 302)) == [(1, 900), (2, 302)]
    assert rows(prices.eligible_zones(usable, 303)) == [(1, 900)]


@pytest.mark.parametrize("bound", [None, 0, 10])
def test_trips_in_eligible_zones(priced, bound):
    usable = prices.priced_trips(priced)
    kept = prices.in_eligible_zones(usable, prices.eligible_zones(usable, 303), bound)
    assert kept.count() == 900 and kept.columns == usable.columns


def test_sample_does_not_depend_on_partitioning(priced):
    take = lambda df: rows(prices.price_sample(df, minimum=100, fraction=0.2))
    want = take(priced)
    assert take(priced.repartition(7)) == want
    assert take(priced.repartition("year").orderBy("price_per_km")) == want
    assert 0.12 * 1200 < len(want) < 0.28 * 1200
    assert {r[0] for r in want} == {1, 2}


def test_sample_has_every_year_unless_years_are_named(priced):
    got = prices.price_sample(priced, minimum=100, fraction=1.0)
    assert got.count() == 1202 and {1999, None} <= {r.year for r in got.collect()}
    later = prices.price_sample(priced.withColumn("year", F.lit(2027)), minimum=100, fraction=1.0)
    assert later.count() == 1202
    assert got.columns == ["pickup_zone_id", "year", "price_per_km"]
    few = prices.price_sample(priced, minimum=100, fraction=1.0, years=[2019])
    assert {r.year for r in few.collect()} == {2019}


def test_random_sample_has_about_the_right_size(priced):
    got = prices.price_sample_random(priced, minimum=100, fraction=0.5)
    assert 0.4 * 1200 < got.count() < 0.6 * 1200
    assert {r.pickup_zone_id for r in got.collect()} == {1, 2}


def test_histogram_keeps_every_row(priced):
    usable = prices.priced_trips(priced)
    got = prices.price_histogram(usable, 2.5)
    assert got.agg(F.sum("nb_courses")).first()[0] == usable.count()
    hot = got.filter("pickup_zone_id = 1 and bin = 3").agg(F.sum("nb_courses")).first()[0]
    assert hot >= 300


@pytest.mark.parametrize("width", [0.5, 10.0, 100.0])
@pytest.mark.parametrize("bound", [None, 10_000])
def test_quantiles_equal_brute_force(priced, width, bound):
    usable = prices.priced_trips(priced)
    asked = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = prices.price_quantiles(
        usable, prices.price_histogram(usable, width), asked, width, bound)
    groups = {}
    for r in usable.collect():
        groups.setdefault((r.pickup_zone_id, r.year), []).append(r.price_per_km)
    found = {(r.pickup_zone_id, r.year, r["quantile"]): r.price
             for r in got.filter("year is not null").collect()}
    for (zone, year), values in groups.items():
        if year is None:
            continue
        values.sort()
        for q in asked:
            at = q * (len(values) - 1)
            low, high = values[math.floor(at)], values[math.ceil(at)]
            want = low + (high - low) * (at - math.floor(at))
            assert found[zone, year, q] == pytest.approx(want, abs=1e-9)
        assert found[zone, year, 0.5] == pytest.approx(statistics.median(values), abs=1e-9)


def test_quantiles_keep_trips_without_a_year(priced):
    usable = prices.priced_trips(priced)
    got = prices.price_quantiles(usable, prices.price_histogram(usable, 5.0), [0.5], 5.0)
    assert rows(got.filter("year is null")) == [(2, None, 0.5, 5.0)]


def test_a_hot_bin_is_ranked_in_parts(spark):
    """Most distinct prices of one zone and year lie in one bin; no window task sees them all."""
    df = spark.range(60_000).selectExpr(
        "1 as pickup_zone_id", "2019 as year", "cast(10 + (id % 50000) / 60000D as double) as price_per_km")
    got = prices.price_quantiles(df, prices.price_histogram(df, 1.0), [0.25, 0.75], 1.0, split=64)
    values = sorted(10 + (k % 50000) / 60000.0 for k in range(60_000))
    for r in got.collect():
        at = r["quantile"] * (len(values) - 1)
        low, high = values[math.floor(at)], values[math.ceil(at)]
        assert r.price == pytest.approx(low + (high - low) * (at - math.floor(at)), abs=1e-9)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "part_of_bin" in [line for line in plan.splitlines() if "Window" in line and "inside" in line][0]


def test_no_job_over_trips_while_planning(priced, spark):
    spark.sparkContext.setJobGroup("planning", "planning")
    usable = prices.priced_trips(priced)
    prices.in_eligible_zones(usable, prices.eligible_zones(usable, 303), at_most=265)
    prices.price_quantiles(usable, prices.price_histogram(usable, 5.0), [0.5], 5.0, groups=1000)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
