from pyspark.sql import functions as F

from helpers import rows
from tripmart.functions import (
    cell_index,
    hour_of,
    in_hash_fraction,
    mean,
    minutes_between,
    percent_gap,
    price_per_km,
    valid_price,
    weather_bucket,
)


def stamps(spark, *pairs):
    text = spark.createDataFrame([p for p in pairs], "a string, b string")
    return text.select(F.to_timestamp_ntz("a").alias("a"), F.to_timestamp_ntz("b").alias("b"))


def test_minutes_are_wall_clock_in_every_session_zone(spark, zoned):
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        zoned(zone)
        df = stamps(
            spark,
            ("2019-03-10 01:30:00", "2019-03-10 03:30:00"),  # spring forward inside
            ("2019-11-03 00:30:00", "2019-11-03 02:30:00"),  # fall back inside
            ("2019-01-01 10:00:00", "2019-01-01 09:45:00"),  # dropoff first
            ("2019-01-01 10:00:00.900", "2019-01-01 10:01:00.100"),  # sub-seconds floored
            ("1969-12-31 23:59:30", "1970-01-01 00:00:30"),
            (None, "2019-01-01 00:00:00"),
        )
        got = [r[0] for r in df.select(minutes_between(F.col("a"), F.col("b"))).collect()]
        assert got == [120.0, 120.0, -15.0, 1.0, 1.0, None]


def test_hour_survives_a_gap_in_the_session_zone(spark, zoned):
    zoned("America/New_York")
    df = stamps(spark, ("2019-03-10 02:30:59.5", None), (None, None))
    got = df.select(hour_of(F.col("a")).cast("string")).collect()
    assert [r[0] for r in got] == ["2019-03-10 02:00:00", None]


def test_cell_index_uses_integers_and_drops_garbage(spark):
    df = spark.createDataFrame(
        [(-73.978,), (40.7,), (-73.97851,), (1e300,), (float("nan"),), (None,)], "x double"
    )
    got = [r[0] for r in df.select(cell_index(F.col("x"))).collect()]
    assert got == [-73978, 40700, -73979, None, None, None]


def test_price_per_km_needs_a_positive_number(spark):
    df = spark.createDataFrame(
        [(16.0934, 1.0), (10.0, 0.0), (10.0, -1.0), (10.0, None), (10.0, float("nan")), (None, 1.0)],
        "total double, miles double",
    )
    got = [r[0] for r in df.select(price_per_km(F.col("total"), F.col("miles"))).collect()]
    assert abs(got[0] - 10.0) < 1e-12
    assert got[1:] == [None] * 5


def test_valid_price_is_an_open_interval(spark):
    df = spark.createDataFrame(
        [(0.0,), (0.01,), (49.99,), (50.0,), (-1.0,), (float("nan"),), (None,)], "p double"
    )
    kept = df.filter(valid_price(F.col("p"))).collect()
    assert [r.p for r in kept] == [0.01, 49.99]


def test_mean_ignores_null_and_handles_no_values(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (1, 2.0), (2, None)], "k int, v double")
    assert rows(df.groupBy("k").agg(mean(F.col("v")).alias("m"))) == [(1, 1.5), (2, None)]


def test_percent_gap(spark):
    df = spark.createDataFrame([(15.0, 10.0), (5.0, 10.0), (1.0, 0.0)], "a double, b double")
    got = [r[0] for r in df.select(percent_gap(F.col("a"), F.col("b"))).collect()]
    assert got == [50.0, -50.0, None]


def test_weather_bucket_precedence_and_edges(spark):
    cases = [
        # snowfall, precipitation, wind, expected
        (0.1, 5.0, 60.0, "neige"),
        (0.0, 2.1, 60.0, "pluie_forte"),
        (0.0, 2.0, 60.0, "pluie_legere"),
        (0.0, 0.1, 10.0, "pluie_legere"),
        (0.0, 0.0, 40.1, "vent_fort"),
        (0.0, 0.0, 40.0, "normal"),
        (None, 3.0, 10.0, "pluie_forte"),
        (None, None, 41.0, "vent_fort"),
        (None, None, None, "normal"),
    ]
    df = spark.createDataFrame(
        cases, "snowfall double, precipitation double, windspeed_10m double, want string"
    )
    got = df.select(weather_bucket().alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_hash_fraction_edges(spark):
    df = spark.range(20_000)
    keys = [F.col("id")]
    assert df.filter(in_hash_fraction(keys, 0.0, 42)).count() == 0
    assert df.filter(in_hash_fraction(keys, 1.0, 42)).count() == 20_000
    share = df.filter(in_hash_fraction(keys, 0.25, 42)).count() / 20_000
    assert abs(share - 0.25) < 0.02
    # A larger fraction keeps what a smaller one kept.
    small = df.filter(in_hash_fraction(keys, 0.1, 42))
    assert small.filter(in_hash_fraction(keys, 0.25, 42)).count() == small.count()
    other = df.filter(in_hash_fraction(keys, 0.1, 43))
    assert other.join(small, "id").count() < small.count()
