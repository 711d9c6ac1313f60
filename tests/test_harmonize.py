import pytest
from pyspark.sql import functions as F

from helpers import rows
from tripmart.contracts import SURCHARGES, TRIP_FIELDS, flag_of
from tripmart.operators.harmonize import (
    harmonize,
    has_coordinates,
    surcharge_states,
    union_eras,
)


def test_first_candidate_wins_and_case_is_ignored(spark):
    df = spark.range(1).select(
        F.lit(5.0).alias("PUlocationID"),
        F.lit(7.0).alias("dolocationid"),
        F.to_timestamp_ntz(F.lit("2019-01-01 00:10:00")).alias("dropOff_datetime"),
    )
    row = harmonize(df, "fhv").first()
    assert (row.pu_location_id, row.do_location_id) == (5, 7)
    assert str(row.dropoff_datetime) == "2019-01-01 00:10:00"
    assert row.vehicle_type == "fhv"


def test_missing_and_never_mapped_columns_are_typed_nulls(spark):
    out = harmonize(spark.range(1), "fhv")
    kinds = dict(out.dtypes)
    assert all(kinds[f.name] == f.type for f in TRIP_FIELDS)
    assert all(kinds[s] == "double" and kinds[flag_of(s)] == "boolean" for s in SURCHARGES)
    row = out.first()
    assert all(row[f.name] is None for f in TRIP_FIELDS)
    assert "void" not in kinds.values()


def test_fhvhv_total_is_the_base_fare(spark):
    df = spark.range(1).select(
        F.lit(12.5).alias("base_passenger_fare"), F.lit(3.0).alias("trip_miles"),
        F.lit(1.0).alias("tips"), F.lit(2.0).alias("tolls"),
    )
    row = harmonize(df, "fhvhv").first()
    assert (row.fare_amount, row.total_amount) == (12.5, 12.5)
    assert (row.trip_distance, row.tip_amount, row.tolls_amount) == (3.0, 1.0, 2.0)


def test_oldest_yellow_names(spark):
    df = spark.range(1).select(
        F.lit("2009-01-04 02:52:00").alias("Trip_Pickup_DateTime"),
        F.lit(-73.99).alias("Start_Lon"),
        F.lit(2.63).alias("Trip_Distance"),
        F.lit(9.4).alias("Total_Amt"),
    )
    row = harmonize(df, "yellow").first()
    assert str(row.pickup_datetime) == "2009-01-04 02:52:00"
    assert (row.pickup_longitude, row.trip_distance, row.total_amount) == (-73.99, 2.63, 9.4)


def test_unreadable_values_become_null_not_errors(spark):
    df = spark.createDataFrame(
        [("N/A", "x"), ("132", "4.5")], "PULocationID string, trip_distance string"
    )
    got = harmonize(df, "green").select("pu_location_id", "trip_distance")
    assert rows(got) == [(132, 4.5), (None, None)]


def test_absent_missing_zero_stay_apart_through_the_union(spark):
    without = spark.range(2).select(F.lit(1.0).alias("fare_amount"))
    having = spark.createDataFrame([(0.0,), (None,), (2.5,), (2.5,)], "Airport_fee double")
    trips = union_eras([harmonize(without, "yellow"), harmonize(having, "yellow")])
    got = trips.select("airport_fee", flag_of("airport_fee"))
    assert rows(got) == [
        (0.0, True), (2.5, True), (2.5, True), (None, False), (None, False), (None, True),
    ]
    states = surcharge_states(trips, ["vehicle_type"]).filter("supplement = 'airport_fee'")
    assert rows(states) == [("yellow", "airport_fee", 2, 1, 1, 2)]
    # A flag that is false always comes with a NULL value.
    for s in SURCHARGES:
        assert trips.filter(~F.col(flag_of(s)) & F.col(s).isNotNull()).isEmpty()


def test_alternate_surcharge_name(spark):
    df = spark.range(1).select(F.lit(0.75).alias("congestion_fee_cbd"))
    row = harmonize(df, "fhvhv").first()
    assert (row.cbd_congestion_fee, row.cbd_congestion_fee_disponible) == (0.75, True)


def test_union_of_bigint_and_double_ids_stays_int(spark):
    a = spark.range(1).select(F.lit(3).cast("bigint").alias("PULocationID"))
    b = spark.range(1).select(F.lit(4.0).alias("PULocationID"))
    trips = union_eras([harmonize(a, "yellow"), harmonize(b, "green")])
    assert dict(trips.dtypes)["pu_location_id"] == "int"
    assert sorted(r.pu_location_id for r in trips.collect()) == [3, 4]


def test_unknown_vehicle_type_fails(spark):
    with pytest.raises(ValueError):
        harmonize(spark.range(1), "bus")


def test_union_of_nothing_fails(spark):
    with pytest.raises(ValueError):
        union_eras([])


def test_coordinate_detection(spark):
    gps = spark.range(1).select(F.lit(1.0).alias("pickup_longitude"))
    assert has_coordinates(gps, "yellow")
    assert not has_coordinates(gps, "fhv")
    assert not has_coordinates(spark.range(1), "yellow")
