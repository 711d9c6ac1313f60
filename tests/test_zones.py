import random

import pytest
from helpers import rows
from tripmart.operators.grid_fill import GridSpec, build_zone_grid, nodes_within_zones
from tripmart.operators.zones import one_zone_per_cell, resolve_zones, zone_cells

GRID = "grid_lon_idx bigint, grid_lat_idx bigint, LocationID int"
TRIPS = (
    "id int, pu_location_id int, do_location_id int, pickup_longitude double, "
    "pickup_latitude double, dropoff_longitude double, dropoff_latitude double"
)
RINGS = "LocationID int, ring array<struct<x:double,y:double>>"
UNIT = GridSpec(1.0, 0.0, 40.0, 0.0, 40.0)


@pytest.fixture
def grid(spark):
    return spark.createDataFrame(
        [(-73978, 40750, 9), (-73978, 40750, 4), (-73900, 40700, 7)], GRID
    )


@pytest.mark.parametrize("bound", [None, 0, 100])
def test_zones_come_from_the_id_first_then_the_cell(spark, grid, bound):
    trips = spark.createDataFrame(
        [
            (1, None, None, -73.978, 40.75, -73.9, 40.7),
            (2, 88, None, -73.978, 40.75, -73.9, 40.7),  # both: the id wins
            (3, None, 99, 0.0, 0.0, None, None),  # off the grid
            (4, None, None, 1e300, 40.75, float("nan"), 40.7),
            (5, None, None, -73.97849, 40.7504, -73.9004, 40.6996),  # same cells as 1
        ],
        TRIPS,
    )
    out = resolve_zones(trips, zone_cells(grid, bound))
    assert out.columns == ["id", "pickup_zone_id", "dropoff_zone_id"]
    assert rows(out) == [
        (1, 4, 7), (2, 88, 7), (3, None, 99), (4, None, None), (5, 4, 7),
    ]


def test_a_doubled_cell_does_not_multiply_trips(spark, grid):
    assert one_zone_per_cell(grid).count() == 2
    trips = spark.createDataFrame([(i, None, None, -73.978, 40.75, -73.978, 40.75)
                                   for i in range(50)], TRIPS)
    assert resolve_zones(trips, zone_cells(grid)).count() == 50


def test_without_a_grid_no_join_is_planned(spark):
    trips = spark.createDataFrame([(1, 5, None, None, None, None, None)], TRIPS)
    out = resolve_zones(trips, None)
    assert rows(out) == [(1, 5, None)]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def ring(*points):
    return [(float(x), float(y)) for x, y in points]


def even_odd(rings, x, y):
    """Brute force: strictly inside by ray casting, outline excluded."""
    inside = False
    for points in rings:
        for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1]):
            cross = (x - x1) * (y2 - y1) - (y - y1) * (x2 - x1)
            within = min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2)
            if (x1, y1) != (x2, y2) and cross == 0 and within:
                return False
            if (y1 <= y < y2) or (y2 <= y < y1):
                if x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                    inside = not inside
    return inside


def brute(zones, spec):
    left, right = spec.columns()
    bottom, top = spec.rows()
    return sorted(
        (i, j, zone)
        for zone, rings in zones.items()
        for i in range(left, right + 1)
        for j in range(bottom, top + 1)
        if even_odd(rings, i * spec.resolution, j * spec.resolution)
    )


def filled(spark, zones, spec):
    frame = spark.createDataFrame(
        [(zone, r) for zone, rings in zones.items() for r in rings], RINGS
    )
    return sorted(tuple(r) for r in nodes_within_zones(frame, spec).select(
        "grid_lon_idx", "grid_lat_idx", "LocationID").collect())


CASES = {
    "rectangle off the nodes": {1: [ring((2.5, 2.5), (9.5, 2.5), (9.5, 7.5), (2.5, 7.5), (2.5, 2.5))]},
    "rectangle on the nodes": {1: [ring((2, 2), (9, 2), (9, 7), (2, 7), (2, 2))]},
    "open ring": {1: [ring((2.5, 2.5), (9.5, 2.5), (9.5, 7.5), (2.5, 7.5))]},
    "corner on a node": {1: [ring((5, 2), (9.5, 8.5), (0.5, 8.5), (5, 2))]},
    "top corner on a node": {1: [ring((5, 9), (9.5, 2.5), (0.5, 2.5), (5, 9))]},
    "hole": {3: [
        ring((1.5, 1.5), (20.5, 1.5), (20.5, 20.5), (1.5, 20.5), (1.5, 1.5)),
        ring((5.5, 5.5), (9.5, 5.5), (9.5, 9.5), (5.5, 9.5), (5.5, 5.5)),
    ]},
    "hole with a corner on a node": {3: [
        ring((1.5, 1.5), (20.5, 1.5), (20.5, 20.5), (1.5, 20.5), (1.5, 1.5)),
        ring((10, 5), (12.5, 8.5), (7.5, 8.5), (10, 5)),
        ring((10, 18), (12.5, 14.5), (7.5, 14.5), (10, 18)),
    ]},
    "two parts": {4: [
        ring((1.5, 1.5), (4.5, 1.5), (4.5, 4.5), (1.5, 4.5), (1.5, 1.5)),
        ring((10.5, 1.5), (14.5, 1.5), (12.5, 9.5), (10.5, 1.5)),
    ]},
    "overlap": {
        5: [ring((1.5, 1.5), (9.5, 1.5), (9.5, 9.5), (1.5, 9.5), (1.5, 1.5))],
        2: [ring((6.5, 6.5), (14.5, 6.5), (14.5, 14.5), (6.5, 14.5), (6.5, 6.5))],
    },
    "beyond the grid": {6: [ring((-9.5, -9.5), (99.5, -9.5), (99.5, 5.5), (-9.5, 5.5), (-9.5, -9.5))]},
    "u shape": {7: [ring((1.5, 1.5), (15.5, 1.5), (15.5, 15.5), (11.5, 15.5), (11.5, 5.5),
                         (5.5, 5.5), (5.5, 15.5), (1.5, 15.5), (1.5, 1.5))]},
}


@pytest.mark.parametrize("name", CASES)
def test_fill_equals_brute_force(spark, name):
    assert filled(spark, CASES[name], UNIT) == brute(CASES[name], UNIT)


def test_fill_equals_brute_force_on_random_outlines(spark):
    rng = random.Random(7)
    zones = {}
    for zone in range(1, 21):
        points = [(rng.uniform(-5, 45), rng.uniform(-5, 45)) for _ in range(rng.randint(3, 9))]
        zones[zone] = [points + points[:1]]
    assert filled(spark, zones, UNIT) == brute(zones, UNIT)


def test_grid_keeps_the_lowest_zone_of_a_node(spark):
    zones = CASES["overlap"]
    frame = spark.createDataFrame([(z, r) for z, rs in zones.items() for r in rs], RINGS)
    got = {(r.grid_lon_idx, r.grid_lat_idx): r.LocationID
           for r in build_zone_grid(frame, UNIT).collect()}
    want = {}
    for i, j, zone in brute(zones, UNIT):
        want[i, j] = min(zone, want.get((i, j), zone))
    assert got == want


def test_default_lattice_has_the_documented_size():
    spec = GridSpec()
    (left, right), (bottom, top) = spec.columns(), spec.rows()
    assert (right - left + 1) * (top - bottom + 1) == 650 * 500


def test_default_lattice_round_trip(spark):
    """A coordinate inside a zone resolves to it through the grid."""
    zones = {42: [ring((-74.0005, 40.7005), (-73.9905, 40.7005), (-73.9905, 40.7105),
                       (-74.0005, 40.7105), (-74.0005, 40.7005))]}
    frame = spark.createDataFrame([(42, zones[42][0])], RINGS)
    grid = build_zone_grid(frame)
    assert grid.count() == 100
    trips = spark.createDataFrame([(1, None, None, -73.995, 40.705, -73.98, 40.705)], TRIPS)
    assert rows(resolve_zones(trips, zone_cells(grid))) == [(1, 42, None)]
