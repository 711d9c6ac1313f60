"""Zone outlines to grid cells by scanline filling.

Grid nodes and outlines are never joined.  Each outline edge yields its crossings
with the grid rows it spans; along a row, the space between an odd crossing and the
next one is inside.  The work is proportional to the outline length plus the nodes
found, and one row of one zone is the largest group ever sorted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.contracts import GRID_RESOLUTION, LAT_MAX, LAT_MIN, LON_MAX, LON_MIN
from tripmart.operators.zones import one_zone_per_cell


@dataclass(frozen=True)
class GridSpec:
    """Node lattice: every multiple of ``resolution`` in the half-open box."""

    resolution: float = GRID_RESOLUTION
    lon_min: float = LON_MIN
    lon_max: float = LON_MAX
    lat_min: float = LAT_MIN
    lat_max: float = LAT_MAX

    def columns(self) -> tuple[int, int]:
        return self._span(self.lon_min, self.lon_max)

    def rows(self) -> tuple[int, int]:
        return self._span(self.lat_min, self.lat_max)

    def _span(self, low: float, high: float) -> tuple[int, int]:
        return round(low / self.resolution), round(high / self.resolution) - 1


def _edges(rings: DataFrame) -> DataFrame:
    """(LocationID, x1, y1, x2, y2) for each side of each ring."""
    ring = F.col("ring")
    closed = F.concat(ring, F.slice(ring, 1, 1))
    ends = F.arrays_zip(ring.alias("a"), F.slice(closed, F.lit(2), F.size(ring)).alias("b"))
    return (
        rings.filter(F.size("ring") > 2)
        .select("LocationID", F.explode(ends).alias("e"))
        .select(
            "LocationID",
            F.col("e.a.x").alias("x1"),
            F.col("e.a.y").alias("y1"),
            F.col("e.b.x").alias("x2"),
            F.col("e.b.y").alias("y2"),
        )
    )


def _nodes_on_outline(edges: DataFrame, spec: GridSpec) -> DataFrame:
    """Nodes lying exactly on a corner or on a level side.

    Such nodes are no crossings for the fill, yet they are not within the zone.
    """
    step = F.lit(spec.resolution)
    row = F.round(F.col("y1") / step)
    first = F.ceil(F.least("x1", "x2") / step)
    last = F.floor(F.greatest("x1", "x2") / step)
    level = edges.filter((F.col("y1") == F.col("y2")) & (row * step == F.col("y1")))
    along = level.filter(first <= last).select(
        "LocationID",
        row.cast("bigint").alias("grid_lat_idx"),
        F.explode(F.sequence(first, last)).alias("grid_lon_idx"),
    )
    column = F.round(F.col("x1") / step)
    corners = edges.filter(
        (row * step == F.col("y1")) & (column * step == F.col("x1"))
    ).select(
        "LocationID",
        row.cast("bigint").alias("grid_lat_idx"),
        column.cast("bigint").alias("grid_lon_idx"),
    )
    return along.unionByName(corners)


def nodes_within_zones(rings: DataFrame, spec: GridSpec = GridSpec()) -> DataFrame:
    """Every (grid_lon_idx, grid_lat_idx, LocationID) with the node inside the zone.

    Nodes on an outline are not inside.  A node in two overlapping zones appears
    once for each.
    """
    step = F.lit(spec.resolution)
    edges = _edges(rings)

    # A side owns the rows from its lower end up to, not including, its upper end:
    # two sides meeting in a corner then share no row and leave none out.
    bottom, top = spec.rows()
    first = F.greatest(F.ceil(F.least("y1", "y2") / step), F.lit(bottom).cast("bigint"))
    last = F.least(F.ceil(F.greatest("y1", "y2") / step) - 1, F.lit(top).cast("bigint"))
    crossings = (
        edges.filter((F.col("y1") != F.col("y2")) & (first <= last))
        .select("*", F.explode(F.sequence(first, last)).alias("grid_lat_idx"))
        .select(
            "LocationID",
            "grid_lat_idx",
            (
                F.col("x1")
                + (F.col("grid_lat_idx") * step - F.col("y1"))
                * (F.col("x2") - F.col("x1"))
                / (F.col("y2") - F.col("y1"))
            ).alias("x"),
        )
    )
    along_row = Window.partitionBy("LocationID", "grid_lat_idx").orderBy("x")
    spans = crossings.select(
        "*",
        F.row_number().over(along_row).alias("n"),
        F.lead("x").over(along_row).alias("x_out"),
    ).filter(F.col("n") % 2 == 1)

    left, right = spec.columns()
    enter = F.greatest(F.floor(F.col("x") / step) + 1, F.lit(left).cast("bigint"))
    leave = F.least(F.ceil(F.col("x_out") / step) - 1, F.lit(right).cast("bigint"))
    filled = spans.filter(enter <= leave).select(
        F.explode(F.sequence(enter, leave)).alias("grid_lon_idx"),
        "grid_lat_idx",
        "LocationID",
    )
    return filled.join(
        _nodes_on_outline(edges, spec),
        ["grid_lon_idx", "grid_lat_idx", "LocationID"],
        "left_anti",
    )


def build_zone_grid(rings: DataFrame, spec: GridSpec = GridSpec()) -> DataFrame:
    """Grid lookup: one row per node that lies in a zone, lowest id on overlap."""
    return one_zone_per_cell(nodes_within_zones(rings, spec))
