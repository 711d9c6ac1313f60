"""Coordinates to integer grid cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.contracts import GRID_RESOLUTION


def cell_index(coordinate: Column, resolution: float = GRID_RESOLUTION) -> Column:
    """Nearest grid line of a coordinate, as bigint.

    Integers join exactly where rounded doubles would not.  A coordinate too large
    for a bigint is no place on the grid and gives NULL.
    """
    return F.round(coordinate / F.lit(resolution)).try_cast("bigint")
