"""Column expressions: everything here stays inside whole-stage codegen."""

from tripmart.functions.clock import hour_of, minutes_between, wall_seconds
from tripmart.functions.grid import cell_index
from tripmart.functions.hashing import in_hash_fraction
from tripmart.functions.measures import mean, percent_gap, price_per_km, valid_price
from tripmart.functions.weather import weather_bucket

__all__ = [
    "cell_index",
    "hour_of",
    "in_hash_fraction",
    "mean",
    "minutes_between",
    "percent_gap",
    "price_per_km",
    "valid_price",
    "wall_seconds",
    "weather_bucket",
]
