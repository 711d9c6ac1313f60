"""Prices, means and gaps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.contracts import KM_PER_MILE, MAX_PRICE_PER_KM


def price_per_km(total: Column, miles: Column) -> Column:
    """Total per kilometre; NULL unless the distance is a number above zero."""
    # NaN sorts above every number in Spark, so "> 0" alone would let it pass.
    return F.when((miles > 0) & ~F.isnan(miles), total / (miles * F.lit(KM_PER_MILE)))


def valid_price(price: Column, ceiling: float = MAX_PRICE_PER_KM) -> Column:
    """Strictly between zero and the ceiling (NULL and NaN fail)."""
    return price.isNotNull() & (price > 0) & (price < ceiling)


def mean(value: Column) -> Column:
    """Average of the non-NULL values as double.

    Sum over count rather than ``avg``: with decimal input the sum is exact and
    the result does not depend on the order in which partitions arrive.
    """
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def percent_gap(value: Column, base: Column) -> Column:
    return F.try_divide((value - base), base) * 100
