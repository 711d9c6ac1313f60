"""Weather classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.contracts import CALM_BUCKET, WEATHER_BUCKETS


def weather_bucket(rules=WEATHER_BUCKETS, otherwise: str = CALM_BUCKET) -> Column:
    """First rule whose variable exceeds its limit; a NULL variable never does."""
    hits = [F.when(F.col(variable) > limit, label) for label, variable, limit in rules]
    return F.coalesce(*hits, F.lit(otherwise))
