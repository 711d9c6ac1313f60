"""Counts of rows by keys and by parts of a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts of a time that rows can be counted by; weekday 1 is Sunday.
CALENDAR_PARTS = {
    "year": F.year,
    "month": F.month,
    "day_of_week": F.dayofweek,
    "hour_of_day": F.hour,
}


def count_by(
    rows: DataFrame, keys: Sequence[str | Column], weight: str | None = None, into: str = "nb_courses"
) -> DataFrame:
    """Rows of every combination of keys, or the sum of ``weight``, a count of rows itself."""
    amount = F.count("*") if weight is None else F.sum(weight)
    return rows.groupBy(*keys).agg(amount.alias(into))


def count_by_calendar(
    rows: DataFrame, at: str, parts: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Rows that have a time ``at``, by ``keys`` and the named parts of that time."""
    timed = rows.filter(F.col(at).isNotNull())
    return count_by(timed, [*keys, *(CALENDAR_PARTS[p](at).alias(p) for p in parts)])
