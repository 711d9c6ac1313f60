"""Wall-clock arithmetic on ``timestamp_ntz`` columns.

Nothing here passes through a zoned timestamp, so neither the session time zone
nor a daylight-saving change can move a result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 on the wall clock (sub-seconds floored)."""
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from start to end; negative when end is earlier."""
    return (wall_seconds(end) - wall_seconds(start)) / F.lit(60.0)


def hour_of(ts: Column) -> Column:
    """Start of the wall-clock hour holding ``ts``.

    ``date_trunc`` would convert to a zoned timestamp and shift hours that do not
    exist in the session zone.
    """
    zero = F.lit(0)
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), zero, zero
    )
