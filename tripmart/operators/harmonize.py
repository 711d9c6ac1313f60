"""Source columns of any era to one typed trip schema.

A surcharge has three states that must stay apart: the column did not exist in the
file (NULL, flag false), it existed without a value (NULL, flag true), it existed
with a value, zero included (value, flag true).  The flag is decided by the column
list of the input frame and is therefore a literal per era.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.contracts import (
    SURCHARGES,
    TRIP_FIELDS,
    WEATHER_VARIABLES,
    TripField,
    flag_of,
)


def _resolve(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    """Source column for the first candidate that exists, ignoring case."""
    known = {column.lower(): column for column in columns}
    present = [known[name.lower()] for name in candidates if name.lower() in known]
    return present[0] if present else None


def _typed(df: DataFrame, candidates: Iterable[str], kind: str) -> Column:
    """The column cast to its contract type, or a NULL of that type.

    ``try_cast``: one unreadable source value becomes NULL instead of ending the
    job, and every branch of the later union has the same type.
    """
    source = _resolve(df.columns, candidates)
    return (F.lit(None).cast(kind) if source is None else df[source].try_cast(kind))


def harmonize(
    df: DataFrame,
    vehicle_type: str,
    fields: Sequence[TripField] = TRIP_FIELDS,
    surcharges: Mapping[str, Sequence[str]] = SURCHARGES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Canonical trip columns, surcharges with flags, and the vehicle type."""
    if not any(vehicle_type in f.names for f in fields):
        raise ValueError(f"no source names for vehicle type {vehicle_type!r}")
    core = [
        _typed(df, f.names.get(vehicle_type, ()), f.type).alias(f.name) for f in fields
    ]
    extras = []
    for name, candidates in surcharges.items():
        exists = _resolve(df.columns, candidates) is not None
        extras.append(_typed(df, candidates, "double").alias(name))
        extras.append(F.lit(exists).alias(flag_of(name)))
    return df.select(
        F.lit(vehicle_type).alias("vehicle_type"),
        *core,
        *extras,
        *[df[column] for column in keep],
    )


def typed_weather(df: DataFrame) -> DataFrame:
    """Hourly weather with its contract types; a variable the months lack is NULL."""
    kinds = {"datetime_local": "timestamp_ntz", **WEATHER_VARIABLES}
    return df.select(*[_typed(df, (name,), kind).alias(name) for name, kind in kinds.items()])


def has_coordinates(df: DataFrame, vehicle_type: str) -> bool:
    """Whether a source frame carries any pickup or dropoff coordinate."""
    return any(
        _resolve(df.columns, f.names.get(vehicle_type, ())) is not None
        for f in TRIP_FIELDS
        if f.name.endswith(("_longitude", "_latitude"))
    )


def union_eras(frames: Sequence[DataFrame]) -> DataFrame:
    """All eras under each other, by name; a column missing in one is NULL there."""
    if not frames:
        raise ValueError("nothing in bronze: run the landing step first")
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), frames
    )


def surcharge_states(trips: DataFrame, keys: Sequence[str], surcharges=tuple(SURCHARGES)):
    """Rows per state of every surcharge: absent, missing, zero, charged.

    One pass with conditional counts; the small result is then unpivoted.
    """
    counts = []
    for name in surcharges:
        value, flag = F.col(name), F.col(flag_of(name))
        states = {
            "absent": ~flag,
            "missing": flag & value.isNull(),
            "zero": flag & (value == 0),
            "charged": flag & (value != 0),
        }
        counts += [F.count_if(test).alias(f"{name}__{s}") for s, test in states.items()]
    wide = trips.groupBy(*keys).agg(*counts)
    structs = F.array(*[
        F.struct(
            F.lit(name).alias("supplement"),
            *[F.col(f"{name}__{s}").alias(s) for s in ("absent", "missing", "zero", "charged")],
        )
        for name in surcharges
    ])
    return wide.select(*keys, F.inline(structs))
