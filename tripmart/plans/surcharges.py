"""How surcharges evolved, and since when each one exists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.contracts import SURCHARGES, flag_of


def _unpivot(names: Sequence[str], columns: dict[str, str]) -> Column:
    """One struct row per surcharge from the wide columns ``<surcharge>__<part>``."""
    return F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("supplement"),
            *[F.col(f"{name}__{part}").alias(out) for part, out in columns.items()],
        )
        for name in names
    ]))


def surcharge_sums(
    trips: DataFrame, surcharges: Sequence[str] = tuple(SURCHARGES), keys: Sequence[str] = ()
) -> DataFrame:
    """Per (type, year, month) and ``keys``: sum, filled values and trips of every surcharge.

    All surcharges are aggregated in one pass over the trips.  Such rows add up, over any
    parts of the trips.
    """
    parts = []
    for name in surcharges:
        charged = F.when(F.col(flag_of(name)), F.col(name))
        parts += [
            F.sum(charged).alias(f"{name}__sum"),
            F.count(charged).alias(f"{name}__filled"),
            F.count_if(F.col(flag_of(name))).alias(f"{name}__trips"),
        ]
    return trips.groupBy("vehicle_type", "year", "month", *keys).agg(*parts)


def evolution_of(
    sums: DataFrame, surcharges: Sequence[str] = tuple(SURCHARGES)
) -> DataFrame:
    """The report from ``surcharge_sums``, one row per (type, year, month) or several to add up."""
    parts = [F.sum(f"{n}__{p}").alias(f"{n}__{p}") for n in surcharges for p in ("sum", "filled", "trips")]
    added = sums.groupBy("vehicle_type", "year", "month").agg(*parts)
    return _report(added, surcharges)


def _report(added: DataFrame, surcharges: Sequence[str]) -> DataFrame:
    total = {n: F.col(f"{n}__sum").cast("double") for n in surcharges}
    wide = added.withColumns({
        **{f"{n}__total": total[n] for n in surcharges},
        **{f"{n}__mean": F.try_divide(total[n], F.col(f"{n}__filled")) for n in surcharges},
    })
    tall = wide.select(
        "vehicle_type",
        "year",
        "month",
        _unpivot(surcharges, {
            "mean": "montant_moyen", "total": "montant_total", "trips": "nb_courses",
        }),
    )
    return tall.filter(F.col("nb_courses") > 0)


def surcharge_evolution(
    trips: DataFrame, surcharges: Sequence[str] = tuple(SURCHARGES)
) -> DataFrame:
    """Mean, total and trips per (type, year, month, surcharge) where it existed.

    Rows are unpivoted after the aggregation, when there is one per type and month.  The
    trip count includes trips whose surcharge is missing, mean and total do not.
    """
    return _report(surcharge_sums(trips, surcharges), surcharges)


def surcharge_availability(
    trips: DataFrame, surcharges: Sequence[str] = tuple(SURCHARGES)
) -> DataFrame:
    """Share of a type's months in which a surcharge column existed."""
    monthly = trips.groupBy("vehicle_type", "year", "month").agg(
        *[F.max(flag_of(name)).alias(name) for name in surcharges]
    )
    parts = []
    for name in surcharges:
        parts += [
            F.count_if(F.col(name)).alias(f"{name}__with"),
            F.count("*").alias(f"{name}__all"),
            (F.count_if(F.col(name)) / F.count("*")).alias(f"{name}__share"),
        ]
    return monthly.groupBy("vehicle_type").agg(*parts).select(
        "vehicle_type",
        _unpivot(surcharges, {
            "with": "months_available", "all": "months_present", "share": "share",
        }),
    )
