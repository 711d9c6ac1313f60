"""Reports kept as partial results of each landed month, which add up.

A report over all trips is put together from rows computed month by month: sums and counts,
counts by key, or quantile sketches.  When a month is landed again only its own rows are
computed anew, from the files of that month in bronze, and the report is put together from
the stored rows.  A month is that of the source file; its trips may lie in any month.

    path/<report>/of_type=../of_year=../of_month=..    partial rows, with ``landed``
    path/stamps                                        months whose rows are complete

A month's rows count only if their ``landed`` is that of the month's newest manifest row and
of its stamp, which is written last: a run that dies is repaired by the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import PARTITION_KEYS
from tripmart.operators.ingest import latest_entries
from tripmart.plans import flows, prices, rides, surcharges, weather_prices
from tripmart.sources.listing import list_files
from tripmart.sources.tables import write_partitioned

#: Month of the source file that a row comes from.
OF = ("of_type", "of_year", "of_month")
STAMPS = "of_type string, of_year int, of_month int, landed timestamp"


@dataclass(frozen=True)
class Report:
    """Rows per month (``partial``, given trips and further keys), and how they add up."""

    name: str
    partial: Callable[[DataFrame, Sequence[str]], DataFrame]
    merge: Callable[[DataFrame], DataFrame]


RIDES = Report("rides", rides.rides_by_dow_hour, rides.add_rides)
FLOWS = Report(
    "flows", flows.flows_by_zone, lambda parts: flows.flows(parts, "zone_id", "nb_courses")
)
SURCHARGES = Report(
    "surcharges", lambda trips, keys: surcharges.surcharge_sums(trips, keys=keys), surcharges.evolution_of
)
WEATHER_PRICES = Report(
    "weather_prices",
    lambda trips, keys: weather_prices.bucket_sums(trips, keys=keys),
    lambda parts: weather_prices.gaps(weather_prices.add_buckets(parts)),
)
#: Sketches by zone, year and month of the pickup; see ``prices.sketch_quantiles``.
PRICE_SKETCHES = Report(
    "price_sketches",
    lambda trips, keys: prices.price_sketches(
        prices.priced_trips(trips, keep=("month", *keys)), (*prices.PRICE_GROUP, "month", *keys)),
    lambda parts: parts.select(*prices.PRICE_GROUP, "month", "sketch", "nb_courses"),
)
REPORTS = (RIDES, FLOWS, SURCHARGES, WEATHER_PRICES, PRICE_SKETCHES)


def together(report: Report, trips: DataFrame) -> DataFrame:
    """The report by way of its months, in one go; ``trips`` have the columns ``OF``."""
    return report.merge(report.partial(trips, OF))


def of_source(trips: DataFrame) -> DataFrame:
    """Silver trips with the month of their source file, which their identity begins with."""
    part = F.split("source_file", "/", 4)
    return trips.withColumns({
        "of_type": part[0], "of_year": part[1].cast("int"), "of_month": part[2].cast("int"),
    })


def open_stamps(spark: SparkSession, path: str) -> DataFrame:
    at = f"{path.rstrip('/')}/stamps"
    if list_files(spark, at).isEmpty():
        return spark.createDataFrame([], STAMPS)
    spark.catalog.refreshByPath(at)
    return spark.read.schema(STAMPS).parquet(at)


def newest_months(manifest: DataFrame) -> DataFrame:
    """(OF, landed): when each month with trips was landed last."""
    entries = latest_entries(manifest).filter(F.col("row_count") > 0)
    return entries.groupBy(*[F.col(k).alias(o) for k, o in zip(PARTITION_KEYS, OF)]).agg(
        F.max("ingested_at").alias("landed"))


def refresh(
    spark: SparkSession,
    path: str,
    manifest: DataFrame,
    silver_of: Callable[[DataFrame], DataFrame],
    reports: Sequence[Report] = REPORTS,
) -> dict[str, DataFrame]:
    """Bring the partial rows up to date and return the reports, by name.

    ``silver_of`` plans silver trips from the manifest rows given to it, for example with
    ``bronze_sources`` and ``silver_trips``; it is given those of months that were landed
    since their rows were computed, and no others are read.  A new grid or new weather are not
    noticed: give a new ``path`` then.  The same goes for another choice of reports.
    """
    root = path.rstrip("/")
    newest = newest_months(manifest)
    # Names and times of months only, a few dozen a year.
    stale = newest.join(open_stamps(spark, root), [*OF, "landed"], "left_anti").collect()
    if stale:
        months = spark.createDataFrame(stale, newest.schema)
        wanted = manifest.join(
            months.select(*[F.col(o).alias(k) for k, o in zip(PARTITION_KEYS, OF)]), list(PARTITION_KEYS), "left_semi")
        trips = of_source(silver_of(wanted))
        for report in reports:
            rows = report.partial(trips, OF).join(F.broadcast(months), list(OF))  # one row per month
            write_partitioned(rows, f"{root}/{report.name}", OF, "partitions")
        months.coalesce(1).write.mode("append").parquet(f"{root}/stamps")
    return {r.name: r.merge(current(spark, root, r, manifest)) for r in reports}


def current(spark: SparkSession, path: str, report: Report, manifest: DataFrame) -> DataFrame:
    """Stored partial rows of a report that are those of the months as landed now."""
    root = path.rstrip("/")
    spark.catalog.refreshByPath(f"{root}/{report.name}")
    valid = open_stamps(spark, root).join(newest_months(manifest), [*OF, "landed"], "left_semi").distinct()
    return spark.read.parquet(f"{root}/{report.name}").join(F.broadcast(valid), [*OF, "landed"], "left_semi")
