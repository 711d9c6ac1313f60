"""Planning of monthly ingestion as table work."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import (
    DEFAULT_MONTHS,
    DEFAULT_YEARS,
    HISTORY_START,
    SERVICE_START,
)

MONTH_KEYS = ("vehicle_type", "year", "month")


def service_types(spark: SparkSession, starts: Mapping = SERVICE_START) -> DataFrame:
    """(vehicle_type, type_ordinal, start_year, start_month) in processing order."""
    rows = [(t, i, y, m) for i, (t, (y, m)) in enumerate(starts.items())]
    return spark.createDataFrame(
        rows, "vehicle_type string, type_ordinal int, start_year int, start_month int"
    )


def months_between(first, last):
    """Array column of month starts from the month of ``first`` to that of ``last``."""
    return F.sequence(
        F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month")
    )


def month_calendar(spans: DataFrame, first: str, last: str) -> DataFrame:
    """(year, month) of every month in the span of each row, other columns kept."""
    kept = [c for c in spans.columns if c not in (first, last)]
    months = spans.filter(F.col(first) <= F.col(last)).select(
        *kept, F.explode(months_between(F.col(first), F.col(last))).alias("__m")
    )
    return months.select(
        *kept, F.year("__m").alias("year"), F.month("__m").alias("month")
    )


def whole_history(spark: SparkSession, until=None) -> DataFrame:
    """All months since the start of the data, up to ``until`` or today."""
    year, month = HISTORY_START
    last = F.current_date() if until is None else F.lit(until).cast("date")
    span = spark.range(1).select(
        F.make_date(F.lit(year), F.lit(month), F.lit(1)).alias("first"),
        last.alias("last"),
    )
    return month_calendar(span, "first", "last")


def candidate_months(
    types: DataFrame,
    years: Sequence[int] = DEFAULT_YEARS,
    months: tuple[int, int] = DEFAULT_MONTHS,
) -> DataFrame:
    """Every (type, year, month) in scope that is not before the type's first month.

    The calendar is exploded on each type's own row, so no join is needed to pair
    types with months or to compare with the start of service.
    """
    grid = types.select(
        "*", F.posexplode(F.array(*[F.lit(y) for y in years])).alias("year_ordinal", "year")
    ).select("*", F.explode(F.sequence(F.lit(months[0]), F.lit(months[1]))).alias("month"))
    return not_before_service(grid).drop("start_year", "start_month")


def calendar_months(
    spark: SparkSession,
    years: Sequence[int] = DEFAULT_YEARS,
    months: tuple[int, int] = DEFAULT_MONTHS,
) -> DataFrame:
    """(year_ordinal, year, month) of every month in scope, for data without types."""
    return (
        spark.range(1)
        .select(F.posexplode(F.array(*[F.lit(y) for y in years])).alias("year_ordinal", "year"))
        .select("*", F.explode(F.sequence(F.lit(months[0]), F.lit(months[1]))).alias("month"))
    )


def not_before_service(months: DataFrame) -> DataFrame:
    """Drop months before (start_year, start_month) of their row."""
    at = F.col("year") * 12 + F.col("month")
    return months.filter(at >= F.col("start_year") * 12 + F.col("start_month"))


def first_months(plan: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` months in processing order: type, then year as given, then month."""
    if limit is None:
        return plan
    order = [c for c in ("type_ordinal", "year_ordinal", "year", "month") if c in plan.columns]
    return plan.orderBy(*order).limit(limit)


def not_yet_ingested(
    plan: DataFrame, manifest: DataFrame, keys: Sequence[str] = MONTH_KEYS, force: bool = False
) -> DataFrame:
    """Months without a manifest row; ``force`` keeps them all."""
    if force:
        return plan
    return plan.join(manifest.select(*keys), list(keys), "left_anti")


def resolve_sources(
    plan: DataFrame, primary: DataFrame, fallback: DataFrame, keys: Sequence[str] = MONTH_KEYS
) -> DataFrame:
    """Files of each month: the primary listing wins, then the fallback, else NULL.

    A month in parts has one row for each, all of the same listing.  Listings that know
    their ``root`` pass it on.
    """
    carried = [c for c in ("path", "root") if c in primary.columns and c in fallback.columns]
    near = primary.select(*keys, *[F.col(c).alias(f"__near_{c}") for c in carried])
    far = fallback.select(*keys, *[F.col(c).alias(f"__far_{c}") for c in carried]).join(
        near.select(*keys), list(keys), "left_anti"
    )
    found = plan.join(near, list(keys), "left").join(far, list(keys), "left")
    origin = (
        F.when(F.col("__near_path").isNotNull(), "primary")
        .when(F.col("__far_path").isNotNull(), "fallback")
    )
    return found.withColumns({
        **{c: F.coalesce(f"__near_{c}", f"__far_{c}") for c in carried},
        "origin": origin,
    }).drop(*[f"__{side}_{c}" for side in ("near", "far") for c in carried])


def month_status(
    plan: DataFrame,
    manifest: DataFrame,
    resolved: DataFrame,
    keys: Sequence[str] = MONTH_KEYS,
    force: bool = False,
) -> DataFrame:
    """(keys, status): skipped if in the manifest, else ingested or not_published."""
    marked = manifest.select(*keys).distinct().withColumn("__marked", F.lit(not force))
    files = resolved.groupBy(*keys).agg(F.min("path").alias("path"))
    status = (
        F.when(F.coalesce("__marked", F.lit(False)), "skipped")
        .when(F.col("path").isNotNull(), "ingested")
        .otherwise("not_published")
    )
    return (
        plan.select(*keys)
        .join(marked, list(keys), "left")
        .join(files, list(keys), "left")
        .select(*keys, status.alias("status"))
    )


def status_summary(months: DataFrame) -> DataFrame:
    return months.groupBy("status").agg(F.count("*").alias("months"))


def latest_entries(
    manifest: DataFrame, keys: Sequence[str] = (*MONTH_KEYS, "location")
) -> DataFrame:
    """Newest manifest row per month: a forced run adds a row rather than editing one."""
    rest = [c for c in manifest.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.col("ingested_at"))
    return manifest.groupBy(*keys).agg(newest.alias("e")).select(*keys, "e.*")


def ingested_types(manifest: DataFrame) -> DataFrame:
    return manifest.select("vehicle_type").distinct()


def ingested_periods(manifest: DataFrame) -> DataFrame:
    """First and last month, months present and rows of each type."""
    ym = F.col("year") * 100 + F.col("month")
    return manifest.groupBy("vehicle_type").agg(
        F.min(ym).alias("first_ym"),
        F.max(ym).alias("last_ym"),
        F.count_distinct(ym).alias("months"),
        F.sum("row_count").alias("row_count"),
    )


def already_ingested(
    months: DataFrame, manifest: DataFrame, keys: Sequence[str] = MONTH_KEYS
) -> DataFrame:
    """Those of ``months`` that the manifest holds."""
    return months.join(manifest.select(*keys), list(keys), "left_semi")
