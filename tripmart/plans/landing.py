"""Landing of monthly files in bronze, with the manifest as the only ingest state."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import (
    DEFAULT_MONTHS,
    DEFAULT_YEARS,
    MANIFEST_SCHEMA,
    ORIGIN_FILE,
    ORIGIN_ROW,
    PARTITION_KEYS,
    SERVICE_START,
    TRIP_FILE_PATTERN,
    WEATHER_ANSWER_SCHEMA,
    WEATHER_MANIFEST_SCHEMA,
    WEATHER_VARIABLES,
)
from tripmart.operators.ingest import (
    already_ingested,
    candidate_months,
    first_months,
    month_status,
    not_yet_ingested,
    resolve_sources,
    service_types,
    status_summary,
)
from tripmart.sources.listing import (
    delete,
    list_files,
    list_partition_files,
    origin_of,
    plain_path,
    qualified,
    unplaced,
    with_footers,
    with_markers,
)
from tripmart.sources.tables import write_partitioned
from tripmart.sources.weather import hourly_rows, read_weather_json


def open_manifest(spark: SparkSession, path: str, schema: str = MANIFEST_SCHEMA) -> DataFrame:
    """The manifest table, created empty on first use or after a creation that broke off."""
    if list_files(spark, path).isEmpty():
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    spark.catalog.refreshByPath(path)
    return spark.read.schema(schema).parquet(path)


def land_files(spark: SparkSession, files: DataFrame, bronze_path: str) -> None:
    """Copy monthly files (``path``, and ``root`` if known) under type/year/month folders.

    Files with equal columns are copied together and never with others, so a column
    that a month lacks stays absent; a month whose parts differ in columns is an error.
    Type and month are taken from the file name.  Each row keeps the file's path below the
    root of its listing and its place in the file: parts of a month may have equal names in
    different folders, and landing again, from a moved root too, changes nothing.
    Re-landing a month replaces that month only.  Rows are counted as they are written and
    must be those of the footers.
    """
    name = F.col("_metadata.file_name")
    mixed = files.groupBy(*PARTITION_KEYS).agg(F.count_distinct("columns").alias("kinds")).filter("kinds > 1")
    if split := mixed.collect():
        raise ValueError(f"parts of a month differ in columns: {[tuple(r)[:3] for r in split]}")
    root = F.col("root") if "root" in files.columns else F.lit(None).cast("string")
    groups = files.groupBy("columns", root.alias("root")).agg(
        F.collect_list("path").alias("paths"), F.sum("row_count").alias("row_count"))
    # Only file names reach the driver, one per month, to name each scan.
    for group in groups.filter("row_count > 0").collect():
        written = Observation()
        spark.read.parquet(*sorted(group.paths)).withColumns({
            "vehicle_type": F.regexp_extract(name, TRIP_FILE_PATTERN, 1),
            "year": F.regexp_extract(name, TRIP_FILE_PATTERN, 2).cast("int"),
            "month": F.regexp_extract(name, TRIP_FILE_PATTERN, 3).cast("int"),
            ORIGIN_FILE: origin_of(plain_path("_metadata.file_path", encoded=True), group.root),
            ORIGIN_ROW: F.col("_metadata.row_index"),
        }).observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*PARTITION_KEYS).parquet(bronze_path)
        if written.get["rows"] != group.row_count:
            raise RuntimeError(f"{written.get['rows']} rows landed of {group.row_count} in {sorted(group.paths)}")


def plan_months(
    spark: SparkSession,
    manifest: DataFrame,
    years: Sequence[int] = DEFAULT_YEARS,
    months: tuple[int, int] = DEFAULT_MONTHS,
    starts: Mapping = SERVICE_START,
    limit: int | None = None,
    limit_new: int | None = None,
    force: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(months in scope, months still to ingest).

    ``limit`` counts every month in scope, those already ingested too;
    ``limit_new`` counts only months still to ingest.
    """
    scope = first_months(candidate_months(service_types(spark, starts), years, months), limit)
    pending = first_months(not_yet_ingested(scope, manifest, force=force), limit_new)
    return scope, pending


def ingest_trips(
    spark: SparkSession,
    primary: DataFrame,
    fallback: DataFrame | None,
    bronze_path: str,
    manifest_path: str,
    force: bool = False,
    **scope_options,
) -> DataFrame:
    """Land every pending month that some source has; return (status, months).

    The manifest rows are appended last.  A run that dies before leaves its months
    unmarked, and the next run lands them again in place.  A month with a file that
    Spark cannot read is named in a warning, counted as ``unreadable`` and not landed;
    the others are.  Files that look monthly but whose name does not say the month are named
    in a warning too and counted as ``unplaced``.
    """
    manifest = open_manifest(spark, manifest_path)
    scope, pending = plan_months(spark, manifest, force=force, **scope_options)
    resolved = resolve_sources(pending, primary, primary if fallback is None else fallback)
    found = resolved.filter(F.col("path").isNotNull())
    files = with_footers(found.select(*PARTITION_KEYS, "path", "origin", *[c for c in ("root",) if c in found.columns]))

    tried = pending.select(*PARTITION_KEYS)
    if not force:
        tried = tried.unionByName(already_ingested(scope, manifest).select(*PARTITION_KEYS))
    summary = status_summary(month_status(tried, manifest, resolved, force=force))

    # One row per month and three summary rows: fixed now, before the manifest changes.
    counts = {r["status"]: r["months"] for r in summary.collect()}
    months = files.collect()
    month_of = lambda r: tuple(r[k] for k in PARTITION_KEYS)
    broken = {month_of(r) for r in months if r["columns"] is None}
    if broken:
        names = sorted(f"{r['path']}: {r['fault']}" for r in months if r["columns"] is None)
        warnings.warn(f"source files that cannot be read: {names}", stacklevel=2)
        counts |= {"ingested": counts["ingested"] - len(broken), "unreadable": len(broken)}
    strays = unplaced(primary if fallback is None else primary.select(*PARTITION_KEYS, "path").unionByName(
        fallback.select(*PARTITION_KEYS, "path"))).collect()
    if strays:
        warnings.warn(f"files named like months that are none: {sorted(r['path'] for r in strays)}", stacklevel=2)
        counts["unplaced"] = len(strays)
    outcome = spark.createDataFrame([(s, n) for s, n in counts.items() if n], summary.schema)
    months = [r for r in months if month_of(r) not in broken]
    if months:
        landed = spark.createDataFrame(months, files.schema)
        land_files(spark, landed, bronze_path)
        append_manifest(landed, manifest_path)
    return outcome


def append_manifest(files: DataFrame, manifest_path: str) -> None:
    """Mark months as ingested, after their data has landed."""
    parts = F.sort_array(F.collect_list(F.concat_ws(":", "origin", "path")))  # files of one month
    entries = files.groupBy(*PARTITION_KEYS, "columns").agg(
        F.array_join(parts, ";").alias("source"), F.sum("row_count").alias("row_count")
    ).select(
        *PARTITION_KEYS,
        "source",
        "row_count",
        F.current_timestamp().alias("ingested_at"),
        "columns",
        F.format_string("vehicle_type=%s/year=%d/month=%d", *PARTITION_KEYS).alias("location"),
    )
    entries.coalesce(1).write.mode("append").parquet(manifest_path)


def manifest_of_existing(
    spark: SparkSession, bronze_path: str, marked_only: bool = True
) -> DataFrame:
    """Manifest rows for a bronze table that something else has laid out.

    Months count as ingested if their folder holds a ``_SUCCESS`` marker, whose
    source and time are taken over; with ``marked_only=False`` every month counts.
    Months whose files differ in columns get one row per file, so that each can be
    scanned with files like itself.
    """
    files = list_partition_files(spark, bronze_path)
    months = with_markers(files.select(*PARTITION_KEYS, "folder").distinct())
    if marked_only:
        months = months.filter(F.col("marker").isNotNull())
    mark = F.from_json("marker", "source string, ingested_at timestamp")
    marks = months.select(*PARTITION_KEYS, "folder", mark.alias("mark"))

    described = with_footers(files.join(marks.select("folder"), "folder", "left_semi"))
    described = described.filter(F.col("columns").isNotNull())
    mixed = described.groupBy("folder").agg(F.count_distinct("columns").alias("variants"))
    own = F.concat_ws("/", "location", F.element_at(F.split("path", "/"), -1))
    placed = described.join(mixed, "folder").withColumn(
        "location", F.when(F.col("variants") == 1, F.col("location")).otherwise(own)
    )
    return (
        placed.groupBy("folder", "columns", "location")
        .agg(F.sum("row_count").alias("row_count"))
        .join(marks, "folder")
        .select(
            *PARTITION_KEYS,
            F.coalesce("mark.source", F.lit("existing")).alias("source"),
            "row_count",
            F.coalesce("mark.ingested_at", F.current_timestamp()).alias("ingested_at"),
            "columns",
            "location",
        )
    )


def weather_manifest_of_existing(
    spark: SparkSession, bronze_path: str, marked_only: bool = True
) -> DataFrame:
    """The same for hourly weather, in folders by year and month."""
    keys = ["year", "month"]
    files = with_footers(list_partition_files(spark, bronze_path, keys))
    months = with_markers(
        files.groupBy(*keys, "folder").agg(F.sum("row_count").alias("row_count"))
    )
    if marked_only:
        months = months.filter(F.col("marker").isNotNull())
    mark = F.from_json("marker", "source_url string, ingested_at timestamp")
    return months.select(
        *keys,
        F.coalesce(mark["source_url"], F.lit("existing")).alias("source"),
        "row_count",
        F.coalesce(mark["ingested_at"], F.current_timestamp()).alias("ingested_at"),
    )


def record_answers(spark: SparkSession, listing: DataFrame, hours: DataFrame, ledger_path: str) -> None:
    """Append the answers of ``listing`` to the ledger, with what their ``hours`` say."""
    at = F.col("datetime_local")
    own = hours.groupBy("answer", F.year(at).alias("y"), F.month(at).alias("m")).agg(F.count("*").alias("n"))
    most = F.max(F.when(F.col("y").isNotNull(), F.struct("n", (-F.col("y")).alias("y"), (-F.col("m")).alias("m"))))
    found = own.groupBy("answer").agg(F.sum("n").alias("hours"), most.alias("o")).select(
        "answer", (-F.col("o.y")).alias("year"), (-F.col("o.m")).alias("month"), "hours",
        (F.col("hours") - F.coalesce("o.n", F.lit(0))).alias("outside"))
    rows = listing.join(found, "answer", "left").select(
        "answer", "modified", "length", F.element_at(F.split("path", "/"), -1).alias("source"), "year", "month",
        F.coalesce("hours", F.lit(0)).alias("hours"), F.coalesce("outside", F.lit(0)).alias("outside"))
    rows.coalesce(1).write.mode("append").parquet(ledger_path)


def ingest_weather(
    spark: SparkSession,
    json_path: str,
    bronze_path: str,
    manifest_path: str,
    scope: DataFrame | None = None,
    limit: int | None = None,
    force: bool = False,
) -> DataFrame:
    """Land the hours of every pending month; return (status, months).

    ``scope`` names the months to consider, see ``calendar_months`` and
    ``whole_history``; without it, all months found in the answers.  The month of an
    answer is the one that most of its hours lie in, the earliest of several.  All its
    hours are landed there and mark no other month; those of other months, and those
    without a readable time, are counted in the row ``hours_outside`` of the outcome; so are,
    in every run, the hours of answers in which no time can be read.

    A ledger beside the manifest knows every answer by path, time of change and length, so
    an answer is parsed when it is new or when its month is landed later, and never again:
    a run in which nothing is new only lists files.  New answers are parsed once, into a
    table beside bronze that is deleted at the end.
    """
    keys, ledger_path = ["year", "month"], f"{manifest_path.rstrip('/')}__answers"
    root, incoming = qualified(spark, json_path), f"{bronze_path.rstrip('/')}__incoming"
    manifest = open_manifest(spark, manifest_path, WEATHER_MANIFEST_SCHEMA)
    same = ["answer", "modified", "length"]
    answer = origin_of(plain_path("path"), root).alias("answer")
    listing = list_files(spark, json_path, "*").select(answer, "path", "modified", "length")

    def parsed(paths: list[str]) -> DataFrame:
        read = read_weather_json(spark, sorted(paths))
        return hourly_rows(read.withColumn("answer", origin_of(F.col("path"), root)), keep=("answer", "source"))

    ledger = open_manifest(spark, ledger_path, WEATHER_ANSWER_SCHEMA)
    # Only names, times and lengths of files that no run has parsed reach the driver.
    fresh = listing.join(ledger, same, "left_anti").select(*listing.columns).collect()
    if fresh:
        parsed([r.path for r in fresh]).write.mode("overwrite").parquet(incoming)
        record_answers(spark, spark.createDataFrame(fresh, listing.schema), spark.read.parquet(incoming), ledger_path)
        ledger = open_manifest(spark, ledger_path, WEATHER_ANSWER_SCHEMA)
    known = ledger.dropDuplicates(same).join(listing, same)
    unowned = known.filter(F.col("year").isNull()).agg(F.sum("hours")).first()[0] or 0
    answers = known.filter(F.col("year").isNotNull()).groupBy(*keys).agg(
        F.min("source").alias("path"), F.sum("hours").alias("row_count"), F.sum("outside").alias("outside"))
    asked = first_months(answers if scope is None else scope, limit).select(*keys)
    summary = status_summary(month_status(asked, manifest, answers, keys, force))
    pending = answers.join(not_yet_ingested(asked, manifest, keys, force), keys, "left_semi")

    # One row per month and three summary rows: fixed now, before the manifest changes.
    counts = [tuple(r) for r in summary.collect()]
    months = pending.collect()
    if outside := unowned + sum(r["outside"] for r in months):
        counts.append(("hours_outside", outside))
    outcome = spark.createDataFrame(counts, summary.schema)
    if months:
        landed = spark.createDataFrame(months, pending.schema).drop("outside")
        wanted = known.join(landed, keys, "left_semi").select("answer", "path", *keys).collect()
        just_parsed = {r.answer for r in fresh}
        parts = [spark.read.parquet(incoming)] if fresh else []
        if later := [r.path for r in wanted if r.answer not in just_parsed]:
            parts.append(parsed(later))
        owner = spark.createDataFrame([(r.answer, r.year, r.month) for r in wanted], "answer string, year int, month int")
        hours = reduce(DataFrame.unionByName, parts).join(owner, "answer")
        write_partitioned(hours.select("datetime_local", *WEATHER_VARIABLES, *keys), bronze_path, keys, "partitions")
        entries = landed.select(
            *keys,
            F.col("path").alias("source"),
            "row_count",
            F.current_timestamp().alias("ingested_at"),
        )
        entries.coalesce(1).write.mode("append").parquet(manifest_path)
    delete(spark, incoming)
    return outcome
