"""Name to query: each takes (spark, data folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.catalog import roles
from tripmart.catalog.roles import LINE_KEY, MONEY, Tables
from tripmart.contracts import QUANTILE_ROW_BOUND
from tripmart.operators import ingest
from tripmart.operators.grid_fill import GridSpec, build_zone_grid, nodes_within_zones
from tripmart.operators.harmonize import harmonize, surcharge_states, union_eras
from tripmart.operators.joins import broadcast_within, join_null_safe
from tripmart.operators.metrics import add_trip_metrics
from tripmart.operators.sampling import keyed_sample, random_sample_by_year, within_binomial_bounds
from tripmart.operators.weather_join import join_weather
from tripmart.operators.zones import resolve_zones, zone_cells
from tripmart.plans import flows, monthly, prices, rides, silver, surcharges, weather_prices
from tripmart.sources.listing import rows_per_file
from tripmart.sources.weather import hourly_rows, parse_weather_text

# Thresholds scaled to the price per quantity of these tables.
CEILING, MINIMUM = 2000, 1000
WIDTH = 25.0
RANK_WIDTH = 1.0  # narrow bins: few distinct prices have to be ranked together
RATE = 0.1
PRICE_YEARS = tuple(range(1995, 2001))  # later ships give no sample
YEARS_AT_MOST = 20  # of ship dates
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE")  # one region is left to "other"
HEATMAP_YEAR = 1997
PLAN_YEARS, PLAN_MONTHS = (1997, 1995, 2001, 1999), (1, 6)
PLAN_LIMIT = 30
SUPPLIER_GRID = GridSpec(1.0, 0.0, 200.0, 0.0, 200.0)

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}


def _query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, folder: build(Tables(spark, folder))

    return {name: bind(build) for name, build in _QUERIES.items()}


# --- reports ---------------------------------------------------------------


@_query
def rides_by_dow_hour(t):
    return rides.rides_by_dow_hour(roles.shipped_trips(t))


@_query
def heatmap_pivot(t):
    return rides.heatmap(rides_by_dow_hour(t), HEATMAP_YEAR)


@_query
def flows_by_zone(t):
    return flows.flows_by_zone(roles.zone_trips(t))


@_query
def flows_by_borough(t):
    return flows.flows_by_borough(flows_by_zone(t), roles.nation_zones(t))


@_query
def flow_matrix(t):
    return flows.flow_matrix(flows_by_borough(t), REGIONS)


@_query
def surcharge_evolution(t):
    return surcharges.surcharge_evolution(roles.surcharge_trips(t))


@_query
def surcharge_availability(t):
    return surcharges.surcharge_availability(roles.surcharge_trips(t))


@_query
def price_by_weather(t):
    # Decimal prices make the sums exact, so they can be compared bit by bit.
    exact = F.col("price_per_km").cast(MONEY)
    return weather_prices.price_by_weather(weather_join(t).withColumn("price_per_km", exact))


@_query
def zone_volumes(t):
    return prices.zone_volumes(prices.priced_trips(roles.priced_line_trips(t), CEILING))


@_query
def eligible_zones(t):
    return prices.eligible_zones(
        prices.priced_trips(roles.priced_line_trips(t), CEILING), MINIMUM
    )


@_query
def trips_in_eligible_zones(t):
    trips = prices.priced_trips(roles.priced_line_trips(t), CEILING, keep=LINE_KEY)
    return prices.in_eligible_zones(
        trips, prices.eligible_zones(trips, MINIMUM), at_most=t.rows("nation")
    )


@_query
def price_sample(t):
    return prices.price_sample(
        roles.priced_line_trips(t), CEILING, MINIMUM, RATE, PRICE_YEARS, row_key=LINE_KEY
    )


@_query
def sampled_trips(t):
    return keyed_sample(t.events.select("event_id", "event_type", "value"), ["event_id"])


@_query
def price_histogram(t):
    trips = prices.priced_trips(roles.priced_line_trips(t), CEILING)
    return prices.price_histogram(trips, WIDTH)


@_query
def price_quantiles(t):
    trips = prices.priced_trips(roles.priced_line_trips(t), CEILING)
    histogram = prices.price_histogram(trips, RANK_WIDTH)
    groups = t.rows("nation") * YEARS_AT_MOST
    found = prices.price_quantiles(trips, histogram, QUANTILES, RANK_WIDTH, groups)
    return found.withColumn("price", F.round("price", 6))


@_query
def price_sketch_ranks(t):
    """Quantiles from merged sketches, held against the ranks of all prices."""
    trips = prices.priced_trips(roles.priced_line_trips(t), CEILING, keep=("l_linenumber",))
    parts = prices.price_sketches(trips, (*prices.PRICE_GROUP, "l_linenumber"))
    found = prices.sketch_quantiles(parts, QUANTILES)
    side = broadcast_within(found, QUANTILE_ROW_BOUND, t.rows("nation") * YEARS_AT_MOST * len(QUANTILES))
    group = [*prices.PRICE_GROUP, "quantile"]
    ranked = join_null_safe(trips, side, prices.PRICE_GROUP).groupBy(*group, "nb_courses").agg(
        F.count_if(F.col("price_per_km") < F.col("price")).alias("below"),
        F.count_if(F.col("price_per_km") <= F.col("price")).alias("upto"),
    )
    n, slack = F.col("nb_courses"), prices.SKETCH_RANK_ERROR
    fits = (F.col("below") / n <= F.col("quantile") + slack) & (F.col("upto") / n >= F.col("quantile") - slack)
    return ranked.select(*group, "nb_courses", fits.alias("within_error"))


@_query
def sample_in_bounds(t):
    """Spark's own stratified sample: sizes per year by the binomial law."""
    trips = prices.priced_trips(roles.priced_line_trips(t), CEILING)
    rates = {year: RATE for year in PRICE_YEARS}
    return within_binomial_bounds(trips, random_sample_by_year(trips, RATE, PRICE_YEARS), "year", rates)


# --- reports put together from months --------------------------------------


@_query
def monthly_rides(t):
    return monthly.together(monthly.RIDES, roles.by_ship_month(t, roles.shipped_trips))


@_query
def monthly_flows(t):
    return monthly.together(monthly.FLOWS, roles.by_ship_month(t, roles.zone_trips))


@_query
def monthly_surcharges(t):
    return monthly.together(monthly.SURCHARGES, roles.by_ship_month(t, roles.surcharge_trips))


@_query
def monthly_weather_prices(t):
    exact = F.col("price_per_km").cast(MONEY)
    trips = weather_join(t).withColumn("price_per_km", exact)
    return monthly.together(monthly.WEATHER_PRICES, trips.withColumns({
        "of_type": F.col("vehicle_type"), "of_year": F.col("year"), "of_month": F.month("pickup_datetime")}))


# --- harmonisation and silver ----------------------------------------------


@_query
def harmonized_trips(t):
    return union_eras(
        [harmonize(frame, kind, keep=LINE_KEY) for kind, frame in roles.bronze_sources(t)]
    )


@_query
def absent_vs_null_vs_zero(t):
    return surcharge_states(harmonized_trips(t), ["vehicle_type"])


@_query
def grid_resolve(t):
    return resolve_zones(
        roles.located_lines(t, recorded=False), zone_cells(roles.part_grid(t), at_most=t.rows("part"))
    )


@_query
def zone_coalesce(t):
    return resolve_zones(
        roles.located_lines(t, recorded=True), zone_cells(roles.part_grid(t), at_most=t.rows("part"))
    )


@_query
def trip_metrics(t):
    return add_trip_metrics(roles.metric_trips(t))


@_query
def weather_join(t):
    return join_weather(roles.event_trips(t), roles.event_weather(t), at_most=t.rows("events"))


@_query
def silver_weather(t):
    return silver.silver_weather(roles.order_weather(t))


@_query
def silver_trips(t):
    return silver.silver_trips(
        roles.bronze_sources(t), roles.part_grid(t), roles.order_weather(t), keep=LINE_KEY,
        cells_at_most=t.rows("part"), hours_at_most=t.rows("orders"),
    )


@_query
def silver_rides(t):
    """Silver to gold in one plan: only what the report needs is computed."""
    return rides.rides_by_dow_hour(silver_trips(t))


# --- sources ---------------------------------------------------------------


@_query
def weather_json_rows(t):
    return hourly_rows(parse_weather_text(roles.event_payloads(t), "payload"))


@_query
def weather_json_gaps(t):
    return hourly_rows(parse_weather_text(roles.event_payloads(t, gaps=True), "payload"))


@_query
def nodes_in_zones(t):
    return nodes_within_zones(roles.supplier_rings(t), SUPPLIER_GRID)


@_query
def zone_grid_build(t):
    return build_zone_grid(roles.supplier_rings(t), SUPPLIER_GRID)


@_query
def file_row_counts(t):
    # No column is read, so files of different tables can share one scan.
    reader = t.spark.read.option("recursiveFileLookup", True)
    scan = reader.option("pathGlobFilter", "*.parquet").parquet(t.folder)
    table = F.regexp_extract("file_path", r"/([^/]+)\.parquet(/|$)", 1)
    return (
        rows_per_file(scan).groupBy(table.alias("table_name"))
        .agg(F.sum("row_count").alias("row_count"))
    )


# --- ingest planning -------------------------------------------------------


def _plan(t):
    return ingest.candidate_months(roles.order_types(t), PLAN_YEARS, PLAN_MONTHS)


@_query
def month_calendar(t):
    spans = t.orders.groupBy(F.col("o_orderpriority").alias("vehicle_type")).agg(
        F.min(F.to_date("o_orderdate")).alias("first"),
        F.max(F.to_date("o_orderdate")).alias("last"),
    )
    return ingest.month_calendar(spans, "first", "last")


@_query
def ingest_plan(t):
    return _plan(t)


@_query
def ingest_first_months(t):
    return ingest.first_months(_plan(t), PLAN_LIMIT)


@_query
def ingest_pending(t):
    return ingest.not_yet_ingested(_plan(t), roles.order_manifest(t))


@_query
def source_priority(t):
    return ingest.resolve_sources(
        ingest_pending(t), roles.primary_listing(t), roles.fallback_listing(t)
    )


@_query
def ingest_month_status(t):
    return ingest.month_status(_plan(t), roles.order_manifest(t), source_priority(t))


@_query
def ingest_status(t):
    return ingest.status_summary(ingest_month_status(t))


@_query
def ingest_types(t):
    return ingest.ingested_types(roles.order_months(t))


@_query
def ingest_inventory(t):
    return ingest.ingested_periods(roles.order_months(t))


@_query
def ingest_coverage(t):
    return ingest.already_ingested(_plan(t), roles.order_manifest(t))
