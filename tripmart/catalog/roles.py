"""Star-schema tables in the roles the operators expect.

Line items and events act as trips, nations as zones, regions as boroughs, orders
and views as weather, parts as grid cells, suppliers as zone outlines, and months
of orders as monthly files.  Only columns a query needs are joined in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions import hour_of, price_per_km
from tripmart.sources.listing import stored_rows

LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
MONEY = "decimal(18,2)"  # sums are exact, so they agree at any parallelism


class Tables:
    """Tables of one data folder, opened when first named."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table

    def rows(self, name: str) -> int:
        """Rows of a table by its footers: a bound on what is made of it, without a job."""
        return stored_rows(getattr(self, name))


# --- events as trips -------------------------------------------------------


def event_trips(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        F.col("event_type").alias("vehicle_type"),
        ts.alias("pickup_datetime"),
        F.year(ts).alias("year"),
        hour_of(ts).alias("pickup_hour_ts"),
        F.col("value").alias("price_per_km"),
    )


def by_ship_month(t: Tables, trips: Callable[..., DataFrame]) -> DataFrame:
    """Line items in a role, with the month of their ship date as that of a source file.

    The role is taken of each line item with the three columns beside those it picks.
    """
    of = {"of_type": F.col("l_returnflag"), "of_year": F.year("l_shipdate"), "of_month": F.month("l_shipdate")}
    dated = Tables(t.spark, t.folder)
    dated.lineitem = t.lineitem.withColumns(of)
    return trips(dated, tuple(of))


def shipped_trips(t: Tables, keep: Sequence[str] = ()) -> DataFrame:
    """Line items as rides of several years, each some hours after midnight."""
    at = F.col("l_shipdate") + F.expr("make_dt_interval(0, cast(l_linenumber * 3 as int))")
    return t.lineitem.select(
        F.col("l_returnflag").alias("vehicle_type"), at.alias("pickup_datetime"),
        F.year("l_shipdate").alias("year"), *keep,
    )


def event_weather(t: Tables) -> DataFrame:
    """Weather of most hours with events, in up to two versions (odd and even users).

    The last hour of every quarter of a day has none.  The version of odd users lacks
    the temperature in every third hour.
    """
    value, hour, odd = F.col("value"), hour_of(F.col("ts")), F.col("user_id") % 2
    lacking = (odd == 1) & (F.hour("ts") % 3 == 0)
    return (
        t.events.filter(F.hour("ts") % 6 != 5)
        .groupBy(hour.alias("datetime_local"), odd.alias("v"))
        .agg(
            F.max(F.when(~lacking, value)).alias("temperature_2m"),
            (F.min(value) / 10.0).alias("precipitation"),
            F.min(value).alias("rain"),
            F.greatest(F.min(value) - 40.0, F.lit(0.0)).alias("snowfall"),
            F.count("*").alias("weathercode"),
            (F.max(value) / 2.0).alias("windspeed_10m"),
        )
        .drop("v")
    )


def event_payloads(t: Tables, gaps: bool = False) -> DataFrame:
    """One weather answer per month as JSON text: an object of parallel arrays.

    Events are spread over two years.  A month has at most 744 hours, so the arrays are
    bounded.  With ``gaps`` every fourth month lacks an array, has a null one, a shorter
    one, or a time that cannot be read.
    """
    names = ("temperature_2m", "precipitation", "rain", "snowfall", "windspeed_10m",
             "relativehumidity_2m")
    hour = hour_of(F.col("ts") + F.expr("make_dt_interval(cast(event_id % 24 * 31 as int))"))
    value = F.col("value")
    hours = (
        t.events.groupBy(hour.alias("h"))
        .agg(
            F.max(value).alias("temperature_2m"),
            F.min(value).alias("precipitation"),
            F.min(value).alias("rain"),
            F.lit(0.0).alias("snowfall"),
            F.max(value).alias("windspeed_10m"),
            F.max("user_id").cast("double").alias("relativehumidity_2m"),
            F.count("*").alias("weathercode"),
        )
        .withColumn("time", F.date_format("h", "yyyy-MM-dd'T'HH:mm"))
    )
    record = F.struct("time", "weathercode", *names)
    months = hours.groupBy(F.trunc(F.to_date("h"), "month").alias("month_start")).agg(
        F.array_sort(F.collect_list(record)).alias("hours")
    )
    arrays = {n: F.col(f"hours.{n}") for n in ("time", "weathercode", *names)}
    kind = F.month("month_start") % 4
    if gaps:
        short = F.slice(arrays["windspeed_10m"], 1, F.greatest(F.size("hours") - 5, F.lit(0)))
        bad = F.transform(arrays["time"], lambda x, i: F.when(i == 0, "no time").otherwise(x))
        arrays["rain"] = F.when(kind != 0, arrays["rain"])
        arrays["snowfall"] = F.when(kind != 1, arrays["snowfall"])
        arrays["windspeed_10m"] = F.when(kind == 2, short).otherwise(arrays["windspeed_10m"])
        arrays["time"] = F.when(kind == 3, bad).otherwise(arrays["time"])
    answer = F.struct(F.struct(*[a.alias(n) for n, a in arrays.items()]).alias("hourly"))
    written = F.when(kind == 1, F.to_json(answer, {"ignoreNullFields": "false"})).otherwise(F.to_json(answer))
    return months.select(written.alias("payload"))


# --- line items as trips ---------------------------------------------------


def zone_trips(t: Tables, keep: Sequence[str] = ()) -> DataFrame:
    """Supplier nation to customer nation."""
    return (
        t.lineitem.select("l_orderkey", "l_suppkey", F.col("l_returnflag").alias("vehicle_type"), *keep)
        .join(t.orders.select("o_orderkey", "o_custkey"),
              F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(t.customer.select("c_custkey", F.col("c_nationkey").alias("dropoff_zone_id")),
              F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(t.supplier.select("s_suppkey", F.col("s_nationkey").alias("pickup_zone_id")),
              F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select("vehicle_type", "pickup_zone_id", "dropoff_zone_id", *keep)
    )


def nation_zones(t: Tables) -> DataFrame:
    return t.nation.join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    ).select(F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"))


def priced_line_trips(t: Tables) -> DataFrame:
    """Price per quantity by supplier nation and ship year."""
    return t.lineitem.select(
        *LINE_KEY,
        F.year("l_shipdate").alias("year"),
        price_per_km(F.col("l_extendedprice"), F.col("l_quantity")).alias("price_per_km"),
    ).join(
        t.supplier.select("s_suppkey", F.col("s_nationkey").alias("pickup_zone_id")),
        F.col("l_suppkey") == F.col("s_suppkey"),
        "left",
    )


def surcharge_trips(t: Tables, keep: Sequence[str] = ()) -> DataFrame:
    """Tax and discount as surcharges that appear in different years per flag."""
    year = F.year("l_shipdate")
    flag = F.col("l_returnflag")
    tax, discount = F.col("l_tax").cast(MONEY), F.col("l_discount").cast(MONEY)
    # Last lines of an order carry no value even where the column exists.
    seen = F.col("l_linenumber") < 7
    exists = {
        "improvement_surcharge": (tax, F.lit(True)),
        "congestion_surcharge": (discount, year >= F.when(flag == "A", 1997).otherwise(1999)),
        "airport_fee": (tax, (flag != "N") & (year >= 1998)),
        "cbd_congestion_fee": (discount, (flag == "R") & (year >= 2001)),
    }
    columns = []
    for name, (value, there) in exists.items():
        columns.append(F.when(there & seen, value).alias(name))
        columns.append(there.alias(f"{name}_disponible"))
    return t.lineitem.select(
        flag.alias("vehicle_type"), year.alias("year"), F.month("l_shipdate").alias("month"),
        *columns, *keep,
    )


def metric_trips(t: Tables) -> DataFrame:
    """Order date to ship date; every seventh line has no distance."""
    return t.lineitem.select(
        *LINE_KEY,
        "l_shipdate",
        F.when(F.col("l_linenumber") == 7, 0.0).otherwise(F.col("l_quantity"))
        .alias("trip_distance"),
        F.col("l_extendedprice").alias("total_amount"),
    ).join(
        t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        *LINE_KEY,
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        "trip_distance",
        "total_amount",
    )


def _coordinates() -> dict:
    """Where line items begin and end on the part grid."""
    west, south = F.lit(-74.0), F.lit(40.7)
    return {
        "pickup_longitude": west + F.col("l_extendedprice") / 2000000.0,
        "pickup_latitude": south + F.col("l_tax"),
        "dropoff_longitude": west + F.col("l_quantity") / 1000.0,
        "dropoff_latitude": south + F.col("l_discount"),
    }


def located_lines(t: Tables, recorded: bool) -> DataFrame:
    """Line items with coordinates; with ``recorded``, also ids on closed lines."""
    def known(column):
        value = F.when(F.col("l_linestatus") == "F", F.col(column)) if recorded else F.lit(None)
        return value.cast("int")

    return t.lineitem.select(
        *LINE_KEY,
        known("l_suppkey").alias("pu_location_id"),
        known("l_partkey").alias("do_location_id"),
        *[value.alias(name) for name, value in _coordinates().items()],
    )


def part_grid(t: Tables) -> DataFrame:
    """Parts as grid rows; several parts fall into one cell."""
    return t.part.select(
        (F.col("p_size") - 74000).cast("bigint").alias("grid_lon_idx"),
        (40700 + 10 * (F.col("p_partkey") % 11)).cast("bigint").alias("grid_lat_idx"),
        (F.col("p_partkey") % 265 + 1).cast("int").alias("LocationID"),
    )


def bronze_sources(t: Tables) -> list[tuple[str, DataFrame]]:
    """Line items as five eras of source files with drifting names and types."""
    flag, year = F.col("l_returnflag"), F.year("l_shipdate")
    ship = F.col("l_shipdate")
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    discount, tax = F.col("l_discount"), F.col("l_tax")
    later = ship + F.expr("make_dt_interval(0, 0, l_linenumber * 7)")

    def ids(kind, a="PULocationID", b="DOLocationID"):
        return {
            a: (F.col("l_suppkey") % 265 + 1).cast(kind),
            b: (F.col("l_partkey") % 265 + 1).cast(kind),
        }

    def era(vehicle_type, test, columns):
        frame = t.lineitem.filter(test).select(
            *LINE_KEY, *[value.alias(name) for name, value in columns.items()]
        )
        return vehicle_type, frame

    metered = {
        "passenger_count": F.col("l_linenumber").cast("double"),
        "trip_distance": quantity,
        "fare_amount": price,
        "tip_amount": discount,
        "tolls_amount": tax,
        "total_amount": price,
    }
    return [
        era("yellow", (flag == "A") & (year < 1998), {
            "Trip_Pickup_DateTime": ship.cast("string"),
            "Trip_Dropoff_DateTime": later.cast("string"),
            "Start_Lon": _coordinates()["pickup_longitude"],
            "Start_Lat": _coordinates()["pickup_latitude"],
            "End_Lon": _coordinates()["dropoff_longitude"],
            "End_Lat": _coordinates()["dropoff_latitude"],
            "Passenger_Count": F.col("l_linenumber").cast("bigint"),
            "Trip_Distance": quantity,
            "Fare_Amt": price,
            "Total_Amt": price,
        }),
        era("yellow", (flag == "A") & (year >= 1998), {
            "tpep_pickup_datetime": ship,
            "tpep_dropoff_datetime": later,
            **ids("bigint"),
            **metered,
            "improvement_surcharge": F.when(F.col("l_linenumber") < 7, tax),
            "congestion_surcharge": discount,
            "Airport_fee": tax,
        }),
        era("green", flag == "R", {
            "lpep_pickup_datetime": ship,
            "lpep_dropoff_datetime": later,
            **ids("int"),
            **metered,
            "improvement_surcharge": tax,
        }),
        era("fhv", (flag == "N") & (F.col("l_linestatus") == "F"), {
            "pickup_datetime": ship,
            "dropOff_datetime": later,
            **ids("double", "PUlocationID", "DOlocationID"),
        }),
        era("fhvhv", (flag == "N") & (F.col("l_linestatus") == "O"), {
            "pickup_datetime": ship,
            "dropoff_datetime": later,
            **ids("bigint"),
            "trip_miles": F.col("l_quantity").cast("string"),
            "base_passenger_fare": price,
            "tips": discount,
            "tolls": tax,
            "congestion_surcharge": discount,
            "airport_fee": F.when(F.col("l_linenumber") < 7, tax),
            "congestion_fee_cbd": discount,
        }),
    ]


def order_weather(t: Tables) -> DataFrame:
    """Weather of each hour in which orders were placed."""
    price = F.col("o_totalprice")
    return t.orders.groupBy(hour_of(F.col("o_orderdate")).alias("datetime_local")).agg(
        F.max(price).alias("temperature_2m"),
        F.min(price).alias("precipitation"),
        F.min("o_custkey").cast("double").alias("rain"),
        F.max("o_custkey").cast("double").alias("snowfall"),
        F.count("*").alias("weathercode"),
        F.min("o_orderkey").cast("double").alias("windspeed_10m"),
        F.max("o_orderkey").cast("double").alias("relativehumidity_2m"),
    )


# --- suppliers as zone outlines --------------------------------------------


def supplier_rings(t: Tables) -> DataFrame:
    """A diamond per supplier; even nations have a diamond-shaped hole.

    Corners lie half-way between grid nodes, so no node is on an outline.
    """
    x = F.round(F.col("s_acctbal") / 50.0)
    y = (F.col("s_suppkey") * 7 % 200).cast("double")

    def diamond(radius):
        corner = lambda dx, dy: F.struct(
            (x + dx * radius).alias("x"), (y + dy * radius).alias("y")
        )
        return F.array(
            corner(1.0, 0.0), corner(0.0, 1.0), corner(-1.0, 0.0), corner(0.0, -1.0),
            corner(1.0, 0.0),
        )

    outer = (F.col("s_nationkey") % 10 + 2.5).cast("double")
    inner = F.when(F.col("s_nationkey") % 2 == 0, (F.col("s_nationkey") % 3 + 0.5).cast("double"))
    zone = t.supplier.select(
        (F.col("s_suppkey") + 1).cast("int").alias("LocationID"),
        F.array(diamond(outer), F.when(inner.isNotNull(), diamond(inner))).alias("rings"),
    )
    return zone.select("LocationID", F.explode("rings").alias("ring")).filter(
        F.col("ring").isNotNull()
    )


# --- months of orders as monthly files -------------------------------------


def order_months(t: Tables, test=None) -> DataFrame:
    """(vehicle_type, year, month, path, row_count) of months with matching orders."""
    orders = t.orders if test is None else t.orders.filter(test)
    return orders.groupBy(
        F.col("o_orderpriority").alias("vehicle_type"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    ).agg(
        F.concat(F.lit("order-"), F.min("o_orderkey").cast("string")).alias("path"),
        F.count("*").alias("row_count"),
    )


def order_manifest(t: Tables) -> DataFrame:
    return order_months(t, F.col("o_totalprice") > 480000)


def primary_listing(t: Tables) -> DataFrame:
    return order_months(t, (F.col("o_totalprice") > 440000) & (F.col("o_orderstatus") == "O"))


def fallback_listing(t: Tables) -> DataFrame:
    return order_months(t, (F.col("o_totalprice") > 400000) & (F.col("o_orderstatus") == "P"))


def order_types(t: Tables) -> DataFrame:
    """Priorities as vehicle types; service starts with the first very large order."""
    big = F.when(F.col("o_totalprice") > 495000, F.col("o_orderdate"))
    return t.orders.groupBy(F.col("o_orderpriority").alias("vehicle_type")).agg(
        F.year(F.min(big)).alias("start_year"), F.month(F.min(big)).alias("start_month")
    ).withColumn("type_ordinal", F.substring("vehicle_type", 1, 1).cast("int"))
