"""The same queries as plain SQL over the same tables."""

from __future__ import annotations

from tripmart.catalog.queries import (
    CEILING,
    HEATMAP_YEAR,
    MINIMUM,
    PLAN_LIMIT,
    PLAN_MONTHS,
    PLAN_YEARS,
    PRICE_YEARS,
    QUANTILES,
    RATE,
    REGIONS,
    WIDTH,
)
from tripmart.contracts import SAMPLE_FRACTION, SAMPLE_SEED, SURCHARGES, TRIP_WEATHER

KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _cut(fraction: float) -> str:
    return f"{int(fraction * 16**8):08x}"


RIDES = """
    SELECT l_returnflag AS vehicle_type, CAST(year(l_shipdate) AS INTEGER) AS year,
           CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
           CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS nb_courses
    FROM (SELECT *, l_shipdate + to_hours(l_linenumber * 3) AS ts FROM lineitem)
    WHERE ts IS NOT NULL GROUP BY 1, 2, 3, 4"""

FLOWS = """
    SELECT l_returnflag AS vehicle_type, s_nationkey AS pickup_zone_id,
           c_nationkey AS dropoff_zone_id, count(*) AS nb_courses
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    WHERE s_nationkey IS NOT NULL AND c_nationkey IS NOT NULL
    GROUP BY 1, 2, 3"""

BOROUGH_FLOWS = f"""
    SELECT vehicle_type, p.r_name AS pickup_borough, d.r_name AS dropoff_borough,
           CAST(sum(nb_courses) AS BIGINT) AS nb_courses
    FROM ({FLOWS}) f
    LEFT JOIN (SELECT n_nationkey, r_name FROM nation
               LEFT JOIN region ON n_regionkey = r_regionkey) p
           ON f.pickup_zone_id = p.n_nationkey
    LEFT JOIN (SELECT n_nationkey, r_name FROM nation
               LEFT JOIN region ON n_regionkey = r_regionkey) d
           ON f.dropoff_zone_id = d.n_nationkey
    GROUP BY 1, 2, 3"""

# (surcharge, value, condition for the column to exist)
SURCHARGE_ROLES = (
    ("improvement_surcharge", "l_tax", "true"),
    ("congestion_surcharge", "l_discount",
     "year(l_shipdate) >= CASE WHEN l_returnflag = 'A' THEN 1997 ELSE 1999 END"),
    ("airport_fee", "l_tax", "l_returnflag <> 'N' AND year(l_shipdate) >= 1998"),
    ("cbd_congestion_fee", "l_discount", "l_returnflag = 'R' AND year(l_shipdate) >= 2001"),
)
TALL_SURCHARGES = "\n    UNION ALL\n".join(
    f"""    SELECT l_returnflag AS vehicle_type, CAST(year(l_shipdate) AS INTEGER) AS year,
           CAST(month(l_shipdate) AS INTEGER) AS month, '{name}' AS supplement,
           ({test}) AS there,
           CASE WHEN l_linenumber < 7 THEN CAST({value} AS DECIMAL(18,2)) END AS amount
    FROM lineitem"""
    for name, value, test in SURCHARGE_ROLES
)

HOUR_WEATHER = """
    SELECT * EXCLUDE (v, n) FROM (
      SELECT *, row_number() OVER (
          PARTITION BY h ORDER BY temperature_2m IS NULL, temperature_2m, precipitation, rain,
                                  snowfall, weathercode, windspeed_10m) AS n
      FROM (
        SELECT date_trunc('hour', ts) AS h, user_id % 2 AS v,
               max(value) FILTER (user_id % 2 = 0 OR hour(ts) % 3 <> 0) AS temperature_2m,
               min(value) / 10.0::DOUBLE AS precipitation,
               min(value) AS rain, greatest(min(value) - 40.0::DOUBLE, 0.0::DOUBLE) AS snowfall,
               count(*) AS weathercode, max(value) / 2.0::DOUBLE AS windspeed_10m
        FROM events WHERE hour(ts) % 6 <> 5 GROUP BY 1, 2))
    WHERE n = 1"""

ANSWERED = """
    SELECT date_trunc('hour', ts + to_days(CAST(event_id % 24 * 31 AS INTEGER))) AS datetime_local,
           max(value) AS temperature_2m, min(value) AS precipitation, min(value) AS rain, 0.0::DOUBLE AS snowfall,
           count(*) AS weathercode, max(value) AS windspeed_10m,
           CAST(max(user_id) AS DOUBLE) AS relativehumidity_2m
    FROM events GROUP BY 1"""

EVENT_WEATHER = f"""
    SELECT event_id, event_type AS vehicle_type, ts AS pickup_datetime,
           CAST(year(ts) AS INTEGER) AS year, date_trunc('hour', ts) AS pickup_hour_ts,
           value AS price_per_km, w.* EXCLUDE (h)
    FROM events LEFT JOIN ({HOUR_WEATHER}) w ON date_trunc('hour', ts) = w.h"""

PRICED = f"""
    SELECT {KEY}, s_nationkey AS pickup_zone_id, CAST(year(l_shipdate) AS INTEGER) AS year,
           l_extendedprice / (l_quantity * 1.60934::DOUBLE) AS price_per_km
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
    WHERE l_quantity > 0"""
PRICED = f"""
    SELECT * FROM ({PRICED})
    WHERE price_per_km > 0 AND price_per_km < {CEILING} AND pickup_zone_id IS NOT NULL"""

ELIGIBLE = f"""
    SELECT pickup_zone_id, count(*) AS nb_courses FROM ({PRICED})
    GROUP BY 1 HAVING count(*) >= {MINIMUM}"""

# --- harmonised eras: canonical column -> SQL, in canonical order ------------

_TYPES = {
    "pickup_datetime": "TIMESTAMP", "dropoff_datetime": "TIMESTAMP",
    "pu_location_id": "INTEGER", "do_location_id": "INTEGER",
    "pickup_longitude": "DOUBLE", "pickup_latitude": "DOUBLE",
    "dropoff_longitude": "DOUBLE", "dropoff_latitude": "DOUBLE",
    "passenger_count": "INTEGER", "trip_distance": "DOUBLE", "fare_amount": "DOUBLE",
    "tip_amount": "DOUBLE", "tolls_amount": "DOUBLE", "total_amount": "DOUBLE",
}
_TIMES = {
    "pickup_datetime": "l_shipdate",
    "dropoff_datetime": "l_shipdate + to_minutes(l_linenumber * 7)",
}
_IDS = {
    "pu_location_id": "l_suppkey % 265 + 1",
    "do_location_id": "l_partkey % 265 + 1",
}
COORDINATES = {
    "pickup_longitude": "-74.0::DOUBLE + l_extendedprice / 2000000.0::DOUBLE",
    "pickup_latitude": "40.7::DOUBLE + l_tax",
    "dropoff_longitude": "-74.0::DOUBLE + l_quantity / 1000.0::DOUBLE",
    "dropoff_latitude": "40.7::DOUBLE + l_discount",
}
_METERED = {
    "passenger_count": "l_linenumber", "trip_distance": "l_quantity",
    "fare_amount": "l_extendedprice", "tip_amount": "l_discount", "tolls_amount": "l_tax",
    "total_amount": "l_extendedprice",
}
_EARLY = "CASE WHEN l_linenumber < 7 THEN l_tax END"
_ERAS = (
    ("yellow", "l_returnflag = 'A' AND year(l_shipdate) < 1998",
     {**_TIMES, **COORDINATES, "passenger_count": "l_linenumber",
      "trip_distance": "l_quantity", "fare_amount": "l_extendedprice",
      "total_amount": "l_extendedprice"}, {}),
    ("yellow", "l_returnflag = 'A' AND year(l_shipdate) >= 1998",
     {**_TIMES, **_IDS, **_METERED},
     {"improvement_surcharge": _EARLY, "congestion_surcharge": "l_discount",
      "airport_fee": "l_tax"}),
    ("green", "l_returnflag = 'R'",
     {**_TIMES, **_IDS, **_METERED}, {"improvement_surcharge": "l_tax"}),
    ("fhv", "l_returnflag = 'N' AND l_linestatus = 'F'", {**_TIMES, **_IDS}, {}),
    ("fhvhv", "l_returnflag = 'N' AND l_linestatus = 'O'",
     {**_TIMES, **_IDS, "trip_distance": "l_quantity", "fare_amount": "l_extendedprice",
      "tip_amount": "l_discount", "tolls_amount": "l_tax",
      "total_amount": "l_extendedprice"},
     {"congestion_surcharge": "l_discount", "airport_fee": _EARLY,
      "cbd_congestion_fee": "l_discount"}),
)


def _era(vehicle_type, test, core, extras):
    columns = [f"'{vehicle_type}' AS vehicle_type"]
    columns += [f"CAST({core.get(c, 'NULL')} AS {k}) AS {c}" for c, k in _TYPES.items()]
    for name in SURCHARGES:
        columns.append(f"CAST({extras.get(name, 'NULL')} AS DOUBLE) AS {name}")
        columns.append(f"{str(name in extras).lower()} AS {name}_disponible")
    return f"    SELECT {', '.join(columns)}, {KEY}\n    FROM lineitem WHERE {test}"


HARMONIZED = "\n    UNION ALL\n".join(_era(*e) for e in _ERAS)

CELLS = """
    SELECT p_size - 74000 AS i, 40700 + 10 * (p_partkey % 11) AS j,
           CAST(min(p_partkey % 265 + 1) AS INTEGER) AS zone
    FROM part GROUP BY 1, 2"""


def _index(expression: str) -> str:
    return f"CAST(round(({expression}) / 0.001::DOUBLE) AS BIGINT)"


def _located(source: str, lon_lat: dict, pickup: str, dropoff: str, columns: str) -> str:
    on = {
        end: f"{_index(lon_lat[f'{end}_longitude'])} = {a}.i"
             f" AND {_index(lon_lat[f'{end}_latitude'])} = {a}.j"
        for end, a in (("pickup", "a"), ("dropoff", "b"))
    }
    return f"""
    SELECT {columns}, CAST(coalesce({pickup}, a.zone) AS INTEGER) AS pickup_zone_id,
           CAST(coalesce({dropoff}, b.zone) AS INTEGER) AS dropoff_zone_id
    FROM {source} s
    LEFT JOIN ({CELLS}) a ON {on['pickup']}
    LEFT JOIN ({CELLS}) b ON {on['dropoff']}"""


ORDER_WEATHER = """
    SELECT date_trunc('hour', o_orderdate) AS datetime_local,
           max(o_totalprice) AS temperature_2m, min(o_totalprice) AS precipitation,
           CAST(min(o_custkey) AS DOUBLE) AS rain, CAST(max(o_custkey) AS DOUBLE) AS snowfall,
           count(*) AS weathercode, CAST(min(o_orderkey) AS DOUBLE) AS windspeed_10m,
           CAST(max(o_orderkey) AS DOUBLE) AS relativehumidity_2m
    FROM orders GROUP BY 1"""

METRICS = """
    date_diff('second', date_trunc('second', pickup_datetime),
              date_trunc('second', dropoff_datetime)) / 60.0::DOUBLE AS trip_duration_min,
    CASE WHEN trip_distance > 0
         THEN total_amount / (trip_distance * 1.60934::DOUBLE) END AS price_per_km,
    CAST(year(pickup_datetime) AS INTEGER) AS year,
    CAST(month(pickup_datetime) AS INTEGER) AS month,
    date_trunc('hour', pickup_datetime) AS pickup_hour_ts"""

_KEPT = [c for c in _TYPES if not c.endswith(("_id", "_longitude", "_latitude"))]
_FLAGS = [n for s in SURCHARGES for n in (s, f"{s}_disponible")]
SILVER = f"""
    SELECT m.*, {', '.join(f'w.{v}' for v in TRIP_WEATHER)}
    FROM (SELECT *, {METRICS} FROM ({_located(
        f'({HARMONIZED})',
        {c: f's.{c}' for c in COORDINATES},
        's.pu_location_id', 's.do_location_id',
        ', '.join(f's.{c}' for c in ('vehicle_type', *_KEPT, *_FLAGS, *KEY.split(', '))),
    )})) m
    LEFT JOIN ({ORDER_WEATHER}) w ON m.pickup_hour_ts = w.datetime_local"""

RINGS = """
    SELECT CAST(s_suppkey + 1 AS INTEGER) AS LocationID,
           CAST(round(s_acctbal / 50.0::DOUBLE) AS BIGINT) AS cx, s_suppkey * 7 % 200 AS cy,
           s_nationkey % 10 + 2.5 AS outside,
           CASE WHEN s_nationkey % 2 = 0 THEN s_nationkey % 3 + 0.5 ELSE -1 END AS inside
    FROM supplier"""
NODES = f"""
    SELECT cx + dx AS grid_lon_idx, cy + dy AS grid_lat_idx, LocationID
    FROM ({RINGS}), (SELECT unnest(range(-12, 13)) AS dx), (SELECT unnest(range(-12, 13)) AS dy)
    WHERE abs(dx) + abs(dy) < outside AND abs(dx) + abs(dy) > inside
      AND cx + dx >= 0 AND cx + dx < 200 AND cy + dy >= 0 AND cy + dy < 200"""

MONTHS = """
    SELECT o_orderpriority AS vehicle_type, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month,
           'order-' || min(o_orderkey) AS path, count(*) AS row_count
    FROM orders WHERE {test} GROUP BY 1, 2, 3"""
ALL_MONTHS = MONTHS.format(test="true")
MANIFEST = MONTHS.format(test="o_totalprice > 480000")
PRIMARY = MONTHS.format(test="o_totalprice > 440000 AND o_orderstatus = 'O'")
FALLBACK = MONTHS.format(test="o_totalprice > 400000 AND o_orderstatus = 'P'")

PLAN = f"""
    SELECT vehicle_type, type_ordinal, CAST(year_ordinal AS INTEGER) AS year_ordinal,
           CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month
    FROM (SELECT o_orderpriority AS vehicle_type,
                 CAST(left(o_orderpriority, 1) AS INTEGER) AS type_ordinal,
                 min(o_orderdate) FILTER (o_totalprice > 495000) AS start
          FROM orders GROUP BY 1, 2) types,
         (VALUES {', '.join(f'({i}, {y})' for i, y in enumerate(PLAN_YEARS))}) AS years(year_ordinal, y),
         (SELECT unnest(range({PLAN_MONTHS[0]}, {PLAN_MONTHS[1]} + 1)) AS m)
    WHERE y * 12 + m >= year(start) * 12 + month(start)"""
PENDING = f"""
    SELECT * FROM ({PLAN}) p ANTI JOIN ({MANIFEST}) m USING (vehicle_type, year, month)"""
RESOLVED = f"""
    SELECT p.*, coalesce(a.path, b.path) AS path,
           CASE WHEN a.path IS NOT NULL THEN 'primary'
                WHEN b.path IS NOT NULL THEN 'fallback' END AS origin
    FROM ({PENDING}) p
    LEFT JOIN ({PRIMARY}) a USING (vehicle_type, year, month)
    LEFT JOIN ({FALLBACK}) b USING (vehicle_type, year, month)"""
STATUS = f"""
    SELECT vehicle_type, year, month,
           CASE WHEN m.path IS NOT NULL THEN 'skipped'
                WHEN r.path IS NOT NULL THEN 'ingested' ELSE 'not_published' END AS status
    FROM ({PLAN}) p
    LEFT JOIN ({MANIFEST}) m USING (vehicle_type, year, month)
    LEFT JOIN ({RESOLVED}) r USING (vehicle_type, year, month)"""

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _states() -> str:
    def one(s):
        flag = f"{s}_disponible"
        return f"""
    SELECT vehicle_type, '{s}' AS supplement, count(*) FILTER (NOT {flag}) AS absent,
           count(*) FILTER ({flag} AND {s} IS NULL) AS missing,
           count(*) FILTER ({flag} AND {s} = 0) AS zero,
           count(*) FILTER ({flag} AND {s} <> 0) AS charged
    FROM ({HARMONIZED}) GROUP BY 1"""
    return "\n    UNION ALL".join(one(s) for s in SURCHARGES)


def oracle_sql() -> dict[str, str]:
    recorded = "CASE WHEN l_linestatus = 'F' THEN {} END"
    found = {
        "rides_by_dow_hour": RIDES,
        "heatmap_pivot": f"""
    SELECT day_of_week, {', '.join(
        f"CAST(coalesce(sum(nb_courses) FILTER (hour_of_day = {h}), 0) AS BIGINT) AS h{h}"
        for h in range(24))}
    FROM ({RIDES}) WHERE year = {HEATMAP_YEAR} GROUP BY 1""",
        "flows_by_zone": FLOWS,
        "flows_by_borough": BOROUGH_FLOWS,
        "flow_matrix": f"""
    SELECT pickup_borough, {', '.join(
        f'''CAST(coalesce(sum(nb_courses) FILTER (dropoff_borough = '{r}'), 0) AS BIGINT)
            AS "{r}"''' for r in REGIONS)},
           CAST(coalesce(sum(nb_courses) FILTER (dropoff_borough NOT IN ({', '.join(f"'{r}'" for r in REGIONS)})), 0)
                AS BIGINT) AS other,
           CAST(coalesce(sum(nb_courses) FILTER (dropoff_borough IS NULL), 0) AS BIGINT) AS unknown,
           CAST(sum(nb_courses) AS BIGINT) AS total
    FROM ({BOROUGH_FLOWS}) GROUP BY 1""",
        "surcharge_evolution": f"""
    SELECT vehicle_type, year, month, supplement,
           CAST(sum(amount) AS DOUBLE) / nullif(count(amount), 0) AS montant_moyen,
           CAST(sum(amount) AS DOUBLE) AS montant_total, count(*) AS nb_courses
    FROM ({TALL_SURCHARGES}) WHERE there GROUP BY 1, 2, 3, 4""",
        "surcharge_availability": f"""
    SELECT vehicle_type, supplement, count(*) FILTER (there) AS months_available,
           count(*) AS months_present, count(*) FILTER (there) / count(*) AS share
    FROM (SELECT vehicle_type, year, month, supplement, bool_or(there) AS there
          FROM ({TALL_SURCHARGES}) GROUP BY 1, 2, 3, 4)
    GROUP BY 1, 2""",
        "price_by_weather": f"""
    WITH base AS (
      SELECT * REPLACE (CAST(price_per_km AS DECIMAL(18,2)) AS price_per_km),
             CASE WHEN snowfall > 0 THEN 'neige' WHEN precipitation > 2 THEN 'pluie_forte'
                     WHEN precipitation > 0 THEN 'pluie_legere'
                     WHEN windspeed_10m > 40 THEN 'vent_fort' ELSE 'normal' END AS weather_bucket
      FROM ({EVENT_WEATHER})
      WHERE price_per_km > 0 AND price_per_km < 50 AND temperature_2m IS NOT NULL),
    general AS (SELECT CAST(sum(price_per_km) AS DOUBLE) / count(*) AS g FROM base),
    buckets AS (
      SELECT vehicle_type, weather_bucket,
             CAST(sum(price_per_km) AS DOUBLE) / count(*) AS b, count(*) AS n
      FROM base GROUP BY 1, 2)
    SELECT vehicle_type, weather_bucket, b AS prix_moyen_bucket, n AS nb_courses,
           g AS prix_moyen_general, (b - g) / g * 100 AS ecart_pct
    FROM buckets, general""",
        "zone_volumes": f"""
    SELECT pickup_zone_id, count(*) AS nb_courses FROM ({PRICED}) GROUP BY 1""",
        "eligible_zones": ELIGIBLE,
        "trips_in_eligible_zones": f"""
    SELECT * FROM ({PRICED}) WHERE pickup_zone_id IN (SELECT pickup_zone_id FROM ({ELIGIBLE}))""",
        "price_sample": f"""
    SELECT pickup_zone_id, year, price_per_km FROM ({PRICED})
    WHERE pickup_zone_id IN (SELECT pickup_zone_id FROM ({ELIGIBLE}))
      AND year IN ({', '.join(map(str, PRICE_YEARS))})
      AND left(md5(concat_ws('|', '{SAMPLE_SEED}', {KEY})), 8) < '{_cut(RATE)}'""",
        "sampled_trips": f"""
    SELECT event_id, event_type, value FROM events
    WHERE left(md5(concat_ws('|', '{SAMPLE_SEED}', event_id)), 8) < '{_cut(SAMPLE_FRACTION)}'""",
        "price_histogram": f"""
    SELECT pickup_zone_id, year, CAST(floor(price_per_km / {WIDTH}::DOUBLE) AS BIGINT) AS bin,
           count(*) AS nb_courses
    FROM ({PRICED}) GROUP BY 1, 2, 3""",
        "price_quantiles": "\n    UNION ALL\n".join(f"""
    SELECT pickup_zone_id, year, {q}::DOUBLE AS quantile,
           round(quantile_cont(price_per_km, {q}), 6) AS price
    FROM ({PRICED}) GROUP BY 1, 2""" for q in QUANTILES),
        "price_sketch_ranks": "\n    UNION ALL\n".join(f"""
    SELECT pickup_zone_id, year, {q}::DOUBLE AS quantile, count(*) AS nb_courses, true AS within_error
    FROM ({PRICED}) GROUP BY 1, 2""" for q in QUANTILES),
        "sample_in_bounds": f"""
    SELECT year, count(*) AS rows, true AS within_bounds FROM ({PRICED}) GROUP BY 1""",
        "harmonized_trips": HARMONIZED,
        "absent_vs_null_vs_zero": _states(),
        "grid_resolve": _located("lineitem", COORDINATES, "NULL", "NULL", KEY),
        "zone_coalesce": _located(
            "lineitem", COORDINATES, recorded.format("l_suppkey"),
            recorded.format("l_partkey"), KEY),
        "trip_metrics": f"""
    SELECT *, {METRICS} FROM (
      SELECT {KEY}, o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
             CASE WHEN l_linenumber = 7 THEN 0.0::DOUBLE ELSE l_quantity END AS trip_distance,
             l_extendedprice AS total_amount
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
        "weather_join": EVENT_WEATHER,
        "silver_weather": f"""
    SELECT *, CAST(year(datetime_local) AS INTEGER) AS year,
           CAST(month(datetime_local) AS INTEGER) AS month FROM ({ORDER_WEATHER})""",
        "silver_trips": SILVER,
        "silver_rides": f"""
    SELECT vehicle_type, year, CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week,
           CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day, count(*) AS nb_courses
    FROM ({SILVER}) WHERE pickup_datetime IS NOT NULL GROUP BY 1, 2, 3, 4""",
        "weather_json_rows": ANSWERED,
        "weather_json_gaps": f"""
    SELECT CASE WHEN m <> 3 OR n > 1 THEN datetime_local END AS datetime_local, temperature_2m, precipitation,
           CASE WHEN m <> 0 THEN rain END AS rain, CASE WHEN m <> 1 THEN snowfall END AS snowfall, weathercode,
           CASE WHEN m <> 2 OR n <= total - 5 THEN windspeed_10m END AS windspeed_10m, relativehumidity_2m
    FROM (SELECT *, month(datetime_local) % 4 AS m, row_number() OVER (w ORDER BY datetime_local) AS n,
                 count(*) OVER w AS total
          FROM ({ANSWERED}) WINDOW w AS (PARTITION BY date_trunc('month', datetime_local)))""",
        "nodes_in_zones": NODES,
        "zone_grid_build": f"""
    SELECT grid_lon_idx, grid_lat_idx, min(LocationID) AS LocationID
    FROM ({NODES}) GROUP BY 1, 2""",
        "file_row_counts": "\n    UNION ALL\n".join(
            f"    SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}"
            for name in TABLES),
        "month_calendar": """
    SELECT vehicle_type, CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month
    FROM (SELECT o_orderpriority AS vehicle_type,
                 unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                        date_trunc('month', max(o_orderdate)),
                                        INTERVAL 1 MONTH)) AS m
          FROM orders GROUP BY 1)""",
        "ingest_plan": PLAN,
        "ingest_first_months": f"""
    SELECT * FROM ({PLAN}) ORDER BY type_ordinal, year_ordinal, month LIMIT {PLAN_LIMIT}""",
        "ingest_pending": PENDING,
        "source_priority": RESOLVED,
        "ingest_month_status": STATUS,
        "ingest_status": f"""
    SELECT status, count(*) AS months FROM ({STATUS}) GROUP BY 1""",
        "ingest_types": f"SELECT DISTINCT vehicle_type FROM ({ALL_MONTHS})",
        "ingest_inventory": f"""
    SELECT vehicle_type, min(year * 100 + month) AS first_ym, max(year * 100 + month) AS last_ym,
           count(DISTINCT year * 100 + month) AS months,
           CAST(sum(row_count) AS BIGINT) AS row_count
    FROM ({ALL_MONTHS}) GROUP BY 1""",
        "ingest_coverage": f"""
    SELECT * FROM ({PLAN}) SEMI JOIN ({MANIFEST}) m USING (vehicle_type, year, month)""",
    }
    # Put together from months, a report is the same.
    for name, whole in (("monthly_rides", "rides_by_dow_hour"), ("monthly_flows", "flows_by_zone"),
                        ("monthly_surcharges", "surcharge_evolution"), ("monthly_weather_prices", "price_by_weather")):
        found[name] = found[whole]
    return found
