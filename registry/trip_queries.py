"""Trip queries: clean, star schema, marts, enrichment, reports, legacy marts."""

from pyspark.sql import functions as F

from registry.inputs import areas, fact, hours, load, plain, raw_trips, typed_trips
from tablemart.plans import enrichment, legacy, marts, reports, trips
from tablemart.plans.naming import published

QUERIES, ORACLES = {}, {}


def query(sql):
    """Register a function under its own name, with its SQL twin."""

    def register(function):
        QUERIES[function.__name__] = lambda spark, folder: plain(function(spark, folder))
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


TEXT = """
text AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS trip_id, 'taxi-' || user_id AS taxi_id, ts,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS trip_start_timestamp,
    CAST(event_id % 3600 AS VARCHAR) AS trip_seconds,
    json_extract_string(props, '$.k') || '.' || (event_id % 10) AS trip_miles,
    CAST(CAST(value AS DECIMAL(20,2)) AS VARCHAR) AS fare,
    CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 7 AS VARCHAR) END AS tips,
    CAST(CAST(value AS DECIMAL(20,2)) AS VARCHAR) AS trip_total,
    event_type AS payment_type, 'Company ' || (event_id % 4) AS company,
    CAST(user_id % 27 AS VARCHAR) AS pickup_community_area,
    CAST(event_id % 27 AS VARCHAR) AS dropoff_community_area
  FROM events)
"""
FACT = TEXT + """,
fact AS (
  SELECT trip_id, taxi_id, payment_type, company, pickup_community_area, dropoff_community_area,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS trip_date, CAST(extract(hour FROM ts) AS INTEGER) AS trip_hour,
    CAST(trip_seconds AS DECIMAL(20,6)) AS trip_seconds, CAST(trip_miles AS DECIMAL(20,6)) AS trip_miles,
    CAST(fare AS DECIMAL(20,6)) AS fare, CAST(tips AS DECIMAL(20,6)) AS tips,
    CAST(trip_total AS DECIMAL(20,6)) AS trip_total,
    CAST(CAST(trip_miles AS DECIMAL(16,6)) * CAST(1.609344 AS DECIMAL(10,6)) AS DECIMAL(24,6)) AS distance_km
  FROM text)
"""
BROKEN = """
text AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS trip_id, ts,
    CASE WHEN event_id % 11 = 0 THEN '   ' ELSE 'taxi-' || user_id END AS taxi_id,
    CASE WHEN event_id % 19 = 0 THEN 'invalid' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS trip_start_timestamp,
    CAST(event_id % 3600 AS VARCHAR) AS trip_seconds,
    CASE WHEN event_id % 37 = 0 THEN '12345678901234567890'
         ELSE json_extract_string(props, '$.k') || '.' || (event_id % 10) END AS trip_miles,
    CASE WHEN event_id % 17 = 0 THEN 'broken' ELSE CAST(CAST(value AS DECIMAL(20,2)) AS VARCHAR) END AS fare,
    CASE WHEN event_id % 29 = 0 THEN '-2' WHEN event_id % 31 = 0 THEN 'abc'
         WHEN event_id % 5 <> 0 THEN CAST(event_id % 7 AS VARCHAR) END AS tips,
    CASE WHEN event_id % 23 = 0 THEN '-1' ELSE CAST(CAST(value AS DECIMAL(20,2)) AS VARCHAR) END AS trip_total,
    CASE WHEN event_id % 41 = 0 THEN '' ELSE event_type END AS payment_type,
    CASE WHEN event_id % 13 = 0 THEN ' padded ' ELSE 'Company ' || (event_id % 4) END AS company,
    CASE WHEN event_id % 7 = 0 THEN '08' ELSE CAST(user_id % 27 AS VARCHAR) END AS pickup_community_area,
    CAST(event_id % 27 AS VARCHAR) AS dropoff_community_area
  FROM events),
numbers AS (
  SELECT *, TRY_CAST(trip_start_timestamp AS TIMESTAMP) AS started,
    TRY_CAST(trip_seconds AS DECIMAL(20,6)) AS n_seconds, TRY_CAST(trip_miles AS DECIMAL(20,6)) AS n_miles,
    TRY_CAST(fare AS DECIMAL(20,6)) AS n_fare, TRY_CAST(tips AS DECIMAL(20,6)) AS n_tips,
    TRY_CAST(trip_total AS DECIMAL(20,6)) AS n_total
  FROM text),
typed AS (
  SELECT *, concat_ws(';',
    CASE WHEN started IS NULL THEN 'invalid_timestamp' END,
    CASE WHEN n_seconds IS NULL OR n_seconds < 0 THEN 'invalid_trip_seconds' END,
    CASE WHEN n_miles IS NULL OR n_miles < 0 THEN 'invalid_trip_miles' END,
    CASE WHEN n_fare IS NULL OR n_fare < 0 THEN 'invalid_fare' END,
    CASE WHEN n_total IS NULL OR n_total < 0 THEN 'invalid_trip_total' END,
    CASE WHEN n_tips < 0 THEN 'negative_tips' END) AS rejection_reason,
    coalesce(nullif(trim(taxi_id), ''), 'Unknown') AS taxi,
    coalesce(nullif(trim(payment_type), ''), 'Unknown') AS payment,
    coalesce(nullif(trim(company), ''), 'Unknown') AS firm
  FROM numbers)
"""
WEATHER = """
per_hour AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1),
raw_hours AS (
  SELECT hour, CASE WHEN n % 11 <> 0 THEN CAST(n % 25 AS DOUBLE) END AS temperature_2m,
    CAST(n % 3 AS DOUBLE) AS precipitation, CASE WHEN n % 4 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS snowfall
  FROM per_hour WHERE n % 13 <> 0),
twice AS (
  SELECT * FROM raw_hours UNION ALL
  SELECT * FROM raw_hours WHERE extract(hour FROM hour) = 1 AND extract(day FROM hour) % 5 = 0),
hours AS (
  SELECT strftime(hour, '%Y-%m-%dT%H:00:00') AS weather_local_hour, count(*) AS source_hours,
    CASE WHEN count(*) = 1 THEN max(temperature_2m) END AS temperature_2m,
    CASE WHEN count(*) = 1 THEN max(precipitation) END AS precipitation,
    CASE WHEN count(*) = 1 THEN max(snowfall) END AS snowfall,
    count(*) > 1 AS weather_ambiguous
  FROM twice GROUP BY 1)
"""
ENRICHED = FACT + "," + WEATHER + """,
enriched AS (
  SELECT f.*, coalesce(p.n_name, 'Unknown') AS pickup_area_name, coalesce(d.n_name, 'Unknown') AS dropoff_area_name,
    h.temperature_2m, h.precipitation, h.snowfall,
    coalesce(h.weather_ambiguous, FALSE) AS weather_ambiguous,
    h.temperature_2m IS NOT NULL AND h.precipitation IS NOT NULL AND h.snowfall IS NOT NULL AS weather_available
  FROM fact f
  LEFT JOIN nation p ON CAST(p.n_nationkey AS VARCHAR) = f.pickup_community_area
  LEFT JOIN nation d ON CAST(d.n_nationkey AS VARCHAR) = f.dropoff_community_area
  LEFT JOIN hours h ON h.weather_local_hour = f.trip_date || 'T' || lpad(CAST(f.trip_hour AS VARCHAR), 2, '0') || ':00:00'),
judged AS (
  SELECT *, CASE WHEN weather_ambiguous THEN 'Ambiguous DST hour' WHEN NOT weather_available THEN 'Unavailable'
    WHEN snowfall > 0 THEN 'Snow' WHEN precipitation > 0 THEN 'Wet' ELSE 'Dry' END AS weather_condition
  FROM enriched)
"""


# --- clean ------------------------------------------------------------------------------


@query(f"""WITH {BROKEN} SELECT trip_id, taxi AS taxi_id, payment AS payment_type, firm AS company,
  CAST(n_seconds AS DOUBLE) AS trip_seconds, CAST(n_miles AS DOUBLE) AS trip_miles, CAST(n_fare AS DOUBLE) AS fare,
  CAST(coalesce(n_tips, -1) AS DOUBLE) AS tips, CAST(n_total AS DOUBLE) AS trip_total,
  CAST(CAST(started AS DATE) AS VARCHAR) AS trip_date, CAST(extract(hour FROM started) AS INTEGER) AS trip_hour,
  CAST(CAST(CAST(n_miles AS DECIMAL(16,6)) * CAST(1.609344 AS DECIMAL(10,6)) AS DECIMAL(24,6)) AS DOUBLE) AS distance_km
  FROM typed WHERE rejection_reason = ''""")
def clean_accepted(spark, folder):
    good = trips.accepted(typed_trips(spark, folder, faults=True))
    return good.select(
        "trip_id", "taxi_id", "payment_type", "company", "trip_seconds", "trip_miles", "fare",
        F.coalesce("tips", F.lit(-1)).alias("tips"), "trip_total", "trip_date", "trip_hour", "distance_km",
    )


@query(f"""WITH {BROKEN} SELECT trip_id, trip_start_timestamp, taxi AS taxi_id, rejection_reason
  FROM typed WHERE rejection_reason <> ''""")
def clean_quarantine(spark, folder):
    bad = trips.quarantined(typed_trips(spark, folder, faults=True))
    return bad.select("trip_id", "trip_start_timestamp", "taxi_id", "rejection_reason")


@query(f"""WITH {BROKEN} SELECT rejection_reason, count(*) AS trips FROM typed GROUP BY 1""")
def reason_counts(spark, folder):
    return typed_trips(spark, folder, faults=True).groupBy("rejection_reason").agg(F.count("*").alias("trips"))


# --- star schema ------------------------------------------------------------------------


@query(f"WITH {FACT} SELECT DISTINCT taxi_id, sha256(taxi_id) AS taxi_key FROM fact")
def dim_taxi(spark, folder):
    return trips.dimension(fact(spark, folder), "taxi")


@query(f"WITH {FACT} SELECT DISTINCT payment_type, sha256(payment_type) AS payment_key FROM fact")
def dim_payment(spark, folder):
    return trips.dimension(fact(spark, folder), "payment")


@query(f"WITH {FACT} SELECT DISTINCT company, sha256(company) AS company_key FROM fact")
def dim_company(spark, folder):
    return trips.dimension(fact(spark, folder), "company")


@query(f"""WITH {FACT}, u AS (SELECT pickup_community_area AS area FROM fact UNION SELECT dropoff_community_area FROM fact)
  SELECT area, sha256(area) AS area_key FROM u""")
def dim_area(spark, folder):
    return trips.dimension(fact(spark, folder), "area")


@query(f"""WITH {FACT} SELECT DISTINCT trip_date, CAST(extract(year FROM CAST(trip_date AS DATE)) AS INTEGER) AS year,
  CAST(extract(month FROM CAST(trip_date AS DATE)) AS INTEGER) AS month,
  CAST(extract(dow FROM CAST(trip_date AS DATE)) + 1 AS INTEGER) AS day_of_week FROM fact""")
def dim_date(spark, folder):
    return trips.date_dimension(fact(spark, folder))


KEYS = """sha256(taxi_id) AS taxi_key, sha256(payment_type) AS payment_key, sha256(company) AS company_key,
  sha256(pickup_community_area) AS pickup_area_key, sha256(dropoff_community_area) AS dropoff_area_key"""
KEY_COLUMNS = ["trip_id", *trips.FACT_KEYS]


@query(f"WITH {FACT} SELECT trip_id, {KEYS} FROM fact")
def fact_keys(spark, folder):
    return fact(spark, folder).select(*KEY_COLUMNS)


@query(f"""WITH {FACT},
  taxi AS (SELECT DISTINCT taxi_id, sha256(taxi_id) AS taxi_key FROM fact WHERE taxi_id <> 'taxi-7'),
  payment AS (SELECT DISTINCT payment_type, sha256(payment_type) AS payment_key FROM fact),
  company AS (SELECT DISTINCT company, sha256(company) AS company_key FROM fact),
  area AS (SELECT pickup_community_area AS area, sha256(pickup_community_area) AS area_key FROM fact
           UNION SELECT dropoff_community_area, sha256(dropoff_community_area) FROM fact)
  SELECT trip_id, coalesce(taxi_key, 'none') AS taxi_key, payment_key, company_key, p.area_key AS pickup_area_key,
    d.area_key AS dropoff_area_key
  FROM fact LEFT JOIN taxi USING (taxi_id) LEFT JOIN payment USING (payment_type) LEFT JOIN company USING (company)
  LEFT JOIN area p ON p.area = pickup_community_area LEFT JOIN area d ON d.area = dropoff_community_area""")
def fact_key_lookup(spark, folder):
    """Keys from dimension tables, one taxi missing there."""
    good = trips.accepted(typed_trips(spark, folder))
    dimensions = {name: trips.dimension(good, name) for name in trips.DIMENSIONS}
    dimensions["taxi"] = dimensions["taxi"].filter(F.col("taxi_id") != "taxi-7")
    keyed = trips.with_looked_up_keys(good, dimensions).select(*KEY_COLUMNS)
    return keyed.withColumn("taxi_key", F.coalesce("taxi_key", F.lit("none")))


# --- marts ------------------------------------------------------------------------------


@query(f"""WITH {FACT} SELECT trip_date, count(*) AS trips, CAST(sum(trip_total) AS DOUBLE) AS revenue_usd,
  CAST(sum(tips) AS DOUBLE) AS tips_usd, round(CAST(sum(distance_km) AS DOUBLE) / count(*), 6) AS average_distance_km,
  round(CAST(sum(trip_total) AS DOUBLE) / count(*), 6) AS average_trip_usd FROM fact GROUP BY 1""")
def daily_demand(spark, folder):
    return marts.mart(fact(spark, folder), "gold.mart_daily").withColumns(
        {name: F.round(F.col(name).cast("double"), 6) for name in ("average_distance_km", "average_trip_usd")}
    )


@query(f"""WITH {FACT} SELECT trip_date, trip_hour, count(*) AS trips, CAST(sum(trip_total) AS DOUBLE) AS revenue_usd
  FROM fact GROUP BY 1, 2""")
def hourly_demand(spark, folder):
    return marts.mart(fact(spark, folder), "gold.mart_hourly")


@query(f"""WITH {FACT} SELECT trip_date, payment_type, count(*) AS trips, CAST(sum(trip_total) AS DOUBLE) AS revenue_usd
  FROM fact GROUP BY 1, 2""")
def payment_mix(spark, folder):
    return marts.mart(fact(spark, folder), "gold.mart_payment")


@query(f"""WITH {FACT} SELECT trip_date, sha256(taxi_id) AS taxi_key, taxi_id AS taxi_label, count(*) AS trips,
  CAST(sum(trip_total) AS DOUBLE) AS reported_total_usd FROM fact GROUP BY trip_date, taxi_id""")
def taxi_revenue(spark, folder):
    return marts.mart(fact(spark, folder), "gold.mart_taxi_earnings")


@query(f"""WITH {FACT} SELECT trip_id, trip_date, taxi_id, CAST(distance_km AS DOUBLE) AS distance_km,
  pickup_community_area, dropoff_community_area, distance_km > 0 AS is_positive_distance FROM fact""")
def trip_distance(spark, folder):
    return marts.trip_distances(fact(spark, folder))


# --- enrichment -------------------------------------------------------------------------


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS area_id, n_name AS area_name FROM nation""")
def dim_community_area(spark, folder):
    return areas(spark, folder).select("area_id", "area_name")


@query(f"""WITH {WEATHER} SELECT weather_local_hour, source_hours, coalesce(temperature_2m, -1) AS temperature_2m,
  coalesce(precipitation, -1) AS precipitation, coalesce(snowfall, -1) AS snowfall, weather_ambiguous FROM hours""")
def dim_weather_hour(spark, folder):
    return hours(spark, folder).withColumns(
        {name: F.coalesce(name, F.lit(-1.0)) for name in enrichment.WEATHER}
    )


@query(f"""WITH {ENRICHED} SELECT trip_id, pickup_community_area AS pickup_area_id, dropoff_community_area AS dropoff_area_id,
  pickup_area_name, dropoff_area_name, coalesce(temperature_2m, -1) AS temperature_2m, weather_ambiguous,
  weather_available, weather_condition, CAST(trip_total AS DOUBLE) AS trip_total FROM judged""")
def enriched_trips(spark, folder):
    rows = enrichment.enriched_trips(fact(spark, folder), areas(spark, folder), hours(spark, folder))
    return rows.select(
        "trip_id", "pickup_area_id", "dropoff_area_id", "pickup_area_name", "dropoff_area_name",
        F.coalesce("temperature_2m", F.lit(-1.0)).alias("temperature_2m"), "weather_ambiguous",
        "weather_available", "weather_condition", "trip_total",
    )


WEATHER_DEMAND = f"""WITH {ENRICHED}, demand AS (
  SELECT trip_date, trip_hour, weather_condition, count(*) AS trips, CAST(sum(trip_total) AS DOUBLE) AS reported_total_usd,
  round(CAST(sum(trip_seconds) AS DOUBLE) / count(*), 6) AS average_trip_seconds, max(temperature_2m) AS temperature_2m,
  max(precipitation) AS precipitation, max(snowfall) AS snowfall FROM judged GROUP BY 1, 2, 3)
"""


@query(WEATHER_DEMAND + "SELECT * FROM demand")
def weather_demand(spark, folder):
    rows = enrichment.weather_demand(fact(spark, folder), hours(spark, folder))
    rounded = {"average_trip_seconds": F.round(F.col("average_trip_seconds").cast("double"), 6)}
    return rows.withColumns(rounded)


AREA_DEMAND = f"""WITH {ENRICHED}, sides AS (
  SELECT trip_date, pickup_community_area AS area_id, pickup_area_name AS area_name, 'Pickup' AS activity, trip_total FROM judged
  UNION ALL SELECT trip_date, dropoff_community_area, dropoff_area_name, 'Dropoff', trip_total FROM judged),
demand AS (SELECT trip_date, area_id, area_name, activity, count(*) AS trips, CAST(sum(trip_total) AS DOUBLE) AS reported_total_usd
  FROM sides GROUP BY 1, 2, 3, 4)
"""


@query(AREA_DEMAND + "SELECT * FROM demand")
def area_demand(spark, folder):
    return enrichment.area_demand(fact(spark, folder), areas(spark, folder))


# --- reports ----------------------------------------------------------------------------


def _enriched(spark, folder):
    return published(
        enrichment.enriched_trips(fact(spark, folder), areas(spark, folder), hours(spark, folder))
    )


def _distances(spark, folder):
    return published(marts.trip_distances(fact(spark, folder)))


@query(f"""WITH {FACT}, b AS (SELECT max(distance_km) AS hi, min(CASE WHEN distance_km > 0 THEN distance_km END) AS lo FROM fact)
  SELECT 'longest' AS extreme, trip_id, CAST(distance_km AS DOUBLE) AS trip_distance_km FROM fact, b WHERE distance_km = hi
  UNION ALL SELECT 'shortest', trip_id, CAST(distance_km AS DOUBLE) FROM fact, b WHERE distance_km = lo""")
def extremes_with_ties(spark, folder):
    return reports.extreme_trips(_distances(spark, folder)).select("extreme", "trip_id", "trip_distance_km")


@query(f"""WITH {FACT} SELECT CAST(max(distance_km) AS DOUBLE) AS longest_km,
  CAST(min(CASE WHEN distance_km > 0 THEN distance_km END) AS DOUBLE) AS shortest_positive_km FROM fact""")
def distance_range(spark, folder):
    return reports.distance_range(_distances(spark, folder))


@query(f"""WITH {FACT} SELECT sha256(taxi_id) AS taxi_key, taxi_id AS taxi_label, count(*) AS trips,
  CAST(sum(trip_total) AS DOUBLE) AS reported_total_usd FROM fact WHERE trip_date BETWEEN '2024-01-05' AND '2024-01-20'
  GROUP BY taxi_id ORDER BY sum(trip_total) DESC, sha256(taxi_id) LIMIT 10""")
def top_taxis(spark, folder):
    revenue = marts.mart(fact(spark, folder), "gold.mart_taxi_earnings")
    return reports.top_taxis(revenue, "2024-01-05", "2024-01-20", 10)


@query(f"""WITH {ENRICHED} SELECT pickup_area_name, dropoff_area_name, count(*) AS trips,
  CAST(sum(trip_total) AS DOUBLE) AS reported_total_usd FROM judged GROUP BY 1, 2
  ORDER BY count(*) DESC, pickup_area_name, dropoff_area_name LIMIT 20""")
def area_flows(spark, folder):
    return reports.area_flows(_enriched(spark, folder), 20)


@query(WEATHER_DEMAND + """SELECT weather_condition, count(*) AS hours, CAST(sum(trips) AS BIGINT) AS trips,
  CAST(sum(trips) AS DOUBLE) / count(*) AS trips_per_hour FROM demand GROUP BY 1""")
def rain_compare(spark, folder):
    return reports.rain_compare(enrichment.weather_demand(fact(spark, folder), hours(spark, folder)))


@query(f"""WITH {ENRICHED} SELECT trip_date, trip_hour, coalesce(max(temperature_2m), -1) AS temperature_c, count(*) AS trips,
  count(*) FILTER (WHERE weather_available) AS trips_with_weather,
  count(*) FILTER (WHERE NOT weather_available) AS trips_without_weather FROM judged GROUP BY 1, 2""")
def temperature_coverage(spark, folder):
    rows = reports.temperature_coverage(_enriched(spark, folder))
    return rows.withColumn("temperature_c", F.coalesce("temperature_c", F.lit(-1.0)))


WINDOW = "trip_date BETWEEN '2024-01-10' AND '2024-01-12'"


@query(f"""WITH {FACT} SELECT count(*) AS trips, CAST(coalesce(sum(trip_total), 0) AS DOUBLE) AS revenue_usd,
  round(CAST(sum(trip_total) AS DOUBLE) / count(*), 6) AS average_trip_usd FROM fact WHERE {WINDOW}""")
def kpis(spark, folder):
    daily = marts.mart(fact(spark, folder), "gold.mart_daily")
    totals = reports.kpis(reports.in_dates(daily, "2024-01-10", "2024-01-12"))
    return totals.withColumn("average_trip_usd", F.round("average_trip_usd", 6))


@query(f"""WITH {FACT} SELECT count(DISTINCT trip_id) AS total_trips, CAST(sum(trip_total) AS DOUBLE) AS reported_revenue FROM fact""")
def metric_totals(spark, folder):
    return reports.metric_totals(_enriched(spark, folder))


@query(f"WITH {FACT} SELECT payment_type, count(*) AS trips FROM fact GROUP BY 1")
def payment_totals(spark, folder):
    return reports.trips_by(marts.mart(fact(spark, folder), "gold.mart_payment"), "payment_type")


@query(f"WITH {FACT} SELECT trip_hour, count(*) AS trips FROM fact GROUP BY 1")
def hour_totals(spark, folder):
    return reports.trips_by(marts.mart(fact(spark, folder), "gold.mart_hourly"), "trip_hour")


@query(AREA_DEMAND + """SELECT area_id, area_name, CAST(sum(trips) AS BIGINT) AS trips FROM demand
  WHERE activity = 'Pickup' GROUP BY 1, 2""")
def pickup_totals(spark, folder):
    return reports.area_trips(enrichment.area_demand(fact(spark, folder), areas(spark, folder)), "Pickup")


@query(f"""WITH {FACT} SELECT trip_date, count(*) AS trips, CAST(sum(trip_total) AS DOUBLE) AS revenue_usd FROM fact
  WHERE {WINDOW} GROUP BY 1 ORDER BY 1""")
def date_range(spark, folder):
    daily = marts.mart(fact(spark, folder), "gold.mart_daily").select("trip_date", "trips", "revenue_usd")
    return reports.by_date(reports.in_dates(daily, "2024-01-10", "2024-01-12"))


# --- legacy -----------------------------------------------------------------------------

LEGACY = BROKEN + """,
staged AS (SELECT trip_id, started, n_seconds AS trip_seconds, TRY_CAST(trip_miles AS DECIMAL(38,10)) AS trip_miles,
  n_fare AS fare, n_tips AS tips, n_total AS trip_total, coalesce(nullif(payment_type, ''), 'Unknown') AS payment_type,
  coalesce(nullif(company, ''), 'Unknown') AS company, pickup_community_area AS pickup_area FROM typed),
usable AS (SELECT *, coalesce(started IS NOT NULL AND trip_total >= 0 AND fare >= 0 AND trip_miles >= 0 AND trip_seconds >= 0, FALSE) AS ok FROM staged),
legacy AS (SELECT *, CAST(CAST(started AS DATE) AS VARCHAR) AS trip_date, CAST(extract(hour FROM started) AS INTEGER) AS trip_hour FROM usable WHERE ok)
"""


def _staged(spark, folder):
    return legacy.staging(raw_trips(spark, folder, faults=True))


@query(f"""WITH {LEGACY} SELECT trip_id, CAST(trip_miles AS DOUBLE) AS trip_miles, CAST(fare AS DOUBLE) AS fare,
  CAST(tips AS DOUBLE) AS tips, CAST(trip_total AS DOUBLE) AS trip_total, payment_type, company, pickup_area FROM staged""")
def legacy_staging(spark, folder):
    return _staged(spark, folder).select(
        "trip_id", "trip_miles", "fare", "tips", "trip_total", "payment_type", "company", "pickup_area",
    )


@query(f"WITH {LEGACY} SELECT trip_id, trip_date, trip_hour, payment_type, CAST(trip_total AS DOUBLE) AS trip_total FROM legacy")
def legacy_fact(spark, folder):
    return legacy.fact(_staged(spark, folder)).select("trip_id", "trip_date", "trip_hour", "payment_type", "trip_total")


@query(f"WITH {LEGACY} SELECT trip_id, payment_type FROM usable WHERE NOT ok")
def legacy_quarantine(spark, folder):
    return legacy.quarantine(_staged(spark, folder)).select("trip_id", "payment_type")


@query(f"""WITH {LEGACY} SELECT trip_date, count(*) AS trips, CAST(sum(trip_total) AS DOUBLE) AS revenue_usd, CAST(sum(tips) AS DOUBLE) AS tips_usd,
  round(CAST(sum(trip_total) AS DOUBLE) / count(*), 6) AS average_trip_usd, printf('%.9e', CAST(sum(trip_miles) AS DOUBLE) / count(*)) AS average_miles,
  round(CAST(sum(trip_seconds) AS DOUBLE) / count(*) / 60, 6) AS average_minutes FROM legacy GROUP BY 1""")
def legacy_daily(spark, folder):
    names = ("average_trip_usd", "average_minutes")
    daily = legacy.mart(legacy.fact(_staged(spark, folder)), "daily")
    # Means reach 1e18, so they are compared to ten digits.
    daily = daily.withColumn("average_miles", F.format_string("%.9e", F.col("average_miles").cast("double")))
    return daily.withColumns({name: F.round(F.col(name).cast("double"), 6) for name in names})


@query(f"WITH {LEGACY} SELECT trip_date, trip_hour, count(*) AS trips, CAST(sum(trip_total) AS DOUBLE) AS revenue_usd FROM legacy GROUP BY 1, 2")
def legacy_hourly(spark, folder):
    return legacy.mart(legacy.fact(_staged(spark, folder)), "hourly")


@query(f"WITH {LEGACY} SELECT trip_date, payment_type, count(*) AS trips, CAST(sum(trip_total) AS DOUBLE) AS revenue_usd FROM legacy GROUP BY 1, 2")
def legacy_payment(spark, folder):
    return legacy.mart(legacy.fact(_staged(spark, folder)), "payment")
