"""Sources, sinks, quality checks and exports as queries over the given tables."""

from datetime import date
from math import ceil
from uuid import uuid4

from pyspark.sql import functions as F

from registry.inputs import areas, change_event_text, fact, hours, load, plain, raw_areas, raw_trips, raw_weather, typed_trips
from registry.trip_queries import FACT, WEATHER_DEMAND
from registry.cdc_queries import ERRORS, LATEST
from tablemart import change_lake, jobs
from tablemart.contracts import CDC_TABLES, TABLES
from tablemart.functions.values import bucket_of
from tablemart.operators import grain, ranking
from tablemart.plans import cdc, enrichment, marts, quality, trips
from tablemart.plans.event_decode import decode_events
from tablemart.plans.naming import published, published_tables
from tablemart.sinks import exports, snapshots, tables
from tablemart.sources import areas as area_source
from tablemart.sources import envelopes, files, paging, weather, windows
from tablemart.storage import names_in, shared_folder, via_table
from tablemart.streaming.events import stream_cdc

QUERIES, ORACLES = {}, {}


def query(sql):
    """Register a function under its own name, with its SQL twin."""

    def register(function):
        QUERIES[function.__name__] = lambda spark, folder: plain(function(spark, folder))
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


# --- sources ----------------------------------------------------------------------------


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
  AND o_orderkey > 500 ORDER BY o_orderkey LIMIT 1000""")
def keyset_page(spark, folder):
    page = paging.keyset_page(
        load(spark, folder, "orders"), "o_orderkey", "o_orderdate", "1996-01-01", "1998-01-01", cursor=500, size=1000
    )
    return page.select("o_orderkey", "o_custkey")


@query("SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-24'")
def window_filter(spark, folder):
    """The fourteen-day weather re-read window of 2024-01-29."""
    start, end = windows.weather_window(date(2024, 1, 29))
    return load(spark, folder, "events").filter(windows.within(F.col("ts"), start, end)).select("event_id", "event_type")


@query("""WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) + 1 AS hi FROM orders),
  c AS (SELECT CAST(unnest(generate_series(lo, hi - 1, INTERVAL 30 DAY)) AS DATE) AS s, hi FROM b)
  SELECT CAST(s AS VARCHAR) AS chunk_start, CAST(least(CAST(s + 30 AS DATE), hi) AS VARCHAR) AS chunk_end, CAST(CAST(s - 1 AS DATE) AS VARCHAR) AS request_from,
  (SELECT count(*) FROM orders WHERE o_orderdate >= s AND o_orderdate < least(CAST(s + 30 AS DATE), hi)) AS orders FROM c""")
def chunk_windows(spark, folder):
    """Thirty-day request windows over the order dates, with the orders in each."""
    orders = load(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))
    bounds = orders.agg(F.min("day").alias("start"), F.date_add(F.max("day"), 1).alias("end"))
    chunks = windows.chunk_windows(bounds).drop("request_to")
    first = bounds.select("start").scalar()
    counts = orders.groupBy(windows.chunk_start_of(F.col("day"), first).alias("chunk_start")).agg(
        F.count("*").alias("orders")
    )
    return chunks.join(counts, "chunk_start", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


def _responses(spark, folder):
    """One column-array weather response per day of events."""
    rows = load(spark, folder, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.count("*").alias("n")
    ).select(
        "hour", (F.col("n") % 25).cast("double").alias("temperature_2m"),
        (F.col("n") % 3).cast("double").alias("precipitation"), (F.col("n") % 2).cast("double").alias("snowfall"),
    )
    names = list(weather.MEASURES)
    # A day has at most 24 hours, so a response is a bounded group.
    day = rows.groupBy(F.to_date("hour").alias("day")).agg(
        F.array_sort(F.collect_list(F.struct(F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("time"), *names))).alias("h")
    )
    hourly = F.struct(*[F.col("h")[name].alias(name) for name in ("time", *names)])
    units = F.struct(*[F.lit(unit).alias(name) for name, unit in weather.MEASURES.items()])
    return day.select(F.to_json(F.struct(units.alias("hourly_units"), hourly.alias("hourly"))).alias("response"))


@query("""WITH h AS (SELECT date_trunc('hour', ts) AS utc, count(*) AS n FROM events GROUP BY 1)
  SELECT strftime(utc, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS hour_utc, strftime(utc - INTERVAL 6 HOUR, '%Y-%m-%dT%H:00:00') AS local_hour,
    CAST(n % 25 AS DOUBLE) AS temperature_2m, CAST(n % 3 AS DOUBLE) AS precipitation, CAST(n % 2 AS DOUBLE) AS snowfall
  FROM h WHERE CAST(utc - INTERVAL 6 HOUR AS DATE) >= DATE '2024-01-05' AND CAST(utc - INTERVAL 6 HOUR AS DATE) < DATE '2024-01-20'""")
def weather_explode(spark, folder):
    return weather.hourly_rows(_responses(spark, folder), "2024-01-05", "2024-01-20")


@query("""SELECT CAST(0 AS BIGINT) AS empty, count(*) FILTER (WHERE n_nationkey < 1 OR n_nationkey > 77) AS bad_id, CAST(0 AS BIGINT) AS repeated_id,
  CAST(0 AS BIGINT) AS no_name, CAST(0 AS BIGINT) AS bad_polygon, abs(count(*) - 77) AS missing FROM nation""")
def area_snapshot_check(spark, folder):
    return area_source.area_faults(area_source.decode_areas(raw_areas(spark, folder)), complete=True)


@query("""SELECT CAST(event_id AS VARCHAR) AS record_id, 'run_1' AS run_id,
  row_number() OVER (ORDER BY CAST(event_id AS VARCHAR)) - 1 + 1000 AS sequence FROM events""")
def envelope_sequence(spark, folder):
    """Envelope rows written as JSON lines and scanned back with the fixed schema."""
    wrapped = envelopes.wrap_rows(
        raw_trips(spark, folder), "trip_id", "run_1", "2024-02-01T00:00:00+00:00", start=1000, payload="payload"
    )
    path = shared_folder(spark, "envelopes")
    wrapped.write.json(path)
    return files.read_batches(spark, path).select("record_id", "run_id", "sequence")


@query("""SELECT p_brand, count(*) AS lines FROM part GROUP BY 1""")
def line_scan(spark, folder):
    """Text lines, one JSON object each."""
    path = shared_folder(spark, "lines")
    load(spark, folder, "part").select(F.to_json(F.struct("p_partkey", "p_brand"))).write.text(path)
    lines = files.read_lines(spark, path)
    return lines.groupBy(F.get_json_object("event_json", "$.p_brand").alias("p_brand")).agg(F.count("*").alias("lines"))


@query("""SELECT count(*) AS customers, count(DISTINCT c_custkey) AS distinct_customers FROM customer""")
def bucket_scan(spark, folder):
    """The bucket expression of parallel relational reads: every key in exactly one bucket."""
    buckets = load(spark, folder, "customer").withColumn("bucket", bucket_of(F.col("c_custkey"), 8))
    per_bucket = buckets.filter(F.col("bucket").between(0, 7)).groupBy("bucket").agg(
        F.count("*").alias("n"), F.countDistinct("c_custkey").alias("d")
    )
    return per_bucket.agg(F.sum("n").alias("customers"), F.sum("d").alias("distinct_customers"))


# --- sinks ------------------------------------------------------------------------------


STATES = f"""WITH {LATEST} SELECT 'loans' AS source_table, loan_id AS record_id, loan_id, status AS kind, CAST(principal_amount AS DOUBLE) AS amount,
  event_sequence, is_deleted FROM loans UNION ALL SELECT 'loan_transactions', transaction_id, loan_id, transaction_type, CAST(amount AS DOUBLE),
  event_sequence, is_deleted FROM transactions"""


def _states(spark, root):
    """Both latest states as one table."""
    loans = jobs.state(spark, root, "loans").select(
        F.lit("loans").alias("source_table"), F.col("loan_id").alias("record_id"), "loan_id", F.col("status").alias("kind"),
        F.col("principal_amount").alias("amount"), cdc.SEQUENCE, "is_deleted",
    )
    moves = jobs.state(spark, root, "loan_transactions").select(
        F.lit("loan_transactions").alias("source_table"), F.col("transaction_id").alias("record_id"), "loan_id",
        F.col("transaction_type").alias("kind"), "amount", cdc.SEQUENCE, "is_deleted",
    )
    return loans.unionByName(moves)


def _number():
    return F.substring_index("source_file", "/", -1).cast("bigint")


@query(STATES)
def cdc_buckets(spark, folder):
    """Two batches into a lake of eight buckets, the second one with the records of every third loan only."""
    root, rows = shared_folder(spark, "cdc"), change_event_text(spark, folder)
    late = (F.regexp_extract("value", r'"loan_id":([0-9]+)', 1).cast("bigint") % 3 == 0) & (_number() % 2 == 1)
    for batch in (~late, late):
        jobs.cdc_lake(spark, rows.filter(batch), root, buckets=8)
    return _states(spark, root)


@query(STATES)
def cdc_recovery(spark, folder):
    """The first batch stops behind the ledger, before any state; the next one holds other events and
    finishes it."""
    root, rows = shared_folder(spark, "cdc"), change_event_text(spark, folder)
    _, batch = change_lake.admit_batch(spark, rows.filter(_number() % 3 == 0), root, buckets=8)
    lake = change_lake.ChangeLake(spark, root)
    change_lake.append_batch(lake, change_lake.written_down(lake, batch), batch)
    jobs.cdc_lake(spark, rows.filter(_number() % 3 != 0), root)
    return _states(spark, root)


@query(f"""WITH {ERRORS},
good AS (SELECT * FROM judged WHERE error IS NULL),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_table, record_id ORDER BY event_sequence DESC) AS place FROM good) WHERE place = 1),
live AS (SELECT * FROM last WHERE operation <> 'D')
SELECT (SELECT count(*) FROM judged) AS input, (SELECT count(*) FROM judged WHERE error IS NOT NULL) AS quarantined,
  (SELECT count(*) FROM good) AS valid_unique, (SELECT count(*) FROM good) AS ledger_events,
  (SELECT count(*) FROM live WHERE source_table = 'loans') AS current_loans,
  (SELECT count(*) FROM live WHERE source_table = 'loan_transactions') AS current_transactions,
  (SELECT count(*) FROM live WHERE source_table = 'loan_transactions'
     AND user_id NOT IN (SELECT record_id FROM live WHERE source_table = 'loans')) AS orphan_transactions""")
def cdc_job_report(spark, folder):
    """The report of the batch job over events with faults in them, as one row."""
    report = jobs.cdc_lake(spark, change_event_text(spark, folder, faults=True), shared_folder(spark, "cdc"), buckets=8)
    return spark.createDataFrame([tuple(report.values())], ", ".join(f"{k} bigint" for k in report))


@query(f"""WITH {ERRORS},
good AS (SELECT * FROM judged WHERE error IS NULL)
SELECT place, reason, in_ledger, count(*) AS refused FROM (
  SELECT 1 AS place, error AS reason, FALSE AS in_ledger FROM judged WHERE error IS NOT NULL
  UNION ALL SELECT 2, 'ledger row disagrees with its own event', TRUE FROM good WHERE number % 3 = 0 AND number % 11 = 0
  UNION ALL SELECT 2, 'ledger row disagrees with its own event', TRUE FROM good WHERE number % 3 = 0 AND number % 77 = 0
  UNION ALL SELECT 3, 'event id with different bytes', NULL FROM good WHERE number % 3 = 0 AND number % 13 = 0
  UNION ALL SELECT 4, 'event stored twice', NULL FROM good WHERE number % 3 = 0 AND number % 7 = 0 AND number % 13 <> 0) GROUP BY ALL""")
def cdc_refused(spark, folder):
    """Why the fail-fast gate refuses: faulty lines, ledger rows with another operation (every 11th),
    lines that come with a space more (every 13th) and ledger rows stored twice (every 7th). The ledger
    holds every third event."""
    raw = change_event_text(spark, folder, faults=True).withColumn("number", _number())
    stored = via_table(decode_events(raw).filter("error IS NULL AND number % 3 = 0"), "stored")
    known = stored.withColumn("operation", F.when(F.col("number") % 11 == 0, "?").otherwise(F.col("operation")))
    known = known.unionByName(known.filter("number % 7 = 0")).withColumn("event_json", F.col("value"))
    lines = raw.select(F.when((F.col("number") % 13 == 0) & (F.col("number") % 3 == 0), F.concat("value", F.lit(" "))).otherwise(F.col("value")).alias("event_json"))
    decoded = via_table(decode_events(change_lake.refresh_input(spark, lines, known), text="event_json"), "refused")
    return cdc.refusals(decoded).groupBy("place", "reason", "in_ledger").agg(F.count("*").alias("refused"))


@query(f"""WITH {FACT} SELECT trip_date, count(*) AS trips, CAST(sum(trip_total) AS DOUBLE) AS revenue_usd FROM fact
  WHERE trip_date BETWEEN '2024-01-10' AND '2024-01-12' GROUP BY 1""")
def partition_roundtrip(spark, folder):
    """The fact written by date; reading three dates back opens three folders only."""
    path = shared_folder(spark, "fact")
    tables.write_partitioned(fact(spark, folder), path, ["trip_date"])
    stored = files.read_parquet(spark, path).filter(
        F.col("trip_date").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date"))
    )
    return stored.groupBy("trip_date").agg(F.count("*").alias("trips"), F.sum("trip_total").alias("revenue_usd"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS trip_date, count(*) AS rows FROM events GROUP BY 1""")
def raw_by_date(spark, folder):
    path = shared_folder(spark, "raw")
    tables.write_raw_by_date(raw_trips(spark, folder), path)
    stored = files.read_parquet(spark, path)
    return stored.groupBy(F.col("trip_date").cast("string").alias("trip_date")).agg(F.count("*").alias("rows"))


@query(f"""{WEATHER_DEMAND} SELECT trip_date, trip_hour, weather_condition, trips, reported_total_usd, average_trip_seconds,
  temperature_2m AS temperature_c, precipitation AS precipitation_mm, snowfall AS snowfall_cm FROM demand""")
def csv_roundtrip(spark, folder):
    """The weather mart exported under its working names and read back."""
    mart = published(enrichment.weather_demand(fact(spark, folder), hours(spark, folder)))
    path = shared_folder(spark, "csv")
    exports.write_csv(exports.export_columns("gold.mart_weather_demand_hourly", mart), path)
    schema = ", ".join(
        ["trip_date string", "trip_hour int", "weather_condition string", "trips bigint",
         "reported_total_usd double", "average_trip_seconds double", "temperature_2m double",
         "precipitation double", "snowfall double"]
    )
    renamed = schema.replace("temperature_2m", "temperature_c").replace("precipitation", "precipitation_mm").replace("snowfall", "snowfall_cm")
    stored = spark.read.schema(renamed).option("header", True).csv(path)
    return stored.withColumn("average_trip_seconds", F.round("average_trip_seconds", 6))


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS area_id, n_name AS name, 'Polygon' AS kind FROM nation""")
def geojson_features(spark, folder):
    rows = exports.features(areas(spark, folder))
    return rows.select(
        "area_id", F.get_json_object("feature", "$.properties.area_name").alias("name"),
        F.get_json_object("feature", "$.geometry.type").alias("kind"),
    )


@query("""SELECT * FROM (
  SELECT 1 AS part, CAST(c_custkey AS VARCHAR) AS area_id, '{"type":"Feature","properties":{"area_id":"' || c_custkey
    || '","area_name":"' || c_name || '"},"geometry":{"coordinates":[[[0,0],[1,1],[0,0]]],"type":"Polygon"}}'
    || CASE WHEN CAST(c_custkey AS VARCHAR) < (SELECT max(CAST(c_custkey AS VARCHAR)) FROM customer) THEN ',' ELSE '' END AS line
  FROM customer
  UNION ALL SELECT 0, NULL, '{"type":"FeatureCollection","features":['
  UNION ALL SELECT 2, NULL, ']}')""")
def geojson_collection(spark, folder):
    """A document of one area per customer, line by line."""
    rows = load(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("area_id"), F.col("c_name").alias("area_name"),
        F.lit('{"type":"Polygon","coordinates":[[[0,0],[1,1],[0,0]]]}').alias("geometry_geojson"),
    )
    return exports.feature_collection(rows)


@query("""SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1""")
def publish_pointer(spark, folder):
    """Two snapshots and a third that never moved the pointer: the second one is read."""
    root = shared_folder(spark, "snapshots")
    orders = load(spark, folder, "orders")
    for run, rows in (("run_1", orders.filter("o_orderstatus = 'F'")), ("run_2", orders), ("run_3", orders.filter("o_orderstatus = 'O'"))):
        tables.write_new(rows, snapshots.table_folder(root, run, "silver.orders"))
        if run != "run_3":
            snapshots.publish(spark, root, run, "2024-01-01T00:00:00+00:00", ["silver.orders"])
    current = snapshots.read_current(spark, root, "silver.orders")
    return current.groupBy("o_orderstatus").agg(F.count("*").alias("orders"))


@query("""SELECT 'success' AS status, count(*) AS extracted_rows, CAST(NULL AS INTEGER) AS error_length FROM events
  UNION ALL SELECT 'failed', NULL, 5000 UNION ALL SELECT 'running', NULL, NULL""")
def run_audit(spark, folder):
    root = shared_folder(spark, "audit")
    rows = load(spark, folder, "events").count()
    snapshots.record_run(spark, root, "run_1", "running", "2024-01-01")
    snapshots.record_run(spark, root, "run_1", "success", "2024-01-01", "2024-01-02", rows)
    snapshots.record_run(spark, root, "run_2", "failed", "2024-01-02", "2024-01-02", error="x" * 5000)
    return snapshots.run_records(spark, root).select("status", "extracted_rows", F.length("error").alias("error_length"))


# --- quality ----------------------------------------------------------------------------

def _tables(spark, folder):
    """A snapshot's fact, quarantine and marts, by working and by published name. The checks read all of
    them, so trips are parsed once and stored; without that every mart of every check parsed them again."""
    typed = via_table(typed_trips(spark, folder, faults=True), "typed")
    good = via_table(trips.with_keys(trips.accepted(typed)), "fact")
    found = {
        "silver.fct_trips": good,
        "silver.quarantine_trips": trips.quarantined(typed),
        **marts.trip_marts(good),
        "gold.mart_enriched_trips": enrichment.enriched_trips(good, areas(spark, folder), hours(spark, folder)),
        "gold.mart_weather_demand": enrichment.weather_demand(good, hours(spark, folder)),
        "gold.mart_area_demand": enrichment.area_demand(good, areas(spark, folder)),
    }
    return found, published_tables(found)


@query("""SELECT 'accepted + quarantined' AS "check", 'silver.fact_taxi_trip' AS "table", CAST(0 AS BIGINT) AS violations, TRUE AS passed
  UNION ALL SELECT 'dimension keys', 'silver.fact_taxi_trip', 0, TRUE UNION ALL SELECT 'unit conversion', 'silver.fact_taxi_trip', 0, TRUE
  UNION ALL SELECT 'totals', unnest(['gold.mart_taxi_demand_daily', 'gold.mart_taxi_demand_hourly', 'gold.mart_payment_demand_daily',
    'gold.mart_taxi_revenue_daily', 'gold.mart_weather_demand_hourly', 'gold.mart_taxi_trip_enriched', 'gold.mart_taxi_trip_distance',
    'gold.mart_community_area_demand_daily Pickup', 'gold.mart_community_area_demand_daily Dropoff']), 0, TRUE""")
def quality_report(spark, folder):
    _, stored = _tables(spark, folder)
    return quality.report(quality.trip_checks(raw_trips(spark, folder, faults=True), stored))


@query("""SELECT "check", "table", CAST(v AS BIGINT) AS violations, v = 0 AS passed FROM (
  SELECT 'unique key' AS "check", 'lineitem' AS "table", (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS v
  UNION ALL SELECT 'unique key', 'orders', (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)))""")
def grain_check(spark, folder):
    return quality.report([
        quality.unique_grain("lineitem", load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]),
        quality.unique_grain("orders", load(spark, folder, "orders"), ["o_orderkey"]),
    ])


@query("""SELECT 'reference l_orderkey' AS "check", 'lineitem' AS "table", (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey % 9 = 0) AS violations, FALSE AS passed
  UNION ALL SELECT 'reference o_custkey', 'orders', 0, TRUE""")
def fk_check(spark, folder):
    """Lines against orders without every ninth one, orders against all customers."""
    orders = load(spark, folder, "orders")
    kept = orders.filter(F.col("o_orderkey") % 9 != 0).withColumnRenamed("o_orderkey", "l_orderkey")
    customers = load(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return quality.report([
        quality.references_found("lineitem", load(spark, folder, "lineitem"), kept, "l_orderkey"),
        quality.references_found("orders", orders, customers, "o_custkey"),
    ])


@query("""SELECT 'required values' AS "check", 'events' AS "table", count(*) FILTER (WHERE event_id % 6 = 0) + count(*) FILTER (WHERE event_id % 10 = 0) AS violations, FALSE AS passed FROM events""")
def null_check(spark, folder):
    key = F.col("event_id")
    rows = load(spark, folder, "events").withColumns({
        "user_id": F.when(key % 6 != 0, F.col("user_id")), "event_type": F.when(key % 10 != 0, F.col("event_type")),
    })
    return quality.required_values("events", rows, ["event_id", "user_id", "event_type"])


@query("SELECT count(*) - count(DISTINCT l_orderkey) AS surplus FROM lineitem")
def key_surplus(spark, folder):
    return grain.surplus_keys(load(spark, folder, "lineitem"), "l_orderkey")


@query(f"""WITH {FACT} SELECT 'unit conversion' AS "check", 'silver.fact_taxi_trip' AS "table", count(*) FILTER (WHERE CAST(trip_id AS BIGINT) % 8 = 0) AS violations, FALSE AS passed FROM fact""")
def conversion_check(spark, folder):
    rows = published(fact(spark, folder))
    off = F.col("trip_distance_km") + F.when(F.col("trip_id").cast("bigint") % 8 == 0, 1).otherwise(0)
    return quality.conversion_exact(rows.withColumn("trip_distance_km", off))


@query("""SELECT count(*) AS bronze_trips, count(*) FILTER (WHERE ok) AS accepted_trips, count(*) FILTER (WHERE NOT ok) AS quarantined_trips,
  CAST(sum(CASE WHEN ok THEN CAST(value AS DECIMAL(20,2)) END) AS DOUBLE) AS reported_total_usd
  FROM (SELECT *, event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0 AND event_id % 29 <> 0 AND event_id % 37 <> 0 AS ok FROM events)""")
def quality_summary(spark, folder):
    typed = typed_trips(spark, folder, faults=True)
    return quality.summary(
        raw_trips(spark, folder, faults=True), trips.accepted(typed), trips.quarantined(typed), "trip_total"
    )


@query("""SELECT k AS "check", t AS "table", CAST(count(*) FILTER (WHERE event_id IS NULL) AS BIGINT) AS violations, TRUE AS passed
  FROM events, (SELECT unnest(['schema', 'unique key', 'required values']) AS k),
    (SELECT unnest(['silver.fact_taxi_trip', 'gold.mart_taxi_revenue_daily', 'gold.mart_community_area_demand_daily']) AS t)
  GROUP BY 1, 2""")
def contract_check(spark, folder):
    """Schema, key and required values of a fact and two marts against their contracts."""
    _, stored = _tables(spark, folder)
    names = ("silver.fact_taxi_trip", "gold.mart_taxi_revenue_daily", "gold.mart_community_area_demand_daily")
    checks = [quality.contract_checks(spark, name, stored[name], TABLES[name]) for name in names]
    return quality.report([check for group in checks for check in group])


# --- jobs -------------------------------------------------------------------------------

STATES = f"""WITH {LATEST} SELECT loan_id, status, CAST(principal_amount AS DOUBLE) AS principal_amount, event_sequence,
  is_deleted FROM loans"""




CDC_JOB = STATES


@query(CDC_JOB)
def cdc_job(spark, folder):
    """The batch job over all change events; its stored loan state."""
    root = shared_folder(spark, "cdc")
    jobs.cdc_lake(spark, change_event_text(spark, folder), root)
    return jobs.state(spark, root, "loans").select("loan_id", "status", "principal_amount", cdc.SEQUENCE, "is_deleted")


@query(f"""WITH {LATEST} SELECT l.loan_id, count(t.loan_id) AS transaction_count,
  CAST(sum(CASE WHEN transaction_type = 'repayment' THEN amount ELSE 0 END) AS DOUBLE) AS repaid_amount FROM loans l
  LEFT JOIN (SELECT * FROM transactions WHERE NOT is_deleted) t USING (loan_id) WHERE NOT l.is_deleted GROUP BY 1""")
def cdc_job_portfolio(spark, folder):
    """Two batches, the later half first: the earlier events arrive late and change nothing."""
    root = shared_folder(spark, "cdc")
    rows = change_event_text(spark, folder)
    number = F.substring_index("source_file", "/", -1).cast("bigint")
    for half in (number % 2 == 1, number % 2 == 0):
        jobs.cdc_lake(spark, rows.filter(half), root, scope="touched")
    return jobs.loan_portfolio(spark, root).select("loan_id", "transaction_count", "repaid_amount")


@query(CDC_JOB)
def cdc_stream(spark, folder):
    """The events as files, taken by the stream in several micro-batches; its stored loan state."""
    root = shared_folder(spark, "stream")
    text = change_event_text(spark, folder).select("value")
    text.write.option("compression", "gzip").text(f"{root}/raw")
    parts = len([name for name in names_in(spark, f"{root}/raw") if name.startswith("part-")])
    stream_cdc(
        spark, f"{root}/raw", f"{root}/lake", f"{root}/progress", files_per_batch=ceil(parts / 4), glob="part-*"
    ).awaitTermination()
    return jobs.state(spark, f"{root}/lake", "loans").select(
        "loan_id", "status", "principal_amount", cdc.SEQUENCE, "is_deleted"
    )


@query(f"""WITH {FACT} SELECT trip_date, count(*) AS trips, CAST(sum(trip_total) AS DOUBLE) AS revenue_usd FROM fact GROUP BY 1""")
def trip_job(spark, folder):
    """The whole trip job: bronze to published marts; its stored daily mart."""
    root = shared_folder(spark, "trips")
    jobs.trip_lake(spark, root, _incoming(spark, folder))
    mart = snapshots.read_current(spark, root, "gold.mart_taxi_demand_daily")
    return mart.select("trip_date", "trips", "revenue_usd")


@query(f"""WITH {FACT} SELECT trip_date, count(*) AS trips, CAST(sum(trip_total) AS DOUBLE) AS revenue_usd FROM fact GROUP BY 1""")
def trip_job_replay(spark, folder):
    """Two runs of the trip job: the first takes every third trip with a wrong total, the second holds the
    corrections alone and replaces those records in bronze."""
    root, incoming = shared_folder(spark, "trips"), _incoming(spark, folder)
    rows = incoming["taxi_trip_raw"]
    third = F.col("record_id").cast("bigint") % 3 == 0
    wrong = F.regexp_replace("payload", '"trip_total":"[0-9.]+"', '"trip_total":"1.00"')
    jobs.trip_lake(spark, root, {**incoming, "taxi_trip_raw": rows.withColumn("payload", F.when(third, wrong).otherwise(F.col("payload")))})
    later = {"ingested_at_utc": F.lit("2024-02-02T00:00:00+00:00"), "run_id": F.lit("run_2")}
    none = {name: frame.limit(0) for name, frame in incoming.items()}
    jobs.trip_lake(spark, root, {**none, "taxi_trip_raw": rows.filter(third).withColumns(later)})
    mart = snapshots.read_current(spark, root, "gold.mart_taxi_demand_daily")
    return mart.select("trip_date", "trips", "revenue_usd")


@query(f"""WITH {LATEST} SELECT 'loans' AS source_table, loan_id AS record_id, loan_id, status AS kind, CAST(principal_amount AS DOUBLE) AS amount
  FROM loans WHERE NOT is_deleted UNION ALL SELECT 'loan_transactions', transaction_id, loan_id, transaction_type, CAST(amount AS DOUBLE)
  FROM transactions WHERE NOT is_deleted""")
def catalog_state(spark, folder):
    """Catalog tables made from the contracts, filled by a fold, read through the views of current rows."""
    database = f"lending_{uuid4().hex}"
    tables.create_cdc_tables(spark, database)
    latest = via_table(cdc.latest_records(cdc.valid_events(decode_events(change_event_text(spark, folder)))), "latest")
    for name in CDC_TABLES:
        rows = latest.filter(F.col("source_table") == name)
        tables.replace_table(cdc.state_rows(rows, name), f"{database}.{name}_state")
    loans, moves = (files.read_table(spark, name) for name in tables.create_current_views(spark, database))
    return loans.select(
        F.lit("loans").alias("source_table"), F.col("loan_id").alias("record_id"), "loan_id", F.col("status").alias("kind"),
        F.col("principal_amount").alias("amount"),
    ).unionByName(moves.select(
        F.lit("loan_transactions").alias("source_table"), F.col("transaction_id").alias("record_id"), "loan_id",
        F.col("transaction_type").alias("kind"), "amount",
    ))


@query("""WITH n AS (SELECT count(*) AS rows, count(*) FILTER (event_id % 50 = 0) AS twice, count(*) FILTER (event_id % 40 = 0) AS untotalled,
    count(*) FILTER (event_id % 45 = 0) AS keyless, count(*) FILTER (event_id % 30 = 0) AS off, count(*) FILTER (event_id % 60 = 0) AS lost,
    count(DISTINCT user_id) FILTER (user_id % 7 = 0) AS taxis FROM events)
  SELECT "check", "table", violations, FALSE AS passed FROM (
    SELECT 'unique key' AS "check", 'silver.fact_taxi_trip' AS "table", twice AS violations FROM n
    UNION ALL SELECT 'required values', 'silver.fact_taxi_trip', untotalled FROM n
    UNION ALL SELECT 'dimension keys', 'silver.fact_taxi_trip', keyless FROM n
    UNION ALL SELECT 'unit conversion', 'silver.fact_taxi_trip', off FROM n
    UNION ALL SELECT 'accepted + quarantined', 'silver.fact_taxi_trip', lost FROM n
    UNION ALL SELECT 'reference taxi_key', 'silver.fact_taxi_trip', taxis FROM n
    UNION ALL SELECT 'totals', 'trips lost', 1 UNION ALL SELECT 'totals', 'amount changed', 1
    UNION ALL SELECT 'schema', 'silver.fact_taxi_trip', 3 UNION ALL SELECT 'table set', 'all', 2)""")
def quality_faults(spark, folder):
    """One fault put in for every check: the violations each of them finds."""
    raw, whole = raw_trips(spark, folder), via_table(published(fact(spark, folder)), "fact")
    name, contract = "silver.fact_taxi_trip", TABLES["silver.fact_taxi_trip"]
    number = F.col("trip_id").cast("bigint")

    def spoiled(column, modulus, value):
        return whole.withColumn(column, F.when(number % modulus != 0, F.col(column)).otherwise(value))

    total = "trip_total_usd"
    taxis = whole.select("taxi_id", "taxi_key").distinct().filter(F.substring_index("taxi_id", "-", -1).cast("bigint") % 7 != 0)
    daily = whole.groupBy("trip_date").agg(F.count("*").alias("trips"), F.sum(total).alias("amount"))
    fewer = whole.filter("trip_id <> '1'").groupBy("trip_date").agg(F.count("*").alias("trips"), F.sum(total).alias("amount"))
    found = [
        quality.unique_grain(name, whole.unionByName(whole.filter(number % 50 == 0)), contract.primary_key),
        quality.required_values(name, spoiled(total, 40, F.lit(None)), [total]),
        quality.dimension_keys_present(spoiled("taxi_key", 45, F.lit(None))),
        quality.conversion_exact(spoiled("trip_distance_km", 30, F.col("trip_distance_km") + 1)),
        quality.split_complete(raw, whole.filter(number % 60 != 0), whole.limit(0)),
        quality.references_found(name, whole, taxis, "taxi_key"),
        quality.totals_match(whole, {
            "good": (daily, "trips", "amount"), "trips lost": (fewer, "trips", "amount"),
            "amount changed": (daily.withColumn("amount", F.col("amount") + 1), "trips", "amount"),
        }).filter("NOT passed"),
        quality.schema_drift(spark, name, whole.drop("company").withColumn("extra", F.lit(1)).withColumn("trip_hour", F.lit("1")), contract),
        quality.table_set(spark, {**{k: None for k in TABLES if k != "silver.dim_taxi"}, "silver.other": None}, TABLES),
    ]
    return quality.report(found)


def _incoming(spark, folder):
    def envelope(rows, key):
        return rows.select(
            key.alias("record_id"), "payload", F.lit("2024-02-01T00:00:00+00:00").alias("ingested_at_utc"),
            F.lit("run_1").alias("run_id"), F.lit(0).cast("bigint").alias("sequence"),
        )

    weather_rows = raw_weather(spark, folder)
    return {
        "taxi_trip_raw": envelope(raw_trips(spark, folder), F.col("trip_id")),
        "community_area_raw": envelope(raw_areas(spark, folder), F.col("area_id")),
        "weather_hour_raw": envelope(weather_rows, F.get_json_object("payload", "$.local_hour")),
    }

