"""The trip job; the change-data jobs are in `change_lake` and can be called from here too.

A job writes a stage as Parquet and the next stage reads those files, so a lost executor costs
the tasks it ran and nothing is kept in executor memory between stages.
"""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import partial
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from tablemart.change_lake import (  # noqa: F401
    RefreshError,
    cdc_lake,
    cdc_refresh,
    ledger,
    loan_portfolio,
    quarantine,
    state,
)
from tablemart.contracts import PUBLISHED_FIELDS, RAW_ENVELOPE, TABLES
from tablemart.operators.latest import consolidate
from tablemart.plans import quality, trips
from tablemart.plans.enrichment import area_dimension, area_demand, enriched_trips, weather_demand, weather_dimension
from tablemart.plans.marts import trip_marts
from tablemart.plans.naming import published, published_name
from tablemart.sinks import snapshots
from tablemart.sinks.tables import gathered, write_new, write_partitioned

BRONZE = ("taxi_trip_raw", "community_area_raw", "weather_hour_raw")
#: Spark actions of one run at a time. Earlier ones come first; the cores that their last tasks leave
#: idle, and the time their plans take, go to the next ones.
SIDE_BY_SIDE = 4


def _now():
    return datetime.now(timezone.utc).isoformat()


def _run_id():
    return "run_" + uuid4().hex


def at_once(spark, actions):
    """Results of Spark actions that do not read each other, in their order, a few at a time.

    After the first error no further action starts; it is raised when those under way have ended.
    """
    # Each action gets its own copy of the session's properties.
    actions = [inheritable_thread_target(spark)(action) for action in actions]
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return list(pool.map(lambda action: action(), actions))


# --- trips ------------------------------------------------------------------------------


def build_trip_tables(bronze, write):
    """Every silver and gold table from the bronze frames, by published name.

    `write(name, frame, gather)` stores a published table and returns it as read back; it is called from
    several threads. The fact is stored before the marts read it: each mart then scans only its own
    columns of it. Its rows move by date before they get their keys, and marts of one row per trip are
    written as the fact's files are read. Tables that do not read each other are written side by side.
    """
    raw = trips.trips_from_bronze(bronze["taxi_trip_raw"])
    typed = trips.typed(trips.decode(raw))
    areas = area_dimension(bronze["community_area_raw"].select(F.col("record_id").alias("area_id"), "payload"))
    hours = weather_dimension(bronze["weather_hour_raw"].select("payload"))
    stored = {}

    def keep(tables, ungathered=()):
        def action(name, frame):
            return lambda: write(published_name(name), published(frame), name not in ungathered)

        frames = at_once(raw.sparkSession, [action(name, frame) for name, frame in tables.items()])
        stored.update(zip(map(published_name, tables), frames))
        return [working(frame) for frame in frames]

    by_date = gathered(trips.accepted(typed), ["trip_date"])
    fact, _, areas, hours = keep({
        "silver.fct_trips": trips.with_keys(by_date),
        "silver.quarantine_trips": trips.quarantined(typed),
        "silver.dim_community_area": areas,
        "silver.dim_weather_hour": hours,
    }, ungathered=["silver.fct_trips"])
    # The largest first, so that none of them is left alone at the end.
    keep({
        "gold.mart_enriched_trips": enriched_trips(fact, areas, hours),
        **trip_marts(fact),
        "gold.mart_weather_demand": weather_demand(fact, hours),
        "gold.mart_area_demand": area_demand(fact, areas),
        "silver.dim_date": trips.date_dimension(fact),
        **{f"silver.dim_{name}": trips.dimension(fact, name) for name in trips.DIMENSIONS},
    }, ungathered=["gold.mart_enriched_trips", "gold.mart_trip_distances"])
    return stored


def working(frame):
    """Working column names of a published table."""
    names = {theirs: ours for ours, theirs in PUBLISHED_FIELDS.items()}
    return frame.withColumnsRenamed({k: v for k, v in names.items() if k in frame.columns})


def trip_lake(spark, root, incoming, run_id=None, contracts=TABLES):
    """One run: consolidate bronze, rebuild silver and gold, check, publish.

    `incoming` maps each bronze table to its new envelope rows. The pointer moves last; a
    failed run leaves the published snapshot as it was and records its error.
    """
    run_id, started = run_id or _run_id(), _now()
    snapshots.record_run(spark, root, run_id, "running", started)
    try:
        bronze, stored = {}, {}
        version, previous_run = snapshots.current_version(spark, root), snapshots.current_run(spark, root)

        def store_raw(name):
            table = f"bronze.{name}"
            previous = None
            if previous_run:
                folder = snapshots.table_folder(root, previous_run, table)
                previous = spark.read.schema(RAW_ENVELOPE).parquet(folder)
            path = snapshots.table_folder(root, run_id, table)
            write_new(consolidate(incoming[name], previous), path)
            return spark.read.parquet(path)

        for name, frame in zip(BRONZE, at_once(spark, [partial(store_raw, name) for name in BRONZE])):
            bronze[name] = stored[f"bronze.{name}"] = frame

        def write(name, frame, gather):
            path = snapshots.table_folder(root, run_id, name)
            partition = contracts[name].partition_by if name in contracts else ()
            write_partitioned(frame, path, list(partition), gather=gather)
            return spark.read.schema(frame.schema).parquet(path)

        stored.update(build_trip_tables(bronze, write))
        # A plan per table, made where it runs: one plan of all checks takes the driver as long as its tasks do.
        checks = [partial(quality.trip_checks, bronze["taxi_trip_raw"], stored)]
        checks += [
            partial(quality.contract_checks, spark, name, frame, contracts[name])
            for name, frame in stored.items() if name in contracts
        ]
        failed = at_once(spark, [lambda made=made: quality.failures(quality.report(made())) for made in checks])
        failed.append(quality.failures(quality.table_set(spark, stored, contracts)))
        quality.require_none([row for rows in failed for row in rows])
        summary = quality.summary(
            bronze["taxi_trip_raw"], stored["silver.fact_taxi_trip"], stored["silver.quarantine_taxi_trip"]
        ).first().asDict()
        snapshots.write_manifest(spark, root, run_id, snapshots.table_metadata(stored, contracts))
        snapshots.publish(spark, root, run_id, _now(), stored, version)
        snapshots.record_run(spark, root, run_id, "success", started, _now(), summary["bronze_trips"])
        return {"run_id": run_id, **summary}
    except Exception as error:
        snapshots.record_run(spark, root, run_id, "failed", started, _now(), error=str(error))
        raise
