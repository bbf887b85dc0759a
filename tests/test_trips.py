"""Trips: golden cases of cleaning, replay, weather and enrichment; the trip job."""

import json
import threading
import time
from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablemart import jobs
from tablemart.contracts import RAW_ENVELOPE, TABLES
from tablemart.functions import times
from tablemart.functions.times import local_wall_clock
from tablemart.functions.values import number_or_null, whole_number_text
from tablemart.operators.latest import consolidate
from tablemart.plans import enrichment, quality, trips
from tablemart.sinks import snapshots
from tablemart.sources import areas, paging, weather, windows

BASE = {
    "trip_id": "a", "taxi_id": "taxi-1", "trip_start_timestamp": "2025-01-01T10:00:00", "trip_seconds": "60",
    "trip_miles": "1", "fare": "10", "tips": "2", "trip_total": "12", "payment_type": "Cash", "company": "A",
    "pickup_community_area": "1", "dropoff_community_area": "2",
}


def raw(spark, changes):
    rows = [(str(n), json.dumps({**BASE, **change})) for n, change in enumerate(changes)]
    return spark.createDataFrame(rows, "trip_id string, payload string")


def values(spark, column, texts):
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    return [r["v"] for r in frame.select("n", column(F.col("t")).alias("v")).orderBy("n").collect()]


def test_six_trips(spark):
    typed = trips.typed(trips.decode(raw(spark, [
        {}, {"tips": None}, {"trip_miles": "0", "taxi_id": None}, {"fare": "broken"},
        {"trip_start_timestamp": "invalid"}, {"trip_total": "-1"},
    ])))
    tables = trips.star_schema(typed)
    fact = tables["silver.fct_trips"]
    rows = {r["trip_id"]: r for r in fact.collect()}
    assert set(rows) == {"0", "1", "2"} and rows["2"]["taxi_id"] == "Unknown"
    assert rows["0"]["distance_km"] == Decimal("1.609344")
    assert fact.agg(F.sum("trip_total")).first()[0] == 36
    assert fact.filter("distance_km > 0").count() == 2
    assert tables["silver.dim_area"].count() == 2
    reasons = {r["trip_id"]: r["rejection_reason"] for r in tables["silver.quarantine_trips"].collect()}
    assert reasons == {"3": "invalid_fare", "4": "invalid_timestamp", "5": "invalid_trip_total"}


def test_edge_texts(spark):
    numbers = values(spark, number_or_null, ["1.5", "-2", "1e3", ".5", "+1", "12\n", "123456789012345", " 1", ""])
    assert numbers == [Decimal("1.5"), -2, None, None, None, 12, None, None, None]
    assert values(spark, whole_number_text, ["08", "8.0", "1.5", "x", "99999999999", "Unknown"]) == [
        "8", "8", "1", None, None, None,
    ]
    stamps = values(spark, local_wall_clock, [
        "2024-01-01T10:00:00", "2024-07-01T10:00:00Z", "2024-07-01T10:00:00+02:00", "2024-03-10T02:30:00",
        "10:00", "now", "2024-02-30", "2024",
    ])
    assert [str(s) if s else None for s in stamps] == [
        "2024-01-01 10:00:00", "2024-07-01 05:00:00", "2024-07-01 03:00:00", "2024-03-10 03:30:00",
        None, None, None, "2024-01-01 00:00:00",
    ]
    typed = trips.typed(trips.decode(raw(spark, [{"tips": "abc"}, {"tips": "-1"}, {"company": "\t"}, {"company": " "}])))
    rows = {r["trip_id"]: r for r in typed.collect()}
    assert [rows[str(n)]["rejection_reason"] for n in range(4)] == ["", "negative_tips", "", ""]
    assert rows["0"]["tips"] is None and rows["2"]["company"] == "\t" and rows["3"]["company"] == "Unknown"


def envelope(spark, rows):
    return spark.createDataFrame(rows, RAW_ENVELOPE)


def test_replay_keeps_the_newest(spark):
    old = envelope(spark, [("a", "10", "2024-01-01", "run_a", 0)])
    new = envelope(spark, [("a", "12", "2024-01-02", "run_b", 0), ("b", "{}", "2024-01-02", "run_b", 1)])
    once = consolidate(new, old)
    assert sorted((r["record_id"], r["payload"]) for r in once.collect()) == [("a", "12"), ("b", "{}")]
    assert sorted(map(tuple, consolidate(new, once).collect())) == sorted(map(tuple, once.collect()))


UNITS = dict(weather.MEASURES)


def response(spark, times, **arrays):
    hourly = {"time": times, **{name: arrays.get(name, [0.0] * len(times)) for name in UNITS}}
    text = json.dumps({"hourly_units": arrays.get("units", UNITS), "hourly": hourly})
    return spark.createDataFrame([(text,)], "response string")


def test_weather_window_and_clock_change(spark):
    hours = ["2024-01-01T05:00", "2024-01-01T06:00", "2024-01-02T05:00", "2024-01-02T06:00"]
    rows = weather.hourly_rows(response(spark, hours), date(2024, 1, 1), date(2024, 1, 2)).collect()
    assert [r["local_hour"] for r in rows] == ["2024-01-01T00:00:00", "2024-01-01T23:00:00"]
    moved = response(spark, ["2024-01-01T00:00-06:00", "2024-01-01T08:00+01:00"])
    rows = weather.hourly_rows(moved, date(2024, 1, 1), date(2024, 1, 2)).collect()
    assert [r["hour_utc"] for r in rows] == ["2024-01-01T06:00:00+00:00", "2024-01-01T07:00:00+00:00"]
    fold = response(spark, ["2024-11-03T06:00", "2024-11-03T07:00"], precipitation=[None, 1.0])
    rows = weather.hourly_rows(fold, date(2024, 11, 3), date(2024, 11, 4)).collect()
    assert len({r["hour_utc"] for r in rows}) == 2 and len({r["local_hour"] for r in rows}) == 1
    assert [r["precipitation"] for r in rows] == [None, 1.0]


@pytest.mark.parametrize("times,arrays", [
    (["2024-01-01T06:00"] * 2, {}),
    (["2024-01-01T06:00", "2024-01-01T00:00-06:00"], {}),
    (["2024-01-01T06:30"], {}),
    (["2024-01-01T06:00"], {"units": {**UNITS, "precipitation": "inch"}}),
    (["2024-01-01T06:00"], {"snowfall": []}),
    (["2024-01-01T06:00"], {"snowfall": [-1.0]}),
])
def test_bad_weather_stops(spark, times, arrays):
    with pytest.raises(PySparkException):
        weather.hourly_rows(response(spark, times, **arrays), date(2024, 1, 1), date(2024, 1, 2)).collect()


def test_windows_and_pages(spark):
    bounds = spark.createDataFrame([(date(2024, 1, 1), date(2024, 3, 2))], "start date, end date")
    assert windows.chunk_windows(bounds).count() == 3
    assert windows.daily_window(date(2024, 5, 2)) == (date(2024, 5, 1), date(2024, 5, 2))
    assert windows.weather_window(date(2024, 1, 29)) == (date(2024, 1, 10), date(2024, 1, 24))
    with pytest.raises(ValueError):
        windows.year_window(2023, first=2024)
    rows = spark.createDataFrame([(f"{n:03d}", "2024-01-01T00:00:00") for n in range(25)], "id string, at string")

    def fetch(cursor):
        return paging.keyset_page(rows, "id", "at", "2024-01-01", "2024-01-02", cursor, 10)

    assert [p.count() for p in paging.iterate_pages(fetch, "id", 10)] == [10, 10, 5]
    with pytest.raises(ValueError):
        list(paging.iterate_pages(lambda cursor: fetch(None), "id", 10))
    with pytest.raises(ValueError):
        paging.keyset_page(rows, "id", "at", "2024-01-02", "2024-01-01")


def area(number, **change):
    ring = [[[0, 0], [1, 1], [0, 0]]]
    return {"area_num_1": str(number), "community": f"Area {number}", "the_geom": {"type": "Polygon", "coordinates": ring}, **change}


def area_rows(spark, rows):
    return areas.decode_areas(spark.createDataFrame([(json.dumps(r),) for r in rows], "payload string"))


def test_area_snapshot(spark):
    assert areas.checked_areas(area_rows(spark, [area(1), area(2)])).count() == 2
    assert areas.checked_areas(area_rows(spark, [area(n) for n in range(1, 78)]), complete=True).count() == 77
    bad = [[], [area(1), area(1)], [area(78)], [area(1, community="")], [area(1, the_geom={"type": "Point", "coordinates": [0]})], [area("x")]]
    for rows in bad:
        frame = area_rows(spark, rows) if rows else area_rows(spark, [area(1)]).filter("false")
        with pytest.raises(ValueError):
            areas.checked_areas(frame)


def test_enrichment_case(spark):
    changes = [
        {"trip_start_timestamp": "2024-11-03T01:10:00"},
        {"trip_start_timestamp": "2024-11-03T02:10:00", "pickup_community_area": "99", "dropoff_community_area": ""},
        {"trip_start_timestamp": "2024-11-03T03:10:00", "dropoff_community_area": "01"},
    ]
    fact = trips.with_keys(trips.accepted(trips.typed(trips.decode(raw(spark, [{**c, "trip_total": "8"} for c in changes])))))
    area_raw = spark.createDataFrame([(str(n), json.dumps(area(n))) for n in (1, 2)], "area_id string, payload string")
    hour = {"temperature_2m": 5.0, "precipitation": 1.0, "snowfall": 0.0}
    payloads = [{**hour, "local_hour": "2024-11-03T01:00:00"}] * 2 + [{**hour, "local_hour": "2024-11-03T03:00:00", "snowfall": 1.0}]
    weather_raw = spark.createDataFrame([(json.dumps(p),) for p in payloads], "payload string")
    tables = enrichment.enrichment_tables(fact, area_raw, weather_raw)
    rows = {r["trip_id"]: r for r in tables["gold.mart_enriched_trips"].collect()}
    assert [rows[k]["weather_condition"] for k in "012"] == ["Ambiguous DST hour", "Unavailable", "Snow"]
    assert rows["1"]["pickup_area_name"] == "Unknown" and rows["2"]["dropoff_area_name"] == "Area 1"
    assert tables["silver.dim_weather_hour"].count() == 2
    demand = tables["gold.mart_area_demand"].filter("activity = 'Pickup'")
    assert {r["area_id"]: r["area_name"] for r in demand.collect()} == {"1": "Area 1", "99": "Unknown"}
    assert demand.agg(F.sum("reported_total_usd")).first()[0] == 24
    assert tables["gold.mart_weather_demand"].count() == 3


def incoming(spark, run, total="12"):
    def rows(pairs):
        return envelope(spark, [(k, json.dumps(v), f"2024-02-0{run}", f"run_{run}", n) for n, (k, v) in enumerate(pairs)])

    good = [(str(n), {**BASE, "trip_id": str(n), "trip_total": total, "trip_start_timestamp": f"2024-01-0{1 + n % 3}T0{n % 9}:00:00"}) for n in range(20)]
    hours = [(f"{d}{h}", {"local_hour": f"2024-01-0{d}T0{h}:00:00", "temperature_2m": 5.0, "precipitation": 0.0, "snowfall": 0.0}) for d in (1, 2) for h in range(9)]
    return {
        "taxi_trip_raw": rows([*good, ("bad", {**BASE, "fare": "x"})]),
        "community_area_raw": rows([(str(n), area(n)) for n in (1, 2, 3)]),
        "weather_hour_raw": rows(hours),
    }


def test_trip_job_publishes_replays_and_fails_safely(spark, tmp_path):
    root = str(tmp_path / "lake")
    first = jobs.trip_lake(spark, root, incoming(spark, 1), "run_a")
    assert (first["bronze_trips"], first["accepted_trips"], first["quarantined_trips"]) == (21, 20, 1)
    assert first["reported_total_usd"] == 240
    second = jobs.trip_lake(spark, root, incoming(spark, 2, "13"), "run_b")
    assert second["accepted_trips"] == 20 and second["reported_total_usd"] == 260
    broken = incoming(spark, 3)
    broken["community_area_raw"] = None
    with pytest.raises(Exception):
        jobs.trip_lake(spark, root, broken, "run_c")
    assert snapshots.current_run(spark, root) == "run_b"
    enriched = snapshots.read_current(spark, root, "gold.mart_taxi_trip_enriched")
    assert enriched.count() == 20 and set(enriched.columns) == set(TABLES["gold.mart_taxi_trip_enriched"].types)
    statuses = [r["status"] for r in snapshots.run_records(spark, root).collect()]
    assert sorted(statuses) == ["failed", "running", "running", "running", "success", "success"]


def test_trips_move_once_by_date_and_without_their_keys(spark):
    bronze, plans = incoming(spark, 1), {}

    def write(name, frame, gather=True):
        plans[name] = frame._jdf.queryExecution().optimizedPlan().toString().splitlines(), gather
        return spark.createDataFrame(frame.collect(), frame.schema)

    stored = jobs.build_trip_tables(bronze, write)
    fact, gather = plans["silver.fact_taxi_trip"]
    moved = next(n for n, line in enumerate(fact) if "RebalancePartitions [trip_date" in line)
    keyed = [n for n, line in enumerate(fact) if "AS taxi_key" in line]
    assert keyed and max(keyed) < moved and not gather
    per_trip = [name for name, frame in stored.items() if "trip_id" in frame.columns and name.startswith("gold.")]
    assert len(per_trip) == 2 and not any(plans[name][1] for name in per_trip)
    assert stored["silver.fact_taxi_trip"].count() == 20


def test_usual_local_times_equal_those_by_zone_rules(spark, monkeypatch):
    # The middle of every hour of 220 years.
    stamp = spark.range(220 * 366 * 24).select(F.expr("timestamp_ntz'1880-01-01 00:30:00' + make_interval(0, 0, 0, 0, id)").alias("at"))
    text = stamp.select(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("t"))
    odd = [
        "2024-03-10T02:30:00", "2024-03-10T03:00:00", "2024-11-03T01:30:00.5", "2024-13-01T00:00:00", "2024-02-30T05:00:00",
        "2024-01-01T24:00:00", "2024-01-01T10:00:00.1234567", "2024-01-01T10:00:00.", "2024-01-01T10:00:00\n", "2024-01-01T10:00:00Z",
        "2024-01-01T10:00:00.5+02:00", "2024-01-01 10:00:00", " 2024-01-01T10:00:00", "2024-1-1T1:2:3", "0000-01-01T00:00:00",
        "9999-12-31T23:59:59.999999", "10:00:00", "now", "", None,
    ]
    text = text.unionByName(spark.createDataFrame([(t,) for t in odd], "t string"))
    usual = local_wall_clock(F.col("t"))
    monkeypatch.setattr(times, "SKIPPED_HOUR", {})
    by_rules = local_wall_clock(F.col("t"))
    pairs = text.select("t", usual.alias("usual"), by_rules.alias("by_rules"))
    assert pairs.filter(~F.col("usual").eqNullSafe(F.col("by_rules"))).limit(5).collect() == []
    moved = values(spark, lambda _: usual, ["2024-03-10T02:30:00", "2024-03-10T01:30:00"])
    assert [m.hour for m in moved] == [3, 1]


def test_tables_of_a_run_are_written_side_by_side(spark, tmp_path):
    bronze, order, meet = incoming(spark, 1), [], threading.Barrier(jobs.SIDE_BY_SIDE)

    def write(name, frame, gather):
        order.append(name)
        if len(order) <= jobs.SIDE_BY_SIDE:
            meet.wait(60)
        path = f"{tmp_path}/{name}"
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    stored = jobs.build_trip_tables(bronze, write)
    assert set(order) == set(stored) == {name for name in TABLES if not name.startswith("bronze.")}
    assert stored["silver.fact_taxi_trip"].count() == 20 and stored["silver.quarantine_taxi_trip"].count() == 1


def test_after_an_error_no_further_action_starts(spark):
    started = []

    def action(number):
        def run():
            started.append(number)
            if number == 1:
                raise ValueError("second action")
            time.sleep(0.2)
            return number
        return run

    with pytest.raises(ValueError, match="second action"):
        jobs.at_once(spark, [action(n) for n in range(40)])
    assert len(started) < 20
    assert jobs.at_once(spark, [action(n) for n in (5, 4, 3, 2, 0, 7)]) == [5, 4, 3, 2, 0, 7]


def test_required_values_skip_files_without_nulls(spark, tmp_path):
    rows = [(n, None if n == 7 else "x", None if n in (7, 9) else Decimal(n), n % 2 if n else None) for n in range(20)]
    frame = spark.createDataFrame(rows, "k int, v string, d decimal(20,6), p int")
    path = f"{tmp_path}/t"
    frame.coalesce(1).write.partitionBy("p").parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    found = quality.required_values("t", table, ["k", "v", "d", "p"], ["p"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "IsNull(v)" in plan.split("PushedFilters")[1] and "isnull(p" in plan.split("PartitionFilters", 2)[2]
    # Three in the files, and the one row without a partition value.
    assert [(r["violations"], r["passed"]) for r in found.collect()] == [(4, False)]
    whole = quality.required_values("t", table.filter("k not in (0, 7, 9)"), ["k", "v", "d", "p"], ["p"])
    assert [(r["violations"], r["passed"]) for r in whole.collect()] == [(0, True)]


def test_checks_find_faults(spark):
    frame = spark.createDataFrame([(1, None), (1, "x")], "k int, v string")
    contract = TABLES["silver.dim_taxi"]
    found = quality.report([
        quality.unique_grain("t", frame, ["k"]), quality.required_values("t", frame, ["k", "v"]),
        quality.schema_drift(spark, "t", frame, contract), quality.table_set(spark, {"t": frame}, TABLES),
    ])
    assert {r["check"]: r["violations"] for r in found.collect()} == {
        "unique key": 1, "required values": 1, "schema": 4, "table set": 21,
    }
    with pytest.raises(quality.QualityError):
        quality.require_passed(found)
