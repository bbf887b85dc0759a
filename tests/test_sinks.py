"""Catalog tables, delivery folders, exports and JDBC options."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from change_events import example, write
from tablemart import jobs, table_notes
from tablemart.contracts import TABLES
from tablemart.plans import cdc, outbox
from tablemart.sinks import exports, snapshots, tables
from tablemart.sources import files, jdbc


def test_catalog_tables(spark, tmp_path):
    names = tables.create_cdc_tables(spark, "lending_cdc")
    assert names == tables.create_cdc_tables(spark, "lending_cdc")
    root = str(tmp_path / "lake")
    jobs.cdc_lake(spark, files.read_documents(spark, write(tmp_path / "raw", example())), root)
    for table in ("loans", "loan_transactions"):
        state = jobs.state(spark, root, table)
        assert state.schema.simpleString() == files.read_table(spark, f"lending_cdc.{table}_state").schema.simpleString()
        tables.replace_table(state, f"lending_cdc.{table}_state")
    current = cdc.business_columns(files.read_table(spark, "lending_cdc.loan_transactions_state"), "loan_transactions")
    assert current.count() == 3 and current.columns[:2] == ["source_system", "transaction_id"]
    ledger = jobs.ledger(spark, root)
    assert set(ledger.columns) == set(files.read_table(spark, "lending_cdc.event_ledger").columns)
    tables.register_location(spark, "lending_cdc.ledger_files", f"{root}/event_ledger")
    assert files.read_table(spark, "lending_cdc.ledger_files").count() == 8
    with pytest.raises(AnalysisException):
        files.read_table(spark, "lending_cdc.loans; drop table x")


def test_manifest_says_what_tables_and_columns_mean(spark, tmp_path):
    frames = {name: spark.createDataFrame([], contract.schema) for name, contract in TABLES.items()}
    frames["extra.notes"] = spark.createDataFrame([], "unknown_column int")
    snapshots.write_manifest(spark, str(tmp_path), "run_1", snapshots.table_metadata(frames, TABLES))
    rows = {r["table_name"]: r for r in snapshots.manifest(spark, str(tmp_path), "run_1").collect()}
    assert set(rows) == set(frames) and {r["owner"] for r in rows.values()} == {table_notes.OWNER}
    assert set(table_notes.TABLES) == set(TABLES)
    daily = rows["gold.mart_taxi_demand_daily"]
    assert (daily["grain"], daily["partition_by"], daily["contract_version"]) == ("trip_date", "trip_date", 1)
    assert daily["columns"][1].asDict() == {"name": "trips", "type": "bigint", "description": "Number of trips"}
    extra = rows["extra.notes"]
    assert (extra["description"], extra["grain"]) == ("extra.notes", "")
    assert extra["columns"][0]["description"] == "unknown_column"
    published = {c.name for contract in TABLES.values() for c in contract.schema}
    assert set(table_notes.COLUMNS) <= published
    with pytest.raises(AnalysisException):
        snapshots.write_manifest(spark, str(tmp_path), "run_1", snapshots.table_metadata(frames, TABLES))


def box(spark, rows):
    return spark.createDataFrame(rows, (
        "event_id string, event_sequence bigint, source_schema string, source_table string, operation string,"
        " record_key string, record_data string, captured_at timestamp_ntz, exported_at timestamp_ntz"
    ))


def test_delivery_is_idempotent_and_detects_other_bytes(spark, tmp_path):
    from datetime import datetime

    stamp = datetime(2026, 11, 1, 12)
    rows = [
        (f"id-{n}", n, "lending", "loans" if n % 2 else "loan_transactions", "I", '{"loan_id":1}', '{"loan_id":1,"x":1.50}', stamp, None)
        for n in (5, 3, 1, 4, 2)
    ]
    source, path = box(spark, rows), str(tmp_path / "out")
    delivered = spark.createDataFrame([], "event_id string, event_json string")
    first = outbox.drain_batches(source, delivered, size=2, batches=1)
    assert [r["event_sequence"] for r in first.orderBy("event_sequence").collect()] == [1, 2]
    outbox.deliver(first, path)
    assert os.path.isdir(f"{path}/source=lending-postgres-dev/schema=lending/table=loans")
    stored = files.read_parquet(spark, path).select("event_id", "event_json")
    assert json.loads(stored.filter("event_id = 'id-1'").first()["event_json"])["event_sequence"] == "1"
    # The acknowledgement was lost: the same batch is reused, not sent again.
    again = outbox.drain_batches(source, stored, size=2, batches=1)
    totals = outbox.drain_totals(again).first()
    assert (totals["selected"], totals["uploaded"], totals["reused"], totals["acknowledged"]) == (2, 0, 2, 2)
    left = outbox.pending(outbox.acknowledge(source, again, "2026-11-02"))
    assert left.count() == 3
    wrong = stored.withColumn("event_json", F.lit("{}"))
    with pytest.raises(outbox.DeliveryConflict):
        outbox.deliver(outbox.drain_batches(source, wrong, size=2, batches=1), path)
    assert files.read_parquet(spark, path).count() == 2
    with pytest.raises(ValueError):
        outbox.drain_batches(source, stored, size=0)
    whole = outbox.drain_batches(source, stored, size=2)
    assert {r["event_sequence"]: r["batch"] for r in whole.collect()} == {1: 1, 2: 1, 3: 2, 4: 2, 5: 3}


def test_feature_collection_is_one_document(spark, tmp_path):
    polygon = '{"type":"Polygon","coordinates":[[[0,0],[1,1.50],[0,0]]]}'
    areas = spark.createDataFrame([(str(n), f"Area {n}", polygon) for n in (2, 1)], "area_id string, area_name string, geometry_geojson string")
    exports.write_feature_collection(areas, str(tmp_path / "areas"))
    parts = sorted(p for p in (tmp_path / "areas").iterdir() if p.name.startswith("part-"))
    document = json.loads("".join(p.read_text() for p in parts))
    assert [f["properties"]["area_id"] for f in document["features"]] == ["1", "2"]
    assert document["features"][0]["geometry"] == json.loads(polygon)


def test_two_publishers_of_one_version(spark, tmp_path):
    from tablemart.sinks import snapshots

    root = str(tmp_path / "published")
    assert snapshots.publish(spark, root, "a", "2024-01-01T00:00:00+00:00", ["t"]) == 1
    based_on = snapshots.current_version(spark, root)
    assert snapshots.publish(spark, root, "b", "2024-01-02T00:00:00+00:00", ["t"], based_on) == 2
    before = sorted(p.name for p in (tmp_path / "published").rglob("*"))
    with pytest.raises(snapshots.PublishConflict):
        snapshots.publish(spark, root, "c", "2024-01-02T00:00:01+00:00", ["t"], based_on)
    assert sorted(p.name for p in (tmp_path / "published").rglob("*")) == before
    assert snapshots.current_run(spark, root) == "b"
    assert [r["run_id"] for r in snapshots.pointer_rows(spark, root).orderBy("version").collect()] == ["a", "b"]


def test_of_many_publishers_at_once_one_wins(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from tablemart.sinks import snapshots

    root = str(tmp_path / "published")

    def publish(name):
        try:
            return snapshots.publish(spark, root, name, "2024-01-01", ["t"], 0) and name
        except snapshots.PublishConflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [n for n in pool.map(publish, [f"run_{n}" for n in range(16)]) if n]
    assert len(won) == 1 and snapshots.current_run(spark, root) == won[0]


def test_jdbc_options():
    query = jdbc.bucketed_query("bronze.trips", "trip_id", ["trip_id", "payload::text payload"], 16)
    assert "% 16" in query and query.endswith("src")
    options = jdbc.parallel_read_options("jdbc:x", query, 16, user="u")
    assert options["partitionColumn"] == "bucket" and options["numPartitions"] == options["upperBound"] == "16"
    assert jdbc.single_read_options("jdbc:x", "t")["dbtable"] == "t"
    assert jdbc.write_options("jdbc:x", "stage.t")["batchsize"] == "5000"


def test_scan_is_spread_by_its_rows(spark, tmp_path):
    spark.range(2_000_000).coalesce(1).write.parquet(f"{tmp_path}/rows")
    assert files.spread_scan(spark.read.parquet(f"{tmp_path}/rows")).rdd.getNumPartitions() == 20
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/few")
    assert files.spread_scan(spark.read.parquet(f"{tmp_path}/few")).rdd.getNumPartitions() == 8
