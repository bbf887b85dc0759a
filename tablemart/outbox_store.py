"""A stored outbox: snapshots and changes captured once, in sequence, and delivered at least once.

Each capture is a folder of events and one small pointer file, created after the folder is whole. The
file holds the first sequence, the number of events and the snapshot's name, so events, sequence numbers
and the marker of a snapshot become valid together; of two captures at once one is refused. Delivered
events lie in source= / schema= / table= / bucket= folders, which are also the index of what was delivered:
a drain reads the buckets of its own event ids. Acknowledgements are appended; one that was lost shows as
'reused' in the next drain.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablemart.contracts import DEFAULT_SOURCE
from tablemart.operators.merge import absent_rows
from tablemart.operators.ranking import number_rows
from tablemart.plans import outbox
from tablemart.sinks import snapshots
from tablemart.sinks.buckets import bucket_of
from tablemart.sinks.tables import write_new, write_partitioned
from tablemart.storage import remove, via_table

CAPTURES = "version bigint, run_id string, first bigint, count bigint, snapshot string"
EVENTS = (
    "event_id string, event_sequence bigint, source_schema string, source_table string, operation string,"
    " record_key string, record_data string, captured_at timestamp_ntz"
)
ACKNOWLEDGED = "event_id string, exported_at timestamp_ntz"
DELIVERED = "event_id string, event_json string, source string, schema string, table string, bucket int"
DELIVERY_BUCKETS = 64


class KeyChanged(ValueError):
    """An update changed the key of its row, which a captured table must not do."""


def _read(spark, path, ddl):
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def captures(spark, root):
    """One row per capture: its run, first sequence, number of events and snapshot name."""
    return snapshots.pointer_rows(spark, root, CAPTURES)


def outbox_events(spark, root):
    """All captured events with `exported_at`, null while pending. Folders without a pointer file are
    captures that stopped; they are not part of it."""
    runs = [r["run_id"] for r in captures(spark, root).filter("count > 0").select("run_id").collect()]
    if not runs:
        return spark.createDataFrame([], f"{EVENTS}, exported_at timestamp_ntz")
    events = spark.read.schema(EVENTS).parquet(*[f"{root}/events/run={r}" for r in sorted(runs)])
    done = _read(spark, f"{root}/acknowledged", ACKNOWLEDGED).groupBy("event_id").agg(F.min("exported_at").alias("exported_at"))
    return events.join(done, "event_id", "left")


def _capture(spark, root, events, captured_at, run_id, snapshot=None):
    """Number the events behind the last sequence, store them, and make them valid; the number of them."""
    head = snapshots.current_pointer(spark, root) or {"version": 0, "first": 1, "count": 0}
    first = head["first"] + head["count"]
    numbered = number_rows(events, ("source_schema", "source_table", "record_key", "operation"), "event_sequence", first)
    at = F.lit(captured_at).cast("timestamp_ntz") if captured_at else F.current_timestamp().cast("timestamp_ntz")
    name = outbox.derived_event_id("source_schema", F.col("event_sequence").cast("string"))
    folder = f"{root}/events/run={run_id}"
    columns = [c.split()[0] for c in EVENTS.split(", ")]
    write_new(numbered.withColumns({"event_id": name, "captured_at": at}).select(*columns), folder)
    count = spark.read.schema(EVENTS).parquet(folder).count()
    row = {"run_id": run_id, "first": first, "count": count, "snapshot": snapshot}
    try:
        snapshots.move_pointer(spark, root, row, head["version"])
    except snapshots.PublishConflict:
        remove(spark, folder)
        raise
    return count


def take_snapshot(spark, root, tables, name, run_id, schema="lending", captured_at=None):
    """Events for all rows of the tables ({name: (rows, key)}), once per snapshot name.

    The marker is part of the capture's pointer file: a snapshot that stopped left none and is taken
    again from the start, one that ended is never taken twice (0 events).
    """
    if not captures(spark, root).filter(F.col("snapshot") == name).isEmpty():
        return 0
    none = spark.createDataFrame([], "snapshot_name string")
    parts = [outbox.bootstrap_events(rows, schema, table, key, name, none) for table, (rows, key) in tables.items()]
    events = parts[0]
    for part in parts[1:]:
        events = events.unionByName(part)
    return _capture(spark, root, events.drop("snapshot_name"), captured_at, run_id, name)


def image_events(images, schema, table, key):
    """Events of row changes (operation, before, after). An update that changes the key is refused."""
    was, now = F.col(f"before.{key}"), F.col(f"after.{key}")
    moved = images.filter((F.col("operation") == "U") & ~was.eqNullSafe(now)).select(was.alias("was")).first()
    if moved:
        raise KeyChanged(f"changing {key} of {schema}.{table} is not supported: {moved['was']}")
    row = F.when(F.col("operation") == "D", F.col("before")).otherwise(F.col("after"))
    return images.select(
        F.lit(schema).alias("source_schema"), F.lit(table).alias("source_table"), "operation",
        F.to_json(F.struct(row[key].alias(key))).alias("record_key"),
        F.to_json(row, {"ignoreNullFields": "false"}).alias("record_data"),
    )


def capture(spark, root, events, run_id, captured_at=None):
    """Changes (source_schema, source_table, operation, record_key, record_data) as events with ids,
    sequence numbers and the time of capture."""
    return _capture(spark, root, events, captured_at, run_id)


def _bucket():
    return bucket_of([F.col("event_id")], DELIVERY_BUCKETS)


def outcomes(spark, root, out, source=DEFAULT_SOURCE, size=outbox.BATCH_SIZE, batches=None):
    """Pending events with batch and outcome, against what lies in the buckets of their ids."""
    pending = outbox.pending(outbox_events(spark, root))
    wanted = sorted(r["b"] for r in pending.select(_bucket().alias("b")).distinct().collect())
    delivered = _read(spark, out, DELIVERED).filter(F.col("bucket").isin(wanted)).select("event_id", "event_json")
    return via_table(outbox.drain_batches(pending, delivered, source, size, batches), "outcomes")


def deliver(found, out, source=DEFAULT_SOURCE):
    """Append the events that are not there yet; nothing if any was delivered with other bytes."""
    if not found.filter("outcome = 'conflict'").isEmpty():
        raise outbox.DeliveryConflict("a delivered event differs from the outbox event")
    fresh = found.filter("outcome = 'uploaded'").select(
        F.lit(source).alias("source"), F.col("source_schema").alias("schema"), F.col("source_table").alias("table"),
        _bucket().alias("bucket"), "event_id", "event_json",
    )
    write_partitioned(fresh, out, ["source", "schema", "table", "bucket"], mode="append")


def drain(spark, root, out, source=DEFAULT_SOURCE, size=outbox.BATCH_SIZE, batches=None, exported_at=None):
    """Deliver pending events and acknowledge them; the totals as a dict."""
    found = outcomes(spark, root, out, source, size, batches)
    deliver(found, out, source)
    acknowledge(spark, root, found, exported_at)
    return outbox.drain_totals(found).first().asDict()


def acknowledge(spark, root, outcomes, exported_at=None):
    """Append the acknowledgement of delivered events that have none yet."""
    at = F.lit(exported_at).cast("timestamp_ntz") if exported_at else F.current_timestamp().cast("timestamp_ntz")
    done = outcomes.filter("outcome <> 'conflict'").select("event_id", at.alias("exported_at"))
    absent_rows(_read(spark, f"{root}/acknowledged", ACKNOWLEDGED), done, ["event_id"]).write.mode("append").parquet(
        f"{root}/acknowledged"
    )


def delivered_events(spark, out):
    """What lies in the delivery folders."""
    return _read(spark, out, DELIVERED)
