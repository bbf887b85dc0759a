"""Outbox delivery and change capture as table operations."""

from pyspark.sql import functions as F

from tablemart.contracts import CAPTURE_METHOD, DEFAULT_SOURCE, SCHEMA_VERSION
from tablemart.functions.times import outbox_text
from tablemart.operators.merge import snapshot_changes
from tablemart.operators.ranking import number_rows
from tablemart.sinks.tables import write_partitioned

BATCH_SIZE = 100


class DeliveryConflict(ValueError):
    """A delivered event differs from the outbox row with its id."""


def pending(outbox):
    """Rows that were not exported yet."""
    return outbox.filter(F.col("exported_at").isNull())


def oldest_pending(outbox, count):
    """A bounded batch, lowest sequence first; an earlier sequence that was committed later is
    simply first in the next batch."""
    return pending(outbox).orderBy("event_sequence").limit(count)


def as_events(rows, source=DEFAULT_SOURCE):
    """Outbox rows rendered as event JSON; keys and images are JSON text, kept number for
    number, and the sequence is text because it is no commit order."""
    envelope = F.struct(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(CAPTURE_METHOD).alias("capture_method"),
        F.lit(source).alias("source_system"),
        "event_id",
        F.col("event_sequence").cast("string").alias("event_sequence"),
        "source_schema",
        "source_table",
        "operation",
        F.parse_json("record_key").alias("record_key"),
        F.parse_json("record_data").alias("record_data"),
        outbox_text(F.col("captured_at")).alias("captured_at"),
    )
    return rows.select(
        "event_id", "event_sequence", "source_schema", "source_table",
        F.to_json(envelope).alias("event_json"),
    )


def delivery_outcomes(events, delivered):
    """uploaded (not there yet), reused (same bytes there) or conflict (other bytes there)."""
    there = delivered.select("event_id", F.col("event_json").alias("_there"))
    outcome = (
        F.when(F.col("_there").isNull(), "uploaded")
        .when(F.col("_there") == F.col("event_json"), "reused")
        .otherwise("conflict")
    )
    return events.join(there, "event_id", "left").withColumn("outcome", outcome).drop("_there")


def acknowledge(outbox, outcomes, exported_at):
    """The outbox with `exported_at` set on exactly the pending rows that were delivered."""
    done = outcomes.filter(F.col("outcome").isin("uploaded", "reused")).select(
        "event_id", F.lit(True).alias("_done")
    )
    stamp = F.when(F.col("_done"), F.lit(exported_at).cast(outbox.schema["exported_at"].dataType))
    return (
        outbox.join(done, "event_id", "left")
        .withColumn("exported_at", F.coalesce("exported_at", stamp))
        .select(*outbox.columns)
    )


def drain_batches(outbox, delivered, source=DEFAULT_SOURCE, size=BATCH_SIZE, batches=None):
    """All pending events, or those of the next `batches` batches, with batch number and outcome.

    Batches hold `size` events each in order of sequence. Numbers come from a range sort over all
    tasks, so there is no bound on how many events one drain takes.
    """
    if size < 1 or batches is not None and batches < 1:
        raise ValueError("batch size and batch count start at 1")
    rows = pending(outbox) if batches is None else oldest_pending(outbox, size * batches)
    numbered = number_rows(rows.select("event_id", "event_sequence"), ("event_sequence", "event_id"), "place", 1)
    batch = F.ceil(F.col("place") / F.lit(size)).cast("int")
    events = as_events(rows, source).join(numbered.select("event_id", batch.alias("batch")), "event_id")
    return delivery_outcomes(events, delivered)


def drain_totals(outcomes):
    """One row of totals; conflicts stop the delivery and are never acknowledged."""
    return outcomes.agg(
        F.count("*").alias("selected"),
        F.count_if(F.col("outcome") == "uploaded").alias("uploaded"),
        F.count_if(F.col("outcome") == "reused").alias("reused"),
        F.count_if(F.col("outcome") != "conflict").alias("acknowledged"),
        F.countDistinct("batch").alias("batches"),
    )


def deliver(outcomes, path, source=DEFAULT_SOURCE):
    """Append the events that are not there yet, in folders source= / schema= / table=."""
    if not outcomes.filter(F.col("outcome") == "conflict").isEmpty():
        raise DeliveryConflict("a delivered event differs from the outbox event")
    fresh = outcomes.filter(F.col("outcome") == "uploaded").select(
        F.lit(source).alias("source"), F.col("source_schema").alias("schema"),
        F.col("source_table").alias("table"), "event_id", "event_json",
    )
    write_partitioned(fresh, path, ["source", "schema", "table"], mode="append")


def derived_event_id(*columns):
    """UUID text that depends only on the named values, so a rerun gives the same id.

    An MD5 is 32 lower-case digits, so dashes at their places are all that its canonical spelling needs.
    """
    digest, at, parts = F.md5(F.concat_ws("/", *columns)), 1, []
    for length in (8, 4, 4, 4, 12):
        parts.append(F.substring(digest, at, length))
        at += length
    return F.concat_ws("-", *parts)


def bootstrap_events(rows, schema, table, key, snapshot_name, markers):
    """The rows as 'I' events, once per snapshot name: none when the marker exists."""
    events = rows.select(
        F.lit(snapshot_name).alias("snapshot_name"),
        F.lit(schema).alias("source_schema"),
        F.lit(table).alias("source_table"),
        F.lit("I").alias("operation"),
        F.to_json(F.struct(key)).alias("record_key"),
        F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("record_data"),
    )
    return events.join(markers.select("snapshot_name"), "snapshot_name", "left_anti")


def capture_changes(old, new, schema, table, key):
    """I/U/D events between two states of a table. A changed key is a delete and an insert."""
    changes = snapshot_changes(old, new, [key])
    return changes.select(
        F.lit(schema).alias("source_schema"),
        F.lit(table).alias("source_table"),
        "operation",
        F.to_json("record_key").alias("record_key"),
        F.to_json("record_data", {"ignoreNullFields": "false"}).alias("record_data"),
    )
