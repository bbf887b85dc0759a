"""Capture, sequence numbers, snapshot markers and delivery of the stored outbox."""

import pytest
from pyspark.sql import functions as F

from tablemart import outbox_store as store
from tablemart.plans import outbox
from tablemart.sinks import snapshots


def loans(spark, *rows):
    return spark.createDataFrame(list(rows), "loan_id long, status string")


def sequences(spark, root):
    return [(r["event_sequence"], r["operation"], r["record_key"]) for r in store.outbox_events(spark, root).orderBy("event_sequence").collect()]


def test_snapshot_once_then_changes_in_sequence(spark, tmp_path):
    root, out = str(tmp_path / "box"), str(tmp_path / "out")
    old = loans(spark, (1, "active"), (2, "active"))
    moves = spark.createDataFrame([(7, 1)], "transaction_id long, loan_id long")
    tables = {"loans": (old, "loan_id"), "loan_transactions": (moves, "transaction_id")}
    assert store.take_snapshot(spark, root, tables, "initial-v1", "a") == 3
    assert store.take_snapshot(spark, root, tables, "initial-v1", "b") == 0
    new = loans(spark, (1, "closed"), (3, "active"))
    assert store.capture(spark, root, outbox.capture_changes(old, new, "lending", "loans", "loan_id"), "c") == 3
    assert sequences(spark, root) == [
        (1, "I", '{"transaction_id":7}'), (2, "I", '{"loan_id":1}'), (3, "I", '{"loan_id":2}'),
        (4, "U", '{"loan_id":1}'), (5, "D", '{"loan_id":2}'), (6, "I", '{"loan_id":3}'),
    ]
    ids = [r["event_id"] for r in store.outbox_events(spark, root).collect()]
    assert len(set(ids)) == 6 and store.outbox_events(spark, root).filter("captured_at IS NULL").isEmpty()
    assert store.drain(spark, root, out, size=2, batches=1)["uploaded"] == 2
    assert outbox.pending(store.outbox_events(spark, root)).count() == 4
    totals = store.drain(spark, root, out, size=2)
    assert (totals["selected"], totals["uploaded"], totals["batches"]) == (4, 4, 2)
    assert store.drain(spark, root, out)["selected"] == 0
    assert store.delivered_events(spark, out).count() == 6
    assert (tmp_path / "out/source=lending-postgres-dev/schema=lending/table=loans").is_dir()


def test_a_lost_acknowledgement_and_other_bytes(spark, tmp_path):
    root, out = str(tmp_path / "box"), str(tmp_path / "out")
    store.take_snapshot(spark, root, {"loans": (loans(spark, (1, "active"), (2, "active")), "loan_id")}, "v1", "a")
    store.deliver(store.outcomes(spark, root, out), out)
    assert store.drain(spark, root, out)["reused"] == 2
    assert store.delivered_events(spark, out).count() == 2
    store.capture(spark, root, outbox.capture_changes(loans(spark), loans(spark, (9, "x")), "lending", "loans", "loan_id"), "b")
    found = store.outcomes(spark, root, out)
    store.deliver(found.withColumn("event_json", F.lit("{}")), out)
    with pytest.raises(outbox.DeliveryConflict):
        store.drain(spark, root, out)


def test_a_capture_that_stopped_is_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "box")
    rows = {"loans": (loans(spark, (1, "active")), "loan_id")}
    real = snapshots.move_pointer

    def crash(*_):
        raise RuntimeError("injected")

    monkeypatch.setattr(store.snapshots, "move_pointer", crash)
    with pytest.raises(RuntimeError):
        store.take_snapshot(spark, root, rows, "v1", "a")
    monkeypatch.setattr(store.snapshots, "move_pointer", real)
    assert store.outbox_events(spark, root).isEmpty()
    assert store.take_snapshot(spark, root, rows, "v1", "b") == 1
    assert sequences(spark, root) == [(1, "I", '{"loan_id":1}')]


def test_of_two_captures_of_one_sequence_one_is_refused(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "box")
    one = outbox.capture_changes(loans(spark), loans(spark, (1, "x")), "lending", "loans", "loan_id")
    store.capture(spark, root, one, "a")
    monkeypatch.setattr(store.snapshots, "current_pointer", lambda *_: None)
    with pytest.raises(snapshots.PublishConflict):
        store.capture(spark, root, one, "b")
    monkeypatch.undo()
    assert len(sequences(spark, root)) == 1 and not (tmp_path / "box/events/run=b").exists()


def test_images_and_changed_keys(spark):
    image = "struct<loan_id: long, status: string>"
    rows = [("I", None, (1, "a")), ("U", (1, "a"), (1, None)), ("D", (1, "b"), None)]
    images = spark.createDataFrame(rows, f"operation string, before {image}, after {image}")
    got = store.image_events(images, "lending", "loans", "loan_id").collect()
    assert [(r["operation"], r["record_data"]) for r in got] == [
        ("I", '{"loan_id":1,"status":"a"}'), ("U", '{"loan_id":1,"status":null}'), ("D", '{"loan_id":1,"status":"b"}'),
    ]
    moved = spark.createDataFrame([("U", (1, "a"), (2, "a"))], f"operation string, before {image}, after {image}")
    with pytest.raises(store.KeyChanged, match="loan_id"):
        store.image_events(moved, "lending", "loans", "loan_id")
