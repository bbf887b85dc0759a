"""Ledger, state and portfolio: replay, late and conflicting events, recovery, streaming."""

import json
from decimal import Decimal
from unittest.mock import patch

import pytest
from pyspark.sql import functions as F

from change_events import example, loan, transaction, write
from tablemart import change_lake, jobs
from tablemart.plans import cdc
from tablemart.sources.files import read_documents
from tablemart.streaming.events import stream_cdc


def run(spark, folder, root, **more):
    return jobs.cdc_lake(spark, read_documents(spark, folder), root, **{"buckets": 4, **more})


def transactions(spark, root):
    return cdc.current(jobs.state(spark, root, "loan_transactions"))


def test_load_replay_and_later_update(spark, tmp_path):
    root, raw = str(tmp_path / "lake"), write(tmp_path / "raw", example())
    assert run(spark, raw, root) == {
        "input": 8, "quarantined": 0, "valid_unique": 8, "ledger_events": 8, "current_loans": 2,
        "current_transactions": 3, "orphan_transactions": 0,
    }
    gone = jobs.state(spark, root, "loan_transactions").filter("transaction_id = 5999").first()
    assert gone["is_deleted"] and gone["event_sequence"] == 8
    mart = {r["loan_id"]: r for r in jobs.loan_portfolio(spark, root).collect()}
    assert mart[1001]["transaction_count"] == 2
    assert mart[1001]["repaid_amount"] == Decimal("100.00")
    assert mart[1001]["disbursed_amount"] == Decimal("1000.00")
    # A duplicate file, a stale insert and a broken file change nothing but the quarantine.
    write(tmp_path / "raw", [json.dumps(example()[5]), "{broken"])
    for scope in ("history", "touched"):
        report = run(spark, raw, root, scope=scope)
        assert report["quarantined"] == 1 and report["ledger_events"] == 8
    assert jobs.quarantine(spark, root).count() == 1
    stale = write(tmp_path / "stale", [example()[5]])
    run(spark, stale, root)
    assert transactions(spark, root).filter("transaction_id = 5999").isEmpty()
    # A higher sequence brings the record back.
    newer = transaction(9, 5999, 1001, "repayment", "1234567890.12", "U")
    run(spark, write(tmp_path / "newer", [newer]), root, scope="touched")
    row = transactions(spark, root).filter("transaction_id = 5999").first()
    assert row["amount"] == Decimal("1234567890.12") and row["event_sequence"] == 9


def test_conflicts_stop_the_run(spark, tmp_path):
    root = str(tmp_path / "lake")
    run(spark, write(tmp_path / "raw", example()), root)
    rewritten = transaction(6, 5999, 1001, "repayment", "999.00")
    other_id = transaction(6, 5999, 1001, "repayment", "999.00", event_id="00000000-0000-0000-0000-0000000000ff")
    for name, bad in (("rewritten", rewritten), ("same sequence", other_id)):
        for scope in ("history", "touched"):
            with pytest.raises(cdc.ConflictError):
                run(spark, write(tmp_path / f"{name}{scope}", [bad]), root, scope=scope)
    assert jobs.ledger(spark, root).count() == 8


def test_crash_is_repaired_and_late_key_is_taken(spark, tmp_path):
    root = str(tmp_path / "lake")
    events = example()
    for item in events:
        item["event_sequence"] = str(int(item["event_sequence"]) * 10)
    raw = write(tmp_path / "raw", events)

    def crash(*_):
        raise RuntimeError("injected")

    with patch.object(change_lake, "_merge_state", crash), pytest.raises(RuntimeError, match="injected"):
        run(spark, raw, root)
    assert jobs.ledger(spark, root).count() == 8 and jobs.state(spark, root, "loans").isEmpty()
    assert run(spark, raw, root)["current_transactions"] == 3
    late = loan(5, 1003, "10.00", event_id="00000000-0000-0000-0000-0000000000aa")
    assert run(spark, write(tmp_path / "late", [late]), root)["current_loans"] == 3
    assert jobs.loan_portfolio(spark, root).filter("loan_id = 1003").first()["transaction_count"] == 0


@pytest.mark.parametrize("stop", ["append_batch", "one state", "_write_totals"])
def test_a_stopped_batch_is_finished_by_a_disjoint_one(spark, tmp_path, stop):
    """Wherever a batch stops, the next run, with other records, leaves all tables as one batch would."""
    whole, root = str(tmp_path / "whole"), str(tmp_path / "lake")
    first = example()
    second = [loan(20, 1003, "5.00"), transaction(21, 7001, 1003, "repayment", "2.00")]
    run(spark, write(tmp_path / "all", [*first, *second]), whole)
    calls, merge = [], change_lake._merge_state

    def crash(*args, **more):
        calls.append(args)
        if stop == "one state" and len(calls) == 1:
            return merge(*args, **more)
        raise RuntimeError("injected")

    with patch.object(change_lake, "_merge_state" if stop == "one state" else stop, crash), pytest.raises(RuntimeError, match="injected"):
        run(spark, write(tmp_path / "first", first), root)
    assert len(change_lake.ChangeLake(spark, root).open_batches()) == 1
    report = run(spark, write(tmp_path / "second", second), root)
    assert report["ledger_events"] == 10 and change_lake.ChangeLake(spark, root).open_batches() == []
    for table in ("loans", "loan_transactions"):
        assert rows(jobs.state(spark, root, table)) == rows(jobs.state(spark, whole, table))
    assert rows(jobs.loan_portfolio(spark, root)) == rows(jobs.loan_portfolio(spark, whole))
    assert rows(jobs.ledger(spark, root).drop("event_json")) == rows(jobs.ledger(spark, whole).drop("event_json"))
    assert change_lake.ChangeLake(spark, root).index().count() == 10


def test_batches_touch_their_buckets_only(spark, tmp_path):
    root = str(tmp_path / "lake")
    run(spark, write(tmp_path / "many", [loan(n, 1000 + n, "5.00") for n in range(1, 60)]), root, buckets=16)
    lake = change_lake.ChangeLake(spark, root)
    before = dict(lake.states["loans"].at)
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "lake").rglob("*.parquet")}
    report = run(spark, write(tmp_path / "next", [loan(100, 1007, "6.00", "U"), transaction(101, 1, 1007, "repayment", "1.00")]), root)
    assert report["current_loans"] == 59 and report["ledger_events"] == 61
    after = change_lake.ChangeLake(spark, root)
    assert after.buckets == 16
    assert sum(after.states["loans"].at[b] != before[b] for b in before) == 1
    assert sum(len(t.at) for t in (after.totals, after.states["loan_transactions"])) == 2
    # No file of before was rewritten, and the gate's plan opens the partitions of the batch alone.
    assert all(p.stat().st_mtime_ns == t for p, t in stamps.items())
    plan = after.ledger({"loans": [3]})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    some = next(iter(before))
    rows_read = after.states["loans"].read([some])
    assert {f"bucket={some}" in name for name in rows_read.inputFiles()} == {True}


def test_counts_equal_the_tables(spark, tmp_path):
    """Counts kept beside the pointers follow inserts, moves between loans, deletes and orphans."""
    root = str(tmp_path / "lake")
    steps = [
        [*example(), transaction(9, 6000, 4242, "repayment", "1.00")],
        [transaction(10, 5003, 1002, "repayment", "100.00", "U"), loan(11, 1001, "1000.00", "D")],
        [loan(12, 4242, "9.00"), transaction(13, 5001, 1001, "disbursement", "1000.00", "D")],
    ]
    for n, step in enumerate(steps):
        report = run(spark, write(tmp_path / f"step{n}", step), root)
        loans, moves = (cdc.current(jobs.state(spark, root, t)) for t in ("loans", "loan_transactions"))
        assert report["current_loans"] == loans.count() and report["current_transactions"] == moves.count()
        assert report["orphan_transactions"] == cdc.orphan_count(moves, loans).first()[0]
        assert report["ledger_events"] == jobs.ledger(spark, root).count()
        assert rows(jobs.loan_portfolio(spark, root)) == rows(cdc.portfolio(loans, moves))
    run(spark, write(tmp_path / "none", ["{broken"]), root, scope="history")
    assert rows(jobs.loan_portfolio(spark, root)) == rows(cdc.portfolio(loans, moves))


def test_orphans_are_reported(spark, tmp_path):
    raw = write(tmp_path / "raw", [*example(), transaction(9, 6000, 4242, "repayment", "1.00")])
    report = run(spark, raw, str(tmp_path / "lake"))
    assert report["orphan_transactions"] == 1 and report["current_transactions"] == 4


def rows(frame):
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


def test_stream_equals_batch(spark, tmp_path):
    extra = [transaction(9, 6000, 1002, "repayment", "1.00"), "{broken", loan(10, 1002, "2000.00", "D")]
    raw = write(tmp_path / "raw", [*example(), *extra])
    batch, live = str(tmp_path / "batch"), str(tmp_path / "live")
    run(spark, raw, batch)
    stream_cdc(spark, raw, live, str(tmp_path / "progress"), files_per_batch=4).awaitTermination()
    write(tmp_path / "raw", [loan(11, 1004, "5.00")])
    run(spark, raw, batch)
    stream_cdc(spark, raw, live, str(tmp_path / "progress"), files_per_batch=4).awaitTermination()
    for table in ("loans", "loan_transactions"):
        assert rows(jobs.state(spark, live, table)) == rows(jobs.state(spark, batch, table))
    assert rows(jobs.ledger(spark, live)) == rows(jobs.ledger(spark, batch))
    assert rows(jobs.loan_portfolio(spark, live)) == rows(jobs.loan_portfolio(spark, batch))
    assert jobs.quarantine(spark, live).count() == jobs.quarantine(spark, batch).count() == 1


def lines(folder, events):
    return write(folder, events, indent=None)


def test_refresh_validates_applies_and_refuses(spark, tmp_path):
    root, raw = str(tmp_path / "lake"), lines(tmp_path / "raw", example())
    expected = {
        "ledger_events": 8, "current_loans": 2, "current_transactions": 3, "transaction_tombstones": 1,
        "orphan_transactions": 0, "portfolio_loans": 2, "portfolio_transactions": 3,
    }
    dry = jobs.cdc_refresh(spark, raw, root)
    assert dry["status"] == "validated" and dry["new_events"] == 8 and dry["expected"] == expected
    assert jobs.ledger(spark, root).isEmpty()
    done = jobs.cdc_refresh(spark, raw, root, apply=True)
    assert done["status"] == "refreshed" and done["actual"] == expected
    again = jobs.cdc_refresh(spark, raw, root, apply=True)
    assert again["new_events"] == 0 and again["actual"] == expected
    bad = {
        "bytes": [json.dumps(example()[0]) + " "],
        "sequence": [loan(1, 1009, "1.00", event_id="00000000-0000-0000-0000-0000000000bb")],
        "orphan": [transaction(20, 6000, 4242, "repayment", "1.00")],
        "invalid": ["{broken"],
    }
    for name, events in bad.items():
        with pytest.raises(jobs.RefreshError):
            jobs.cdc_refresh(spark, lines(tmp_path / name, events), root, apply=True)
    assert jobs.ledger(spark, root).count() == 8
    # One ledger for both jobs: what the one took is known to the other.
    more = run(spark, write(tmp_path / "more", [*example(), loan(30, 1005, "7.00")]), root)
    assert more["ledger_events"] == 9 and more["current_loans"] == 3
    after = jobs.cdc_refresh(spark, raw, root, apply=True)
    assert after["new_events"] == 0 and after["actual"]["ledger_events"] == 9


def test_latest_event_is_limited_before_the_shuffle(spark):
    ledger = spark.createDataFrame([], "source_system string, source_table string, record_id bigint, event_sequence bigint")
    plan = cdc.latest_events(ledger, "loans")._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 1


def test_merge_keeps_stale_and_inserts_tombstones(spark):
    from tablemart.operators.merge import merge_newer

    stored = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, 5, "c")], "k int, s int, v string")
    incoming = spark.createDataFrame([(1, 6, "x"), (2, 5, "y"), (3, 4, "z"), (4, 1, "w")], "k int, s int, v string")
    merged = merge_newer(stored, incoming, ["k"], "s")
    assert sorted(map(tuple, merged.select("k", "s", "v").collect())) == [
        (1, 6, "x"), (2, 5, "b"), (3, 5, "c"), (4, 1, "w"),
    ]


def test_upsert_keeps_unchanged_rows(spark):
    from tablemart.operators.merge import upsert_changed

    stored = spark.createDataFrame([("a", "1", "old"), ("b", None, "old")], "k string, p string, at string")
    incoming = spark.createDataFrame([("a", "1", "new"), ("b", "2", "new"), ("c", None, "new")], "k string, p string, at string")
    got = {r["k"]: r["at"] for r in upsert_changed(stored, incoming, ["k"], ["p"]).collect()}
    assert got == {"a": "old", "b": "new", "c": "new"}


def test_numbering_is_consecutive_over_partitions(spark):
    from tablemart.operators.ranking import number_rows

    frame = spark.range(0, 5000, 1, 7).withColumn("k", F.pmod(F.hash("id"), F.lit(100_000)))
    numbered = number_rows(frame, ["k", "id"], "n", 10)
    rows = numbered.orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(10, 5010))
    assert [(r["k"], r["id"]) for r in rows] == sorted((r["k"], r["id"]) for r in rows)


def test_rows_of_a_batch_are_written_down_once_each(spark, tmp_path):
    """Known events and second deliveries are left out; hashes and ids do not take the room that snappy leaves them."""
    root = str(tmp_path / "lake")
    first = read_documents(spark, write(tmp_path / "raw", example()))
    jobs.cdc_lake(spark, first.limit(2), root)
    report, batch = change_lake.admit_batch(spark, first.unionByName(first), root)
    assert report["input"] == 2 * first.count() and batch["rows"] == first.count() - 2
    lake = change_lake.ChangeLake(spark, root)
    assert change_lake.written_down(lake, batch).select("event_id").distinct().count() == batch["rows"]
    assert all(".zstd." in name for name in change_lake.written_down(lake, batch).inputFiles())
