"""The change-data jobs: events into a bucketed ledger, latest states, loan totals and the portfolio.

Every table is dealt over buckets of its key; a batch reads and rewrites the buckets it touches. A batch is
first written down whole (its rows, then one small `open` file); then it goes into ledger, event
index, states, totals and portfolio; the `done` file comes last. What stopped in between is finished by
the next run from the rows written down, whatever that run itself brings.

Below the root: event_ledger (by table and bucket of the record), event_index (by bucket of the event
id), loans_state and loan_transactions_state, loan_totals and loan_portfolio (bucket tables), quarantine,
_batches. One writer at a time: two of them meet at the `open` file or at a pointer, and one is refused.
"""

import json
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablemart.contracts import (
    CDC_TABLES,
    DEFAULT_SOURCE,
    EVENT_INDEX,
    LEDGER,
    LOAN_TOTALS,
    QUARANTINE,
    portfolio_schema,
    state_schema,
)
from tablemart.operators.grain import duplicate_keys
from tablemart.operators.merge import absent_rows, merge_newer
from tablemart.plans import cdc
from tablemart.plans.event_decode import decode_events
from tablemart.sinks.buckets import BucketTable, bucket_of
from tablemart.sinks.snapshots import PublishConflict
from tablemart.sinks.tables import write_partitioned
from tablemart.sources.files import read_lines
from tablemart.storage import BETWEEN, create_once, names_in, read_text, remove, via_table

#: Buckets of a new lake; a lake keeps the number it began with. About one per 256 MB of state.
BUCKETS = 16


def new_run_id():
    return "run_" + uuid4().hex


def _stored(spark, path, schema):
    """An append-only Parquet table, empty before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class ChangeLake:
    """The tables below a root, as they are selected when this object is made. With `buckets`, a lake
    that does not exist yet begins with so many."""

    def __init__(self, spark, root, buckets=None):
        self.spark, self.root = spark, root
        if buckets:
            create_once(spark, f"{root}/_layout.json", json.dumps({"buckets": buckets}))
        begun = "_layout.json" in names_in(spark, root)
        self.buckets = json.loads(read_text(spark, f"{root}/_layout.json"))["buckets"] if begun else BUCKETS
        self.states = {t: BucketTable(spark, f"{root}/{t}_state", state_schema(t)) for t in CDC_TABLES}
        self.totals = BucketTable(spark, f"{root}/loan_totals", LOAN_TOTALS)
        self.portfolio = BucketTable(spark, f"{root}/loan_portfolio", portfolio_schema())

    # Where rows are.

    def record_bucket(self, source="source_system", record="record_id"):
        return bucket_of([F.col(source), F.col(record)], self.buckets)

    def event_bucket(self):
        return bucket_of([F.col("source_system"), F.col("event_id")], self.buckets)

    def ledger(self, touched=None):
        """The ledger with its buckets; with `touched` ({table: buckets}) those alone are listed and read."""
        rows = _stored(self.spark, f"{self.root}/event_ledger", f"{LEDGER}, bucket int")
        if touched is None:
            return rows
        own = F.lit(False)
        for table, buckets in touched.items():
            own = own | (F.col("source_table") == table) & F.col("bucket").isin(list(buckets))
        return rows.filter(own)

    def index(self, buckets=None):
        rows = _stored(self.spark, f"{self.root}/event_index", f"{EVENT_INDEX}, bucket int")
        return rows if buckets is None else rows.filter(F.col("bucket").isin(list(buckets)))

    # The log of batches.

    def _log(self):
        return names_in(self.spark, f"{self.root}/_batches")

    def open_batches(self):
        """Batches that were written down and not finished, oldest first."""
        names = self._log()
        done = {n.split(".")[0] for n in names if n.endswith(".done")}
        return [
            json.loads(read_text(self.spark, f"{self.root}/_batches/{n}"))
            for n in names if n.endswith(".open") and n.split(".")[0] not in done
        ]

    def last_done(self):
        done = [n for n in self._log() if n.endswith(".done")]
        return json.loads(read_text(self.spark, f"{self.root}/_batches/{done[-1]}")) if done else None

    def write_down(self, rows, run_id, touched):
        """Store new ledger rows and open their batch; None without rows."""
        folder = f"{self.root}/_batches/rows-{run_id}"
        rows = rows.select(*StructType.fromDDL(LEDGER).names)
        rows.write.mode("errorifexists").option("compression", BETWEEN).parquet(folder)
        count = self.spark.read.schema(LEDGER).parquet(folder).count()
        if not count:
            remove(self.spark, folder)
            return None
        number = max([int(n.split(".")[0]) for n in self._log() if n.endswith((".open", ".done"))], default=0) + 1
        batch = {"number": number, "run_id": run_id, "rows": count, "touched": touched}
        if not create_once(self.spark, f"{self.root}/_batches/{number:012d}.open", json.dumps(batch)):
            raise PublishConflict(f"batch {number} below {self.root} was opened by another writer")
        return batch

    def close(self, batch, report):
        """The `done` file; what the batch wrote down and the files of the batch before are not needed any more."""
        place = f"{self.root}/_batches"
        create_once(self.spark, f"{place}/{batch['number']:012d}.done", json.dumps(report))
        remove(self.spark, f"{place}/rows-{batch['run_id']}")
        remove(self.spark, f"{place}/{batch['number']:012d}.open")
        remove(self.spark, f"{place}/{batch['number'] - 1:012d}.done")

    def counts(self):
        """Totals of all tables, from pointers and the log alone."""
        done = self.last_done()
        return {
            "ledger_events": done["ledger_events"] if done else 0,
            "current_loans": self.states["loans"].total("current"),
            "current_transactions": self.states["loan_transactions"].total("current"),
            "orphan_transactions": self.totals.total("orphans"),
        }


# --- reading ----------------------------------------------------------------------------


def ledger(spark, root):
    return ChangeLake(spark, root).ledger().select(*StructType.fromDDL(LEDGER).names)


def quarantine(spark, root):
    return _stored(spark, f"{root}/quarantine", QUARANTINE)


def state(spark, root, table):
    return ChangeLake(spark, root).states[table].read().drop("bucket")


def loan_portfolio(spark, root):
    return ChangeLake(spark, root).portfolio.read().drop("bucket")


def _together(*steps):
    """Run steps that write different tables at the same time; all end before the first error is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(s) for s in steps]]


# --- one batch --------------------------------------------------------------------------


def admit_batch(spark, raw, root, source=DEFAULT_SOURCE, run_id=None, buckets=BUCKETS):
    """Decode, quarantine, gate and write down one batch: (report so far, batch or None).

    The gate reads the event index in the buckets of the batch's event ids and the ledger in those of its
    records; of both only rows that share an id or a record with the batch are compared. A ledger
    grows by gated batches alone, so no other row can take part in a new conflict.
    """
    lake, run_id = ChangeLake(spark, root, buckets), run_id or new_run_id()
    decoded = via_table(decode_events(raw, source), "decoded")
    valid = F.col("error").isNull()
    # Three counts and bucket numbers, of which there are as many as buckets; invalid rows have no key.
    found = decoded.agg(
        F.count("*").alias("input"), F.count_if(~valid).alias("invalid"), F.count_distinct(*cdc.EVENT_KEY).alias("unique"),
        F.collect_set(F.when(valid, F.struct("source_table", lake.record_bucket().alias("b")))).alias("records"),
        F.collect_set(F.when(valid, lake.event_bucket())).alias("events"),
    ).first()
    report = {"input": found["input"], "quarantined": found["invalid"], "valid_unique": found["unique"]}
    if found["invalid"]:
        fresh = absent_rows(quarantine(spark, root), cdc.rejected_rows(decoded), ["rejection_id"])
        fresh.write.mode("append").parquet(f"{root}/quarantine")
    events = cdc.valid_events(decoded, "value")
    if not found["unique"]:
        return report, None
    touched = {t: sorted(r["b"] for r in found["records"] if r["source_table"] == t) for t in CDC_TABLES}
    keys = events.select(*cdc.EVENT_KEY)
    # Few events are known or come twice, so both sets are stored: small ones are sent to the rows of the
    # batch, which then stay where they are.
    index = lake.index(found["events"])
    known = index.select(*cdc.EVENT_KEY).join(keys, cdc.EVENT_KEY, "left_semi")
    known = via_table(index.join(via_table(known, "known"), cdc.EVENT_KEY, "left_semi").drop("bucket"), "index")
    history = lake.ledger(touched).join(events.select(*cdc.RECORD_KEY).distinct(), cdc.RECORD_KEY, "left_semi")
    cdc.require_consistent(
        cdc.identities(events).unionByName(cdc.event_identities(known)).unionByName(cdc.record_identities(history))
    )
    fresh = events.join(known.select(*cdc.EVENT_KEY), cdc.EVENT_KEY, "left_anti")
    if found["invalid"] + found["unique"] < found["input"]:
        twice = via_table(duplicate_keys(keys, cdc.EVENT_KEY).drop("occurrences"), "twice")
        copies = cdc.one_per_event(fresh.join(twice, cdc.EVENT_KEY, "left_semi"))
        fresh = fresh.join(twice, cdc.EVENT_KEY, "left_anti").unionByName(copies)
    return report, lake.write_down(fresh, run_id, touched)


def written_down(lake, batch):
    """The rows of a batch as they were written down."""
    return lake.spark.read.schema(LEDGER).parquet(f"{lake.root}/_batches/rows-{batch['run_id']}")


def append_batch(lake, rows, batch, again=False):
    """The rows into ledger and index; `again`: those that are not there yet."""
    placed = rows.withColumn("bucket", lake.record_bucket())
    index = rows.select("source_system", "event_id", "event_hash", lake.event_bucket().alias("bucket"))
    if again:
        placed = absent_rows(lake.ledger(batch["touched"]), placed, cdc.EVENT_KEY)
        index = absent_rows(lake.index(), index, cdc.EVENT_KEY)
    _together(
        lambda: write_partitioned(placed, f"{lake.root}/event_ledger", ["source_table", "bucket"], mode="append"),
        lambda: write_partitioned(index, f"{lake.root}/event_index", ["bucket"], mode="append"),
    )


def _merge_state(lake, table, incoming, run_id, buckets):
    """Merge the latest rows of a batch into the buckets it touches: state rows before and after, of
    the records that changed."""
    key = ["source_system", CDC_TABLES[table].key]
    stored, target = lake.states[table].read(buckets), lake.states[table]
    newer = incoming.join(stored.select(*key, F.col(cdc.SEQUENCE).alias("_had")), key, "left")
    newer = newer.filter(F.col("_had").isNull() | (F.col(cdc.SEQUENCE) > F.col("_had"))).drop("_had")
    before = stored.join(newer.select(*key), key, "left_semi")
    if buckets:
        merged = merge_newer(stored, incoming, [*key, "bucket"], cdc.SEQUENCE)
        target.replace(merged, run_id, buckets, current=F.count_if(~F.col("is_deleted")))
    return before, newer


def _write_totals(lake, totals, run_id, buckets):
    """Totals and portfolio of some loan buckets; orphans are the transactions of totals without a
    current loan."""
    loans = cdc.current(lake.states["loans"].read(buckets))
    totals = totals.join(loans.select(*cdc.LOAN_KEY, F.lit(True).alias("_has_loan")), cdc.LOAN_KEY, "left")
    totals = via_table(totals.withColumn("orphan", F.coalesce(~F.col("_has_loan"), F.lit(True))), "totals")
    kept = totals.filter("transaction_count <> 0")
    orphans = {
        r["bucket"]: r["n"]
        for r in kept.filter("orphan").groupBy("bucket").agg(F.sum("transaction_count").alias("n")).collect()
    }
    _together(
        lambda: lake.totals.replace(kept, run_id, buckets, orphans=_by_bucket(orphans)),
        lambda: lake.portfolio.replace(cdc.portfolio_from_totals(loans, kept), run_id, buckets),
    )


def _by_bucket(numbers):
    """A number per bucket as an aggregate over the rows of that bucket."""
    found = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair]) if numbers else None
    return F.max(F.coalesce(F.try_element_at(found, F.col("bucket")), F.lit(0)) if numbers else F.lit(0))


def finish_batch(spark, root, batch, again=False):
    """Carry a batch that was written down through all tables and close it.

    In one go, totals change by what the batch changed in the transactions. `again` (the batch was
    stopped somewhere): ledger and index take what is missing, merges of states repeat without effect,
    and all totals are summed anew from the states.
    """
    lake, run_id = ChangeLake(spark, root), new_run_id()
    rows = written_down(lake, batch)

    def merge(table):
        latest = cdc.fold(rows, table).withColumn("bucket", lake.record_bucket(record=CDC_TABLES[table].key))
        return _merge_state(lake, table, via_table(latest, "fold"), run_id, batch["touched"][table])

    _, *merged = _together(lambda: append_batch(lake, rows, batch, again), *[partial(merge, table) for table in CDC_TABLES])
    changed = dict(zip(CDC_TABLES, merged))
    loan_bucket = lake.record_bucket(record="loan_id")
    if again:
        current = cdc.current(lake.states["loan_transactions"].read().drop("bucket"))
        totals = cdc.transaction_totals(current).withColumn("bucket", loan_bucket)
        buckets = list(range(lake.buckets))
    else:
        changes = cdc.transaction_changes(*changed["loan_transactions"]).withColumn("bucket", loan_bucket)
        changes = via_table(changes, "changes")
        touched = {r[0] for r in changes.select("bucket").distinct().collect()}
        buckets = sorted(touched.union(batch["touched"]["loans"]))
        both = lake.totals.read(buckets).unionByName(changes)
        totals = both.groupBy(*cdc.LOAN_KEY, "bucket").agg(
            F.sum("transaction_count").alias("transaction_count"),
            *[F.sum(n).cast("decimal(22,2)").alias(n) for n in ("repaid_amount", "disbursed_amount")],
        )
    _write_totals(lake, totals, run_id, buckets)
    done = lake.last_done()
    events = lake.ledger().count() if again or not done else done["ledger_events"] + batch["rows"]
    lake.close(batch, {"number": batch["number"], "run_id": batch["run_id"], "ledger_events": events})


def recover(spark, root):
    """Finish the batches that stopped; returns how many there were."""
    stopped = ChangeLake(spark, root).open_batches()
    for batch in stopped:
        finish_batch(spark, root, batch, again=True)
    return len(stopped)


def rebuild(spark, root):
    """Fold the whole ledger again into states, totals and portfolio."""
    lake, run_id = ChangeLake(spark, root), new_run_id()
    every = list(range(lake.buckets))
    for table in CDC_TABLES:
        folded = cdc.fold(lake.ledger(), table)
        folded = folded.withColumn("bucket", lake.record_bucket(record=CDC_TABLES[table].key))
        lake.states[table].replace(folded, run_id, every, current=F.count_if(~F.col("is_deleted")))
    current = cdc.current(lake.states["loan_transactions"].read().drop("bucket"))
    totals = cdc.transaction_totals(current).withColumn("bucket", lake.record_bucket(record="loan_id"))
    _write_totals(lake, totals, run_id, every)


def cdc_lake(spark, raw, root, source=DEFAULT_SOURCE, scope="touched", run_id=None, buckets=BUCKETS):
    """One batch of raw documents (value, source_file) into ledger, states and portfolio.

    Invalid documents go to the quarantine and the rest continues. A batch that an earlier run left
    open is finished first. `scope="touched"` works on the buckets of the batch; `scope="history"`
    folds the whole ledger anew afterwards.
    """
    recover(spark, root)
    report, batch = admit_batch(spark, raw, root, source, run_id, buckets)
    if batch:
        finish_batch(spark, root, batch)
    if scope == "history":
        rebuild(spark, root)
    return {**report, **ChangeLake(spark, root).counts()}


# --- fail-fast --------------------------------------------------------------------------


class RefreshError(ValueError):
    """The fail-fast refresh refused its input."""


def refresh_input(spark, raw, known):
    """Raw lines and ledger rows as one input of the decode, with the stored columns of the latter."""
    stored = F.struct(*cdc.LEDGER_COLUMNS)
    return known.select("event_json", F.lit(True).alias("in_ledger"), stored.alias("stored")).unionByName(
        raw.select("event_json", F.lit(False).alias("in_ledger"), F.lit(None).cast(known.select(stored).schema[0].dataType).alias("stored"))
    )


def cdc_refresh(spark, path, root, source=DEFAULT_SOURCE, apply=False, run_id=None, buckets=BUCKETS):
    """Fail-fast refresh from line-per-event files, into the same tables as cdc_lake.

    Any invalid event, conflict or orphan, in the files or in the ledger, stops the run before the
    first write. Without `apply` it only validates. All of the ledger is read, as all of it is checked.
    """
    raw, known = read_lines(spark, path), ledger(spark, root)
    decoded = via_table(decode_events(refresh_input(spark, raw, known), source, "event_json"), "refresh")
    refused = cdc.refusals(decoded).orderBy("place", F.desc("in_ledger"), "reason", "subject").limit(1).collect()
    if refused:
        bad = refused[0]
        where = {True: "ledger: ", False: "raw: "}.get(bad["in_ledger"], "")
        raise RefreshError(f"{where}{bad['reason']}" + (f" ({bad['subject']})" if bad["subject"] else ""))
    events = via_table(cdc.one_per_event(cdc.valid_events(decoded, "event_json")), "history")
    expected = cdc.expected_counts(events).first().asDict()
    if not expected["ledger_events"]:
        raise RefreshError("neither raw rows nor ledger rows")
    if expected["orphan_transactions"]:
        raise RefreshError("current transactions without a current loan")
    additions = via_table(absent_rows(known, events, cdc.EVENT_KEY), "additions")
    report = {
        "status": "validated", "raw_rows": decoded.filter("NOT in_ledger").count(), "new_events": additions.count(),
        "expected": expected,
    }
    if not apply:
        return report
    recover(spark, root)
    lake = ChangeLake(spark, root, buckets)
    touched = {t: [] for t in CDC_TABLES}
    for r in additions.select("source_table", lake.record_bucket().alias("b")).distinct().collect():
        touched[r["source_table"]].append(r["b"])
    batch = lake.write_down(additions, run_id or new_run_id(), touched)
    if batch:
        finish_batch(spark, root, batch)
    lake = ChangeLake(spark, root)
    states = {t: lake.states[t].read() for t in CDC_TABLES}
    actual = cdc.reconcile(lake.ledger(), states["loans"], states["loan_transactions"], lake.portfolio.read()).first().asDict()
    if actual != expected:
        raise RefreshError(f"tables do not reconcile: {actual} instead of {expected}")
    return {**report, "status": "refreshed", "actual": actual}
