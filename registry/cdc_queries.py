"""Change-data queries: decoding, conflicts, folding, portfolio, outbox."""

from pyspark.sql import functions as F

from registry.inputs import change_event_text, load, plain
from tablemart import outbox_store
from tablemart.contracts import DEFAULT_SOURCE
from tablemart.operators import grain, latest, merge
from tablemart.plans import cdc, outbox
from tablemart.plans.event_decode import decode_events
from tablemart.storage import shared_folder, via_table

QUERIES, ORACLES = {}, {}


def query(sql):
    """Register a function under its own name, with its SQL twin."""

    def register(function):
        QUERIES[function.__name__] = lambda spark, folder: plain(function(spark, folder))
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


EVENTS = """
base AS (
  SELECT *, event_id % 3 = 0 AS is_loan, user_id * 10 + event_id % 10 AS transaction_id,
    CAST(CAST(value + 1 AS DECIMAL(12,2)) AS VARCHAR) AS amount,
    regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0*$', '') || '+00:00' AS stamp,
    CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS operation,
    regexp_replace(md5(CAST(event_id AS VARCHAR)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS uuid
  FROM events),
decoded AS (
  SELECT event_id AS number, user_id, value, is_loan, ts, uuid AS event_id, number + 1 AS event_sequence,
    'lending-postgres-dev' AS source_system,
    CASE WHEN is_loan THEN 'loans' ELSE 'loan_transactions' END AS source_table,
    CASE WHEN is_loan THEN user_id ELSE transaction_id END AS record_id, operation, stamp AS captured_at,
    amount,
    CASE WHEN is_loan THEN '{"created_at":"' || stamp || '","currency":"GBP","loan_id":' || user_id
        || ',"principal_amount":"' || amount || '","status":"' || CASE WHEN number % 2 = 0 THEN 'active' ELSE 'closed' END
        || '","updated_at":"' || stamp || '"}'
      ELSE '{"amount":"' || amount || '","loan_id":' || user_id || ',"occurred_at":"' || stamp
        || '","transaction_id":' || transaction_id || ',"transaction_type":"'
        || CASE WHEN number % 2 = 0 THEN 'repayment' ELSE 'disbursement' END || '","updated_at":"' || stamp || '"}' END AS payload_json
  FROM (SELECT *, event_id AS number FROM base))
"""
ERRORS = EVENTS + """,
judged AS (
  SELECT *, CASE WHEN number % 17 = 0 OR number % 41 = 0 THEN 'invalid JSON'
    WHEN number % 19 = 0 THEN 'unsupported schema_version'
    WHEN number % 47 = 0 THEN 'badly formed hexadecimal UUID string'
    WHEN number % 43 = 0 THEN 'event_sequence must be positive'
    WHEN number % 23 = 0 THEN 'unsupported operation'
    WHEN number % 29 = 0 THEN 'timestamp must be a timezone-aware string'
    WHEN number % 53 = 0 THEN 'record_data fields do not match contract'
    WHEN number % 31 = 0 AND is_loan THEN 'principal_amount exceeds decimal(12,2)'
    WHEN number % 31 = 0 THEN 'amount exceeds decimal(12,2)'
    WHEN number % 37 = 0 THEN 'record_key does not match record_data' END AS error
  FROM decoded)
"""
LATEST = EVENTS + """,
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_table, record_id ORDER BY event_sequence DESC) AS place
    FROM decoded) WHERE place = 1),
loans AS (SELECT record_id AS loan_id, CAST(amount AS DECIMAL(12,2)) AS principal_amount, 'GBP' AS currency,
    CASE WHEN number % 2 = 0 THEN 'active' ELSE 'closed' END AS status, event_sequence, operation = 'D' AS is_deleted
  FROM latest WHERE source_table = 'loans'),
transactions AS (SELECT record_id AS transaction_id, user_id AS loan_id,
    CASE WHEN number % 2 = 0 THEN 'repayment' ELSE 'disbursement' END AS transaction_type,
    CAST(amount AS DECIMAL(12,2)) AS amount, event_sequence, operation = 'D' AS is_deleted
  FROM latest WHERE source_table = 'loan_transactions')
"""


def _decoded(spark, folder, faults=False):
    return decode_events(change_event_text(spark, folder, faults))


def _ledger(spark, folder):
    return cdc.valid_events(_decoded(spark, folder))


def _stored_ledger(spark, folder):
    """The ledger as a stored table, for queries that read it more than once."""
    return via_table(_ledger(spark, folder), "ledger")


# --- decoding ---------------------------------------------------------------------------


@query(f"""WITH {ERRORS} SELECT event_id, event_sequence, source_table, record_id, operation, captured_at, payload_json,
  sha256(to_json([source_system, event_id, CAST(event_sequence AS VARCHAR), source_table, operation, captured_at, payload_json])::VARCHAR) AS event_hash
  FROM judged WHERE error IS NULL""")
def cdc_decode(spark, folder):
    return _decoded(spark, folder, faults=True).filter(F.col("error").isNull()).select(
        "event_id", "event_sequence", "source_table", "record_id", "operation", "captured_at",
        "payload_json", "event_hash",
    )


@query(f"WITH {ERRORS} SELECT 'events/' || number AS source_file, error AS reason FROM judged WHERE error IS NOT NULL")
def cdc_quarantine(spark, folder):
    return cdc.rejected_rows(_decoded(spark, folder, faults=True)).select("source_file", "reason")


@query(f"WITH {ERRORS} SELECT count(*) AS input, count(error) AS invalid FROM judged")
def cdc_counts(spark, folder):
    return cdc.input_counts(_decoded(spark, folder, faults=True))


def _with_copies(events):
    """Every fifth event is delivered twice; every hundredth again with other content."""
    number = F.col(cdc.SEQUENCE) - 1
    again = events.filter(number % 5 == 0)
    other = events.filter(number % 100 == 0).withColumn("event_hash", F.sha2("event_hash", 256))
    return events.unionByName(again).unionByName(other)


@query(f"WITH {EVENTS} SELECT event_id, event_sequence, operation FROM decoded")
def cdc_dedupe(spark, folder):
    events = _stored_ledger(spark, folder)
    copies = events.unionByName(events.filter((F.col(cdc.SEQUENCE) - 1) % 5 == 0))
    return cdc.one_per_event(copies).select("event_id", "event_sequence", "operation")


@query(f"""WITH {EVENTS} SELECT 'event' AS conflict, event_id AS subject FROM decoded WHERE number % 100 = 0
  UNION ALL SELECT 'sequence', source_table || '/' || record_id FROM decoded WHERE number % 100 = 0""")
def cdc_conflicts(spark, folder):
    return cdc.content_conflicts(_with_copies(_stored_ledger(spark, folder))).select("conflict", "subject")


@query(f"""WITH {EVENTS}, moved AS (
    SELECT event_id, CASE WHEN number % 200 = 1 THEN event_sequence + 1 ELSE event_sequence END AS event_sequence, payload_json AS body FROM decoded
    UNION ALL SELECT event_id, event_sequence, payload_json || ' ' FROM decoded WHERE number % 300 = 0)
  SELECT 'event id with different bytes' AS conflict, event_id AS subject FROM moved GROUP BY event_id HAVING count(DISTINCT body) > 1
  UNION ALL SELECT 'source sequence used twice', CAST(event_sequence AS VARCHAR) FROM moved GROUP BY event_sequence HAVING count(DISTINCT event_id) > 1""")
def cdc_raw_conflicts(spark, folder):
    """The fail-fast gate: changed bytes for one event id, one sequence for two events."""
    events = _stored_ledger(spark, folder).select(
        "source_system", "event_id", cdc.SEQUENCE, F.col("payload_json").alias("event_json")
    )
    number = F.col(cdc.SEQUENCE) - 1
    moved = events.withColumn(cdc.SEQUENCE, F.when(number % 200 == 1, number + 2).otherwise(number + 1))
    changed = events.filter(number % 300 == 0).withColumn("event_json", F.concat("event_json", F.lit(" ")))
    return cdc.raw_conflicts(moved.unionByName(changed)).select("conflict", "subject")


@query(f"""WITH {EVENTS} SELECT event_id, CASE WHEN number % 4 = 0 THEN 'new' WHEN number % 50 = 1 THEN 'conflict' ELSE 'same' END AS outcome
  FROM decoded""")
def ledger_compare(spark, folder):
    events = _ledger(spark, folder)
    number = F.col(cdc.SEQUENCE) - 1
    changed = F.when(number % 50 == 1, F.lit("other")).otherwise(F.col("event_hash"))
    ledger = events.filter(number % 4 != 0).withColumn("event_hash", changed)
    return cdc.compare_with_ledger(events, ledger).select("event_id", "outcome")


# --- state ------------------------------------------------------------------------------


@query(f"""WITH {LATEST} SELECT loan_id, CAST(principal_amount AS DOUBLE) AS principal_amount, currency, status, event_sequence,
  is_deleted FROM loans""")
def cdc_state(spark, folder):
    state = cdc.fold(_ledger(spark, folder), "loans")
    return state.select("loan_id", "principal_amount", "currency", "status", cdc.SEQUENCE, "is_deleted")


@query(f"""WITH {LATEST} SELECT transaction_id, loan_id, transaction_type, CAST(amount AS DOUBLE) AS amount
  FROM transactions WHERE NOT is_deleted""")
def cdc_current(spark, folder):
    state = cdc.fold(_ledger(spark, folder), "loan_transactions")
    return cdc.business_columns(state, "loan_transactions").select(
        "transaction_id", "loan_id", "transaction_type", "amount"
    )


@query(f"WITH {LATEST} SELECT transaction_id, event_sequence FROM transactions WHERE is_deleted")
def cdc_tombstones(spark, folder):
    state = cdc.fold(_ledger(spark, folder), "loan_transactions")
    return cdc.tombstones(state).select("transaction_id", cdc.SEQUENCE)


@query(f"""WITH {LATEST}, cut AS (SELECT avg(event_sequence) AS middle FROM decoded),
  early AS (SELECT loan_id, event_sequence FROM (SELECT record_id AS loan_id, event_sequence,
      row_number() OVER (PARTITION BY record_id ORDER BY event_sequence DESC) AS place
    FROM decoded, cut WHERE source_table = 'loans' AND event_sequence <= middle) WHERE place = 1)
  SELECT l.loan_id, l.event_sequence, l.is_deleted, CASE WHEN e.loan_id IS NULL THEN 'inserted'
    WHEN l.event_sequence > e.event_sequence THEN 'replaced' ELSE 'kept' END AS outcome
  FROM loans l LEFT JOIN early e USING (loan_id)""")
def cdc_merge_state(spark, folder):
    """State of the first half merged with the fold of the whole ledger."""
    ledger = _stored_ledger(spark, folder)
    middle = ledger.agg(F.avg(cdc.SEQUENCE).alias("middle")).scalar()
    early = cdc.fold(ledger.filter(F.col(cdc.SEQUENCE) <= middle), "loans")
    merged = cdc.merge_state(early, cdc.fold(ledger, "loans"), "loans")
    before = early.select("loan_id", F.col(cdc.SEQUENCE).alias("_old"))
    outcome = (
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.col(cdc.SEQUENCE) > F.col("_old"), "replaced")
        .otherwise("kept")
    )
    return merged.join(before, "loan_id", "left").select(
        "loan_id", cdc.SEQUENCE, "is_deleted", outcome.alias("outcome")
    )


@query(f"""WITH {LATEST} SELECT (SELECT count(*) FROM decoded) AS ledger_events,
  (SELECT count(*) FROM loans WHERE NOT is_deleted) AS current_loans,
  (SELECT count(*) FROM transactions WHERE NOT is_deleted) AS current_transactions,
  (SELECT count(*) FROM transactions WHERE is_deleted) AS transaction_tombstones,
  (SELECT count(*) FROM transactions t WHERE NOT is_deleted AND NOT EXISTS (SELECT 1 FROM loans l WHERE NOT l.is_deleted AND l.loan_id = t.loan_id)) AS orphan_transactions,
  (SELECT count(*) FROM loans WHERE NOT is_deleted) AS portfolio_loans,
  (SELECT count(*) FROM transactions t WHERE NOT is_deleted AND EXISTS (SELECT 1 FROM loans l WHERE NOT l.is_deleted AND l.loan_id = t.loan_id)) AS portfolio_transactions""")
def expected_counts(spark, folder):
    return cdc.expected_counts(_ledger(spark, folder))


# --- portfolio over customers and orders ------------------------------------------------

LOANS = """
loans AS (SELECT c_custkey AS loan_id, CAST(c_acctbal AS DECIMAL(12,2)) AS principal_amount, c_mktsegment AS currency,
  c_custkey % 10 = 0 AS is_deleted FROM customer),
payments AS (SELECT o_orderkey AS transaction_id, o_custkey AS loan_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
  CASE WHEN o_orderstatus = 'F' THEN 'repayment' ELSE 'disbursement' END AS transaction_type, o_orderkey % 50 = 0 AS is_deleted
  FROM orders),
totals AS (SELECT loan_id, count(*) AS transaction_count, sum(CASE WHEN transaction_type = 'repayment' THEN amount ELSE 0 END) AS repaid,
  sum(CASE WHEN transaction_type = 'disbursement' THEN amount ELSE 0 END) AS disbursed FROM payments WHERE NOT is_deleted GROUP BY 1),
portfolio AS (SELECT l.loan_id, l.principal_amount, l.currency, coalesce(transaction_count, 0) AS transaction_count,
  coalesce(repaid, 0) AS repaid_amount, coalesce(disbursed, 0) AS disbursed_amount
  FROM loans l LEFT JOIN totals t USING (loan_id) WHERE NOT l.is_deleted)
"""


def _loan_state(spark, folder):
    return load(spark, folder, "customer").select(
        F.lit(DEFAULT_SOURCE).alias("source_system"),
        F.col("c_custkey").alias("loan_id"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("principal_amount"),
        F.col("c_mktsegment").alias("currency"),
        (F.col("c_custkey") % 10 == 0).alias("is_deleted"),
    )


def _payment_state(spark, folder):
    return load(spark, folder, "orders").select(
        F.lit(DEFAULT_SOURCE).alias("source_system"),
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("loan_id"),
        F.when(F.col("o_orderstatus") == "F", "repayment").otherwise("disbursement").alias("transaction_type"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        (F.col("o_orderkey") % 50 == 0).alias("is_deleted"),
    )


def _portfolio(spark, folder):
    loans = cdc.current(_loan_state(spark, folder)).drop("is_deleted")
    return cdc.portfolio(loans, cdc.current(_payment_state(spark, folder)))


@query(f"""WITH {LOANS} SELECT loan_id, CAST(principal_amount AS DOUBLE) AS principal_amount, currency, transaction_count,
  CAST(repaid_amount AS DOUBLE) AS repaid_amount, CAST(disbursed_amount AS DOUBLE) AS disbursed_amount FROM portfolio""")
def loan_portfolio(spark, folder):
    return _portfolio(spark, folder).drop("source_system")


@query(f"""WITH {LOANS} SELECT currency, CAST(sum(principal_amount) AS DOUBLE) AS principal, CAST(sum(repaid_amount) AS DOUBLE) AS repaid,
  CAST(sum(disbursed_amount) AS DOUBLE) AS disbursed FROM portfolio GROUP BY 1""")
def portfolio_by_group(spark, folder):
    return cdc.portfolio_by_currency(_portfolio(spark, folder)).drop("source_system")


@query(f"""WITH {LOANS} SELECT transaction_id, loan_id FROM payments p WHERE NOT is_deleted
  AND NOT EXISTS (SELECT 1 FROM loans l WHERE l.loan_id = p.loan_id AND NOT l.is_deleted)""")
def orphans(spark, folder):
    loans = cdc.current(_loan_state(spark, folder))
    return cdc.orphans(cdc.current(_payment_state(spark, folder)), loans).select("transaction_id", "loan_id")


@query(f"""WITH {LOANS} SELECT (SELECT count(*) FROM events) AS ledger_events, (SELECT count(*) FROM loans WHERE NOT is_deleted) AS current_loans,
  (SELECT count(*) FROM payments WHERE NOT is_deleted) AS current_transactions, (SELECT count(*) FROM payments WHERE is_deleted) AS transaction_tombstones,
  (SELECT count(*) FROM payments p WHERE NOT is_deleted AND NOT EXISTS (SELECT 1 FROM loans l WHERE l.loan_id = p.loan_id AND NOT l.is_deleted)) AS orphan_transactions,
  (SELECT count(*) FROM portfolio) AS portfolio_loans, (SELECT CAST(sum(transaction_count) AS BIGINT) FROM portfolio) AS portfolio_transactions""")
def reconcile(spark, folder):
    return cdc.reconcile(
        load(spark, folder, "events"), _loan_state(spark, folder), _payment_state(spark, folder),
        _portfolio(spark, folder),
    )


# --- merges -----------------------------------------------------------------------------

RAW_LINES = """lines AS (SELECT l_orderkey || '-' || l_linenumber AS record_id, CAST(l_partkey AS VARCHAR) || '/' || l_suppkey
    || '/' || CAST(CAST(l_extendedprice AS DECIMAL(20,2)) AS VARCHAR) AS payload, strftime(l_shipdate, '%Y-%m-%d') AS ingested_at_utc,
    'run-' || l_returnflag AS run_id, l_suppkey AS sequence FROM lineitem)"""


def _raw_lines(spark, folder):
    price = F.col("l_extendedprice").cast("decimal(20,2)").cast("string")
    return load(spark, folder, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("record_id"),
        F.concat_ws("/", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), price).alias("payload"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ingested_at_utc"),
        F.concat(F.lit("run-"), "l_returnflag").alias("run_id"),
        F.col("l_suppkey").alias("sequence"),
    )


@query(f"""WITH {RAW_LINES} SELECT record_id, payload, ingested_at_utc, run_id, sequence FROM (SELECT *, row_number() OVER (
  PARTITION BY record_id ORDER BY ingested_at_utc DESC, run_id DESC, sequence DESC, payload DESC) AS place FROM lines) WHERE place = 1""")
def latest_record(spark, folder):
    """Previous rows: those shipped before 1998; incoming: the rest."""
    lines = _raw_lines(spark, folder)
    early = F.col("ingested_at_utc") < "1998"
    return latest.consolidate(lines.filter(~early), lines.filter(early))


@query("""SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) < DATE '1998-07-01' AS was_stored FROM orders""")
def merge_insert_only(spark, folder):
    """Stored: orders before mid-1998; incoming: orders of 1998 and later."""
    orders = load(spark, folder, "orders")
    stored = orders.filter(F.col("o_orderdate") < F.lit("1998-07-01")).withColumn("was_stored", F.lit(True))
    incoming = orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01")).withColumn("was_stored", F.lit(False))
    return merge.insert_absent(stored, incoming, ["o_orderkey"]).select("o_orderkey", "o_orderstatus", "was_stored")


@query("""SELECT o_custkey, max(o_orderkey) AS event_sequence, arg_max(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE), o_orderkey) AS amount
  FROM orders GROUP BY 1""")
def merge_guarded(spark, folder):
    """State of even orders merged with the state of odd orders: the higher order number wins."""
    orders = load(spark, folder, "orders").select(
        "o_custkey", F.col("o_orderkey").alias("event_sequence"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
    )

    def state(rest):
        rows = orders.filter(F.col("event_sequence") % 2 == rest)
        return latest.latest_per_key(rows, ["o_custkey"], [F.desc("event_sequence")])

    return merge.merge_newer(state(0), state(1), ["o_custkey"], "event_sequence")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'moved' ELSE c_mktsegment END AS segment,
  CASE WHEN c_custkey % 5 = 0 OR c_custkey % 4 = 0 THEN 'new' ELSE 'old' END AS ingested FROM customer""")
def upsert_changed(spark, folder):
    """Every fifth customer is not stored yet, every fourth has another segment."""
    customers = load(spark, folder, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    stored = customers.filter(F.col("c_custkey") % 5 != 0).withColumn("ingested", F.lit("old"))
    moved = F.when(F.col("c_custkey") % 4 == 0, "moved").otherwise(F.col("segment"))
    incoming = customers.withColumn("segment", moved).withColumn("ingested", F.lit("new"))
    return merge.upsert_changed(stored, incoming, ["c_custkey"], ["segment"])


@query("""SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 3 = 0 THEN 'seed' ELSE 'stored' END AS origin FROM supplier""")
def insert_absent(spark, folder):
    suppliers = load(spark, folder, "supplier").select("s_suppkey", "s_name")
    stored = suppliers.filter(F.col("s_suppkey") % 3 != 0).withColumn("origin", F.lit("stored"))
    return merge.insert_absent(stored, suppliers.withColumn("origin", F.lit("seed")), ["s_suppkey"])


SUPPLIER_DIFF = """before AS (SELECT * FROM supplier WHERE s_suppkey % 7 <> 0),
after AS (SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 5 = 0 THEN 0 ELSE s_nationkey END AS s_nationkey, s_acctbal
  FROM supplier WHERE s_suppkey % 11 <> 0)"""


def _supplier_states(spark, folder):
    suppliers = load(spark, folder, "supplier")
    key = F.col("s_suppkey")
    moved = F.when(key % 5 == 0, F.lit(0)).otherwise(F.col("s_nationkey"))
    return suppliers.filter(key % 7 != 0), suppliers.filter(key % 11 != 0).withColumn("s_nationkey", moved)


@query(f"""WITH {SUPPLIER_DIFF} SELECT coalesce(b.s_suppkey, a.s_suppkey) AS s_suppkey,
  CASE WHEN b.s_suppkey IS NULL THEN 'I' WHEN a.s_suppkey IS NULL THEN 'D' ELSE 'U' END AS operation,
  coalesce(a.s_nationkey, b.s_nationkey) AS s_nationkey
  FROM before b FULL JOIN after a USING (s_suppkey) WHERE b.s_suppkey IS NULL OR a.s_suppkey IS NULL OR a.s_nationkey <> b.s_nationkey""")
def snapshot_diff(spark, folder):
    old, new = _supplier_states(spark, folder)
    changes = merge.snapshot_changes(old, new, ["s_suppkey"])
    return changes.select("record_data.s_suppkey", "operation", "record_data.s_nationkey")


@query(f"""WITH {SUPPLIER_DIFF}, c AS (SELECT coalesce(b.s_suppkey, a.s_suppkey) AS k,
    CASE WHEN b.s_suppkey IS NULL THEN 'I' WHEN a.s_suppkey IS NULL THEN 'D' ELSE 'U' END AS operation, coalesce(a.s_name, b.s_name) AS name
  FROM before b FULL JOIN after a USING (s_suppkey) WHERE b.s_suppkey IS NULL OR a.s_suppkey IS NULL OR a.s_nationkey <> b.s_nationkey)
  SELECT 'lending' AS source_schema, 'suppliers' AS source_table, operation, '{{"s_suppkey":' || k || '}}' AS record_key, name AS s_name FROM c""")
def capture_changes(spark, folder):
    old, new = _supplier_states(spark, folder)
    events = outbox.capture_changes(old, new, "lending", "suppliers", "s_suppkey")
    return events.withColumn("s_name", F.get_json_object("record_data", "$.s_name")).drop("record_data")


@query("""SELECT 'lending' AS source_schema, 'suppliers' AS source_table, 'I' AS operation, '{"s_suppkey":' || s_suppkey || '}' AS record_key,
  s_name FROM supplier""")
def bootstrap_events(spark, folder):
    """Two snapshots by name; the marker table already holds the second one."""
    suppliers = load(spark, folder, "supplier")
    markers = spark.createDataFrame([("done-v1",)], "snapshot_name string")
    parts = [
        outbox.bootstrap_events(suppliers, "lending", "suppliers", "s_suppkey", name, markers)
        for name in ("initial-v1", "done-v1")
    ]
    events = parts[0].unionByName(parts[1])
    return events.select(
        "source_schema", "source_table", "operation", "record_key",
        F.get_json_object("record_data", "$.s_name").alias("s_name"),
    )


# --- outbox -----------------------------------------------------------------------------


def _outbox(spark, folder):
    """Orders as an outbox; every third row was exported already."""
    orders = load(spark, folder, "orders")
    return orders.select(
        outbox.derived_event_id(F.col("o_orderkey").cast("string")).alias("event_id"),
        F.col("o_orderkey").alias("event_sequence"),
        F.lit("lending").alias("source_schema"),
        F.when(F.col("o_orderkey") % 2 == 0, "loans").otherwise("loan_transactions").alias("source_table"),
        F.lit("I").alias("operation"),
        F.to_json(F.struct(F.col("o_orderkey").alias("loan_id"))).alias("record_key"),
        F.to_json(F.struct(F.col("o_orderkey").alias("loan_id"), F.col("o_orderstatus").alias("status"))).alias("record_data"),
        F.col("o_orderdate").alias("captured_at"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate")).alias("exported_at"),
    )


UUID = r"regexp_replace(md5(CAST(o_orderkey AS VARCHAR)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5')"
PENDING = f"""pending AS (SELECT *, {UUID} AS event_id FROM orders WHERE o_orderkey % 3 <> 0)"""


@query(f"""WITH {PENDING} SELECT event_id, o_orderkey AS event_sequence, '{{"schema_version":1,"capture_method":"transactional_outbox","source_system":"lending-postgres-dev","event_id":"'
  || event_id || '","event_sequence":"' || o_orderkey || '","source_schema":"lending","source_table":"' || CASE WHEN o_orderkey % 2 = 0 THEN 'loans' ELSE 'loan_transactions' END
  || '","operation":"I","record_key":{{"loan_id":' || o_orderkey || '}},"record_data":{{"loan_id":' || o_orderkey || ',"status":"' || o_orderstatus
  || '"}},"captured_at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"}}' AS event_json FROM pending""")
def outbox_pending(spark, folder):
    events = outbox.as_events(outbox.pending(_outbox(spark, folder)))
    return events.select("event_id", "event_sequence", "event_json")


def _delivered(spark, folder):
    """Every fifth event is there already, every seventieth of those with other bytes."""
    events = outbox.as_events(_outbox(spark, folder)).filter(F.col("event_sequence") % 5 == 0)
    body = F.when(F.col("event_sequence") % 70 == 0, "{}").otherwise(F.col("event_json"))
    return events.select("event_id", body.alias("event_json"))


DELIVERED = f"""WITH {SUPPLIER_DIFF},
c AS (SELECT coalesce(b.s_suppkey, a.s_suppkey) AS k, CASE WHEN b.s_suppkey IS NULL THEN 'I' WHEN a.s_suppkey IS NULL THEN 'D' ELSE 'U' END AS operation,
    coalesce(a.s_name, b.s_name) AS s_name, coalesce(a.s_nationkey, b.s_nationkey) AS s_nationkey, coalesce(a.s_acctbal, b.s_acctbal) AS s_acctbal
  FROM before b FULL JOIN after a USING (s_suppkey) WHERE b.s_suppkey IS NULL OR a.s_suppkey IS NULL OR a.s_nationkey <> b.s_nationkey),
taken AS (SELECT 0 AS part, s_suppkey AS k, 'I' AS operation, s_name, s_nationkey, s_acctbal FROM before
  UNION ALL SELECT 1, k, operation, s_name, s_nationkey, s_acctbal FROM c),
numbered AS (SELECT *, row_number() OVER (ORDER BY part, '{{"s_suppkey":' || k || '}}') AS event_sequence FROM taken)"""


@query(f"""{DELIVERED} SELECT 'lending-postgres-dev' AS source, 'lending' AS schema, 'suppliers' AS "table", event_sequence, operation,
  '{{"s_suppkey":' || k || '}}' AS record_key, s_name, s_nationkey, s_acctbal,
  CASE WHEN part = 0 THEN '2024-01-01T00:00:00.000000Z' ELSE '2024-01-02T00:00:00.000000Z' END AS captured_at,
  regexp_replace(md5('lending/' || event_sequence), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') AS event_id FROM numbered""")
def capture_to_delivery(spark, folder):
    """A snapshot (asked for twice), the changes behind it, and two drains, of which the second finds
    nothing; what lies in the delivery folders."""
    root = shared_folder(spark, "outbox")
    old, new = _supplier_states(spark, folder)
    taken = {"suppliers": (old, "s_suppkey")}
    outbox_store.take_snapshot(spark, root, taken, "initial-v1", "run_1", captured_at="2024-01-01 00:00:00")
    outbox_store.take_snapshot(spark, root, taken, "initial-v1", "run_2", captured_at="2024-01-01 00:00:00")
    changes = outbox.capture_changes(old, new, "lending", "suppliers", "s_suppkey")
    outbox_store.capture(spark, root, changes, "run_3", "2024-01-02 00:00:00")
    for _ in range(2):
        outbox_store.drain(spark, root, f"{root}/out", size=100)
    told = {
        "event_sequence": "bigint", "operation": "string", "record_key": "string", "captured_at": "string",
    }
    image = {"s_name": "string", "s_nationkey": "int", "s_acctbal": "double"}
    return outbox_store.delivered_events(spark, f"{root}/out").select(
        "source", "schema", "table", "event_id",
        *[F.get_json_object("event_json", f"$.{k}").cast(v).alias(k) for k, v in told.items()],
        *[F.get_json_object("event_json", f"$.record_data.{k}").cast(v).alias(k) for k, v in image.items()],
    )


@query(f"""{DELIVERED} SELECT 'suppliers' AS "table", CAST(ceil(event_sequence / 50.0) AS INTEGER) AS batch, count(*) AS selected,
  count(*) FILTER (WHERE event_sequence > 100) AS uploaded, count(*) FILTER (WHERE event_sequence <= 100) AS reused FROM numbered GROUP BY ALL""")
def delivery_folders(spark, folder):
    """The acknowledgement of the first hundred events is lost; the next drain reuses what lies there."""
    root = shared_folder(spark, "outbox")
    old, new = _supplier_states(spark, folder)
    outbox_store.take_snapshot(spark, root, {"suppliers": (old, "s_suppkey")}, "initial-v1", "run_1")
    outbox_store.capture(spark, root, outbox.capture_changes(old, new, "lending", "suppliers", "s_suppkey"), "run_2")
    pending = outbox.pending(outbox_store.outbox_events(spark, root))
    none = spark.createDataFrame([], "event_id string, event_json string")
    first = outbox.drain_batches(pending, none, size=50, batches=2)
    outbox_store.deliver(first, f"{root}/out")
    again = outbox_store.outcomes(spark, root, f"{root}/out", size=50)
    return again.groupBy(F.col("source_table").alias("table"), "batch").agg(
        F.count("*").alias("selected"), F.count_if(F.col("outcome") == "uploaded").alias("uploaded"),
        F.count_if(F.col("outcome") == "reused").alias("reused"),
    )


OUTCOME = """CASE WHEN o_orderkey % 5 <> 0 THEN 'uploaded' WHEN o_orderkey % 70 = 0 THEN 'conflict' ELSE 'reused' END"""


@query(f"WITH {PENDING} SELECT event_id, {OUTCOME} AS outcome FROM pending")
def delivery_outcome(spark, folder):
    events = outbox.as_events(outbox.pending(_outbox(spark, folder)))
    return outbox.delivery_outcomes(events, _delivered(spark, folder)).select("event_id", "outcome")


@query(f"""SELECT o_orderkey AS event_sequence, o_orderkey % 3 = 0 OR {OUTCOME} <> 'conflict' AS exported FROM orders""")
def acknowledge(spark, folder):
    box = _outbox(spark, folder)
    outcomes = outbox.delivery_outcomes(outbox.as_events(outbox.pending(box)), _delivered(spark, folder))
    done = outbox.acknowledge(box, outcomes, "2024-01-01 00:00:00")
    return done.select("event_sequence", F.col("exported_at").isNotNull().alias("exported"))


@query(f"""WITH {PENDING}, first AS (SELECT *, CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / 100.0) AS INTEGER) AS batch
    FROM pending)
  SELECT batch, count(*) AS selected, count(*) FILTER (WHERE {OUTCOME} = 'uploaded') AS uploaded, count(*) FILTER (WHERE {OUTCOME} = 'reused') AS reused,
  count(*) FILTER (WHERE {OUTCOME} <> 'conflict') AS acknowledged FROM first GROUP BY 1""")
def batch_drain(spark, folder):
    """All pending rows in batches of a hundred, with totals per batch."""
    batches = outbox.drain_batches(_outbox(spark, folder), _delivered(spark, folder), size=100)
    return batches.groupBy("batch").agg(
        F.count("*").alias("selected"),
        F.count_if(F.col("outcome") == "uploaded").alias("uploaded"),
        F.count_if(F.col("outcome") == "reused").alias("reused"),
        F.count_if(F.col("outcome") != "conflict").alias("acknowledged"),
    )


@query("""SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING min(l_partkey) <> max(l_partkey)""")
def conflicting_keys(spark, folder):
    """Line keys that name more than one part."""
    return grain.conflicting_groups(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "l_partkey")
