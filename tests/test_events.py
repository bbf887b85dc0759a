"""Strict decoding: one reason per bad event, exact values for good ones."""

import json

import pytest
from pyspark.sql import functions as F

from change_events import SOURCE, loan, transaction
from registry.inputs import change_event_text
from tablemart.contracts import CDC_TABLES
from tablemart.plans import cdc
from tablemart.plans.event_decode import decode_events


def decode(spark, texts):
    rows = [(n, t if isinstance(t, str) else json.dumps(t)) for n, t in enumerate(texts)]
    decoded = decode_events(spark.createDataFrame(rows, "n int, value string"), SOURCE)
    return decoded.orderBy("n").collect()


def changed(**members):
    return {**loan(1, 1001, "1000.00"), **members}


def with_amount(amount):
    item = loan(1, 1001, "1000.00")
    item["record_data"]["principal_amount"] = amount
    return item


def with_data(**members):
    item = loan(1, 1001, "1000.00")
    item["record_data"].update(members)
    return item


BAD = [
    ("{broken", "invalid JSON"),
    ("", "invalid JSON"),
    ('{"x":1,"x":2}', "invalid JSON"),
    ('{"a":{"x":1,"x":2}}', "invalid JSON"),
    (json.dumps(loan(1, 1, "1.00")) + " x", "invalid JSON"),
    (json.dumps(loan(1, 1, "1.00")) + ', {"b":1}', "invalid JSON"),
    (json.dumps(loan(1, 1, "1.00")) + '], {"b":1}', "invalid JSON"),
    (json.dumps(loan(1, 1, "1.00")) + "} x", "invalid JSON"),
    ("[]", "envelope must be an object"),
    ("5", "envelope must be an object"),
    (changed(schema_version=2), "unsupported schema_version"),
    (changed(schema_version=True), "unsupported schema_version"),
    (changed(schema_version="1"), "unsupported schema_version"),
    ('{"schema_version": 1.0}', "unsupported schema_version"),
    ("{}", "unsupported schema_version"),
    (changed(capture_method="x"), "unsupported capture_method"),
    (changed(source_system="other"), "unexpected source_system"),
    (changed(source_schema="x"), "unsupported source_schema"),
    (changed(source_table="unknown"), "unsupported source_table"),
    (changed(source_table=["loans"]), "unsupported source_table"),
    (changed(event_id=2), "event_id must be a UUID string"),
    (changed(event_id=10**31), "event_id must be a UUID string"),
    (changed(event_id="bad"), "badly formed hexadecimal UUID string"),
    (changed(event_sequence="-1"), "event_sequence must be positive"),
    (changed(event_sequence="0"), "event_sequence must be positive"),
    (changed(event_sequence="01"), "invalid bigint"),
    (changed(event_sequence="+1"), "invalid bigint"),
    (changed(event_sequence="1\n"), "invalid bigint"),
    (changed(event_sequence="9223372036854775808"), "invalid bigint"),
    (changed(event_sequence=True), "bigint must be an integer"),
    (changed(event_sequence=5.0), "bigint must be an integer"),
    (changed(operation="X"), "unsupported operation"),
    (changed(captured_at="2026-01-01"), "timestamp must be a timezone-aware string"),
    (changed(captured_at="2026-01-01T00:00:00"), "timestamp must be a timezone-aware string"),
    (changed(captured_at="2026-02-30T00:00:00Z"), "timestamp must be a timezone-aware string"),
    (changed(captured_at=5), "timestamp must be a timezone-aware string"),
    (changed(record_data=[]), "record_data fields do not match contract"),
    (changed(record_data={"loan_id": 1}), "record_data fields do not match contract"),
    (with_data(extra=1), "record_data fields do not match contract"),
    (with_data(currency=None), "currency cannot be null"),
    (with_data(currency="gbp"), "currency must be three uppercase letters"),
    (with_data(currency="GBP\n"), "currency must be three uppercase letters"),
    (with_data(currency=5), "currency must be string"),
    (with_data(status="open"), "unsupported status"),
    (with_data(loan_id="01001"), "invalid bigint"),
    (with_data(loan_id=1001.0), "bigint must be an integer"),
    (with_data(created_at="yesterday"), "timestamp must be a timezone-aware string"),
    (with_amount("0.00"), "principal_amount must be positive"),
    (with_amount("-1.00"), "principal_amount must be positive"),
    (with_amount("1.001"), "principal_amount exceeds decimal(12,2)"),
    (with_amount(1.001), "principal_amount exceeds decimal(12,2)"),
    (with_amount("1." + "0" * 25 + "1"), "principal_amount exceeds decimal(12,2)"),
    (with_amount("10000000000.00"), "principal_amount exceeds decimal(12,2)"),
    (with_amount("NaN"), "principal_amount exceeds decimal(12,2)"),
    (with_amount(True), "principal_amount must be decimal"),
    (changed(record_key={"loan_id": 42}), "record_key does not match record_data"),
    (changed(record_key={"loan_id": 1001, "x": 1}), "record_key does not match record_data"),
    (changed(record_key=1001), "record_key does not match record_data"),
]


def test_every_fault_has_its_reason(spark):
    rows = decode(spark, [text for text, _ in BAD])
    got = [(BAD[n][0] if isinstance(BAD[n][0], str) else n, row["error"]) for n, row in enumerate(rows)]
    want = [(BAD[n][0] if isinstance(BAD[n][0], str) else n, reason) for n, (_, reason) in enumerate(BAD)]
    assert got == want
    assert all(row["event_id"] is None and row["payload_json"] is None for row in rows)


GOOD = [
    ("9999999999.99", "9999999999.99"), ("1E2", "100.00"), (7, "7.00"), (12.5, "12.50"),
    ("1.5000", "1.50"), (9999999999.99, "9999999999.99"), (" 3.25 ", "3.25"),
]


def test_amounts_stay_exact(spark):
    rows = decode(spark, [with_amount(given) for given, _ in GOOD])
    assert [row["error"] for row in rows] == [None] * len(GOOD)
    amounts = [json.loads(row["payload_json"])["principal_amount"] for row in rows]
    assert amounts == [want for _, want in GOOD]


def test_spellings_of_one_event_have_one_hash(spark):
    plain = loan(1, 1001, "1000.00")
    spellings = [
        plain,
        json.dumps(plain, indent=3),
        {**plain, "event_id": "{" + plain["event_id"].replace("-", "").upper() + "}"},
        {**plain, "event_id": "urn:uuid:" + plain["event_id"]},
        {**plain, "event_sequence": 1},
        {**plain, "captured_at": "2026-11-01T13:00:00+01:00"},
        {**plain, "captured_at": "2026-11-01T12:00:00.000000Z"},
        {**plain, "captured_at": "2026-11-01 12:00Z"},
        {**plain, "ignored": {"x": 1}},
        {**plain, "record_key": {"loan_id": "1001"}},
        with_data(loan_id="1001"),
        with_amount(1000),
    ]
    rows = decode(spark, spellings)
    assert [row["error"] for row in rows] == [None] * len(spellings)
    assert len({row["event_hash"] for row in rows}) == 1
    assert rows[0]["captured_at"] == "2026-11-01T12:00:00+00:00"


def test_content_changes_the_hash(spark):
    plain = transaction(3, 5001, 1001, "repayment", "1.00")
    rows = decode(spark, [plain, {**plain, "operation": "U"}, transaction(3, 5001, 1001, "repayment", "2.00")])
    assert len({row["event_hash"] for row in rows}) == 3
    assert [row["record_id"] for row in rows] == [5001] * 3


def test_document_is_parsed_once(spark):
    raw = spark.createDataFrame([("{}",)], "value string")
    good = decode_events(raw).filter(F.col("error").isNull()).select("event_id")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


@pytest.mark.parametrize("zone", ["America/Chicago", "Asia/Tokyo"])
def test_session_zone_does_not_matter(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    want = decode(spark, [loan(1, 1001, "1000.00")])[0]["event_hash"]
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert decode(spark, [loan(1, 1001, "1000.00")])[0]["event_hash"] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_hash_is_made_for_its_readers_alone(spark):
    decoded = decode_events(spark.createDataFrame([("{}",)], "value string"))
    for column, there in (("error", False), ("event_hash", True)):
        plan = decoded.select(column)._jdf.queryExecution().optimizedPlan().toString()
        assert ("sha2" in plan) == there


def test_usual_and_odd_spellings_agree(spark):
    zero = [with_data(created_at=f"2026-02-03T04:05:{text}Z") for text in ("10", "10.5", "10.500000", "10.000000", "07.120")]
    rows = decode(spark, zero)
    stamps = [json.loads(row["payload_json"])["created_at"][17:] for row in rows]
    assert stamps == ["10+00:00", "10.5+00:00", "10.5+00:00", "10+00:00", "07.12+00:00"]
    signs = decode(spark, [with_data(loan_id=text) for text in ("-0", " 1001", "1001 ", "1e3", "1001L")])
    assert [row["error"] for row in signs] == ["invalid bigint"] * 5


def test_filter_on_the_text_does_not_render_it_again(spark, tmp_path):
    spark.sql("SELECT id AS event_id, id AS user_id, timestamp'2024-01-01' AS ts, 'signup' AS event_type, 1.5D AS value FROM range(10)").write.parquet(f"{tmp_path}/events.parquet")
    rows = change_event_text(spark, str(tmp_path)).filter(F.col("value").contains("loan"))
    assert rows.count() == 10
    plan = rows._jdf.queryExecution().optimizedPlan()
    assert not any("to_json" in line for line in plan.toString().splitlines() if line.strip(" +-:").startswith("Filter"))


LEDGER = "source_system string, source_table string, record_id bigint, operation string, event_sequence bigint, payload_json string, event_id string, event_hash string, captured_at timestamp"


def small_ledger(spark):
    image = '{"loan_id":1,"principal_amount":"1.00","currency":"GBP","status":"active"}'
    rows = [
        ("loans", 1, "I", 1, image), ("loans", 1, "U", 5, image.replace("active", "closed")), ("loans", 2, "D", 2, image),
        ("loan_transactions", 1, "I", 3, '{"transaction_id":1,"loan_id":1}'), ("loan_transactions", 1, "D", 9, '{"transaction_id":1,"loan_id":1}'),
        ("loan_transactions", 2, "I", 4, '{"transaction_id":2,"loan_id":2}'), ("loan_transactions", 3, "U", 6, '{"transaction_id":3,"loan_id":1}'),
    ]
    return spark.createDataFrame([(SOURCE, t, r, o, s, p, str(s), str(s), None) for t, r, o, s, p in rows], LEDGER)


def test_counts_are_aggregated_by_hash(spark):
    counts = cdc.expected_counts(small_ledger(spark))
    assert counts.first().asDict() == {
        "ledger_events": 7, "current_loans": 1, "current_transactions": 2, "transaction_tombstones": 1,
        "orphan_transactions": 1, "portfolio_loans": 1, "portfolio_transactions": 1,
    }
    assert "SortAggregate" not in counts._jdf.queryExecution().executedPlan().toString()


def test_one_pass_gives_the_states_of_all_tables(spark):
    ledger = small_ledger(spark)
    latest = cdc.latest_records(ledger)
    assert latest.count() == 5
    for name in CDC_TABLES:
        rows = cdc.state_rows(latest.filter(F.col("source_table") == name), name)
        want = cdc.fold(ledger, name).collect()
        assert sorted(map(str, rows.collect())) == sorted(map(str, want)) and len(want) in (2, 3)


def test_event_times_are_formatted_once(spark, tmp_path):
    row = "SELECT 3L AS event_id, timestamp'2024-01-01 00:00:01.5' AS ts, 7L AS user_id, 'signup' AS event_type, 1.5D AS value"
    spark.sql(row).write.parquet(str(tmp_path / "events.parquet"))
    text = change_event_text(spark, str(tmp_path))
    assert text._jdf.queryExecution().optimizedPlan().toString().count("date_format") == 1
    item = json.loads(text.first()["value"])
    assert item["captured_at"] == item["record_data"]["updated_at"] == "2024-01-01T00:00:01.500000Z"
