"""The eight change events of the folding example, and helpers to write them as files."""

import json

SOURCE = "lending-postgres-dev"
STAMP = "2026-11-01T10:00:00Z"
CAPTURED = "2026-11-01T12:00:00Z"


def loan(sequence, key, amount, operation="I", **more):
    data = {
        "loan_id": key, "principal_amount": amount, "currency": "GBP", "status": "active",
        "created_at": STAMP, "updated_at": STAMP,
    }
    return event(sequence, "loans", operation, {"loan_id": key}, data, **more)


def transaction(sequence, key, loan_id, kind, amount, operation="I", **more):
    data = {
        "transaction_id": key, "loan_id": loan_id, "transaction_type": kind, "amount": amount,
        "occurred_at": STAMP, "updated_at": STAMP,
    }
    return event(sequence, "loan_transactions", operation, {"transaction_id": key}, data, **more)


def event(sequence, table, operation, key, data, event_id=None):
    return {
        "schema_version": 1,
        "capture_method": "transactional_outbox",
        "source_system": SOURCE,
        "event_id": event_id or f"00000000-0000-0000-0000-{sequence:012d}",
        "event_sequence": str(sequence),
        "source_schema": "lending",
        "source_table": table,
        "operation": operation,
        "record_key": key,
        "record_data": data,
        "captured_at": CAPTURED,
    }


def example():
    return [
        loan(1, 1001, "1000.00"),
        loan(2, 1002, "2000.00"),
        transaction(3, 5001, 1001, "disbursement", "1000.00"),
        transaction(4, 5002, 1002, "disbursement", "2000.00"),
        transaction(5, 5003, 1001, "repayment", "100.00"),
        transaction(6, 5999, 1001, "repayment", "25.00"),
        transaction(7, 5999, 1001, "repayment", "30.00", "U"),
        transaction(8, 5999, 1001, "repayment", "30.00", "D"),
    ]


def write(folder, events, indent=2):
    folder.mkdir(parents=True, exist_ok=True)
    for number, item in enumerate(events):
        text = item if isinstance(item, str) else json.dumps(item, indent=indent)
        (folder / f"{number:04d}_{abs(hash(text)) % 10**8}.json").write_text(text)
    return str(folder)
