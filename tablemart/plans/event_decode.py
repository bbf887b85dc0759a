"""Strict decoding of change events with column expressions only.

The rules run in a fixed order and the first broken one is the reason of the rejection; order and
texts of the reasons are fixed values. Members are taken out of the document once, in stages, so
that later rules refer to finished columns.
"""

from functools import lru_cache, reduce

from pyspark.sql import functions as F

from tablemart.contracts import (
    CAPTURE_METHOD,
    CDC_TABLES,
    DEFAULT_SOURCE,
    OPERATIONS,
    SCHEMA_VERSION,
    SOURCE_SCHEMA,
)
from tablemart.functions.json_docs import is_sealed, kind_of, member, sealed_document, value_of
from tablemart.functions.settle import settle
from tablemart.functions.times import canonical_iso
from tablemart.functions.values import canonical_uuid, first_reason, integer_text

DECODED = (
    "error", "event_id", "event_sequence", "source_system", "source_table", "record_id",
    "operation", "captured_at", "payload_json", "event_hash",
)
# Fixed value: amounts stay below this, with at most two decimals.
MONEY_LIMIT = "10000000000"
# VARIANT kinds a field of each contract kind may arrive as.
_WHOLE = "BIGINT|STRING"
_NUMBER = r"BIGINT|STRING|DOUBLE|FLOAT|DECIMAL\([0-9]+,[0-9]+\)"


# All members as text, and both row images as maps, so that unknown members show. The version is a
# bare whole number: text, fractions and truth values are none and give NULL.
_ENVELOPE = (
    "schema_version int, capture_method string, source_system string, source_schema string,"
    " source_table string, operation string, event_id string, event_sequence string,"
    " captured_at string, record_data map<string,string>, record_key map<string,string>"
)


def _arrives_as(kind):
    return _WHOLE if kind == "bigint" else _NUMBER if kind.startswith("decimal") else "STRING"


def _fields():
    """Every field of the contract with its kind; a name has one kind in all tables."""
    kinds = {}
    for contract in CDC_TABLES.values():
        for name, kind in contract.fields.items():
            if kinds.setdefault(name, kind) != kind:
                raise ValueError(f"{name} has two kinds")
    return kinds


def _not(condition):
    """True unless the condition is known to hold."""
    return ~F.coalesce(condition, F.lit(False))


def _money(text):
    """Amount of at most ten digits before and two after the point.

    Text that the amount itself is written as, the usual case, needs no look at its digits. Other
    spellings (exponents, trailing zeros) are compared at a wider scale first, because a
    cast to two decimals rounds; digits beyond the wider scale are looked for in the text.
    """
    usual = text.try_cast("decimal(12,2)")
    exact = text.try_cast("decimal(38,18)")
    long_tail = text.rlike(r"^[^eE]*\.[0-9]{2}[0-9]*[1-9]")
    fits = (F.abs(exact) < F.lit(MONEY_LIMIT).cast("decimal(38,18)")) & (exact == F.round(exact, 2))
    return F.when(usual.cast("string") == text, usual).when(
        text.rlike(r"^-?[0-9]{1,10}(\.[0-9]{1,2})?\z"), usual
    ).when(fits & ~long_tail, exact.try_cast("decimal(12,2)"))


def _complete(contract):
    """The row image has exactly the contracted members and none is null."""
    values = [F.col(f"_text_{name}").isNotNull() for name in contract.fields]
    return reduce(lambda a, b: a & b, values, F.size("_data") == len(contract.fields))


def _text(name, kind):
    """Text of a field.

    That of the map is enough but for amounts: a bare number there has gone through a double,
    so amounts come from the document, which keeps decimals exact. The way into the document is
    dear and taken for the tables that have the field alone.
    """
    if kind.startswith("decimal"):
        tables = [table for table, contract in CDC_TABLES.items() if name in contract.fields]
        return F.when(F.col("_table").isin(tables), member(F.col("_document"), f"record_data.{name}", "string"))
    return F.try_element_at("_data", F.lit(name))


def _value(name, kind):
    """Normalised value of a field, NULL when it breaks its kind."""
    text = F.col(f"_text_{name}")
    if kind.startswith("decimal"):
        return _money(text)
    if kind == "bigint":
        return integer_text(text)
    if kind == "timestamp":
        return canonical_iso(text)
    return text


def _field_rules(contract):
    """The value decides whether a field is good; the kind it came as only names the fault, so
    it is looked up behind a fault."""
    for name, kind in contract.fields.items():
        value = F.col(f"_value_{name}")
        given = kind_of(member(F.col("_document"), f"record_data.{name}"))
        odd_kind = ~given.rlike(f"^({_arrives_as(kind)})$")
        yield f"{name} cannot be null", F.col(f"_text_{name}").isNull()
        if kind == "bigint":
            yield "bigint must be an integer", value.isNull() & odd_kind
            yield "invalid bigint", value.isNull()
        elif kind.startswith("decimal"):
            yield f"{name} must be decimal", value.isNull() & odd_kind
            yield f"{name} exceeds {kind}", value.isNull()
        elif kind == "timestamp":
            yield "timestamp must be a timezone-aware string", value.isNull()
        elif name in contract.enums:
            known = value.isin(*contract.enums[name])
            yield f"{name} must be string", ~known & odd_kind
            yield f"unsupported {name}", ~known
        elif name == "currency":
            known = value.rlike(r"^[A-Z]{3}\z")
            yield f"{name} must be string", ~known & odd_kind
            yield "currency must be three uppercase letters", ~known
        else:
            yield f"{name} must be string", odd_kind
        if name in contract.positive:
            yield f"{name} must be positive", value <= 0


def _record_rules(contract):
    """Rules of the row image and of its key, in order."""
    names = F.array(*[F.lit(name) for name in sorted(contract.fields)])
    same_members = _complete(contract) | (F.array_sort(F.map_keys("_data")) == names)
    yield "record_data fields do not match contract", _not(same_members)
    yield from _field_rules(contract)
    same_key = (F.size("_key") == 1) & (
        integer_text(F.col("_key")[contract.key]) == F.col(f"_value_{contract.key}")
    )
    yield "record_key does not match record_data", _not(same_key)


def _envelope_rules(source):
    document = F.col("_document")
    yield "invalid JSON", document.isNull()
    yield "envelope must be an object", F.col("_version").isNull() & ~F.startswith(
        kind_of(value_of(document)), F.lit("OBJECT")
    )
    yield "unsupported schema_version", _not(F.col("_version") == SCHEMA_VERSION)
    yield "unsupported capture_method", _not(F.col("_method") == CAPTURE_METHOD)
    yield "unexpected source_system", _not(F.col("_source") == source)
    yield "unsupported source_schema", _not(F.col("_schema") == SOURCE_SCHEMA)
    yield "unsupported source_table", _not(F.col("_table").isin(*CDC_TABLES))
    # A number of 32 digits reads like a UUID without dashes.
    text_id = F.contains("_id_text", F.lit("-")) | (kind_of(member(document, "event_id")) == "STRING")
    yield "event_id must be a UUID string", _not(text_id)
    yield "badly formed hexadecimal UUID string", F.col("_id").isNull()
    given = kind_of(member(document, "event_sequence"))
    yield "missing event_sequence", F.col("_sequence").isNull() & given.isNull()
    yield "bigint must be an integer", F.col("_sequence").isNull() & ~given.isin("STRING", "BIGINT")
    yield "invalid bigint", F.col("_sequence").isNull()
    yield "event_sequence must be positive", F.col("_sequence") <= 0
    yield "unsupported operation", _not(F.col("_operation").isin(*OPERATIONS))
    yield "timestamp must be a timezone-aware string", F.col("_captured").isNull()


def _per_table(build):
    """One expression per table, chosen by the table name; only the chosen one is evaluated."""
    branches = [(F.col("_table") == name, build(contract)) for name, contract in CDC_TABLES.items()]
    return reduce(lambda chain, branch: chain.when(*branch), branches[1:], F.when(*branches[0]))


def _payload(contract):
    """Canonical JSON text of the row image: sorted members, amounts as text."""
    members = []
    for name in sorted(contract.fields):
        value = F.col(f"_value_{name}")
        if contract.fields[name].startswith("decimal"):
            value = value.cast("string")
        members.append(value.alias(name))
    return F.to_json(F.struct(*members))


@lru_cache(maxsize=16)
def _stages(session, source, text):
    """The columns of every stage. They name columns only, so one set does for all inputs of a session
    (its application id is part of the key, as columns end with it)."""
    kinds = _fields()
    parsed = [sealed_document(F.col(text)).alias("_parsed"), F.from_json(F.col(text), _ENVELOPE).alias("_e")]
    opened = [
        F.when(is_sealed(F.col("_parsed"), F.col(text)), F.col("_parsed")).alias("_document"),
        F.col("_e.schema_version").alias("_version"),
        F.col("_e.capture_method").alias("_method"),
        F.col("_e.source_system").alias("_source"),
        F.col("_e.source_schema").alias("_schema"),
        F.col("_e.source_table").alias("_table"),
        F.col("_e.operation").alias("_operation"),
        F.col("_e.event_id").alias("_id_text"),
        F.col("_e.event_sequence").alias("_sequence_text"),
        F.col("_e.captured_at").alias("_captured_text"),
        F.col("_e.record_data").alias("_data"),
        F.col("_e.record_key").alias("_key"),
    ]
    # A stage of its own: the value rules name each text several times.
    texts = [_text(name, kind).alias(f"_text_{name}") for name, kind in kinds.items()]
    values = [
        canonical_uuid(F.col("_id_text")).alias("_id"),
        integer_text(F.col("_sequence_text")).alias("_sequence"),
        canonical_iso(F.col("_captured_text")).alias("_captured"),
        *[_value(name, kind).alias(f"_value_{name}") for name, kind in kinds.items()],
    ]
    judged = [
        F.coalesce(
            first_reason(_envelope_rules(source)),
            _per_table(lambda contract: first_reason(_record_rules(contract))),
        ).alias("error"),
        F.col("_id"), F.col("_sequence"), F.col("_table"), F.col("_operation"), F.col("_captured"),
        _per_table(lambda contract: F.col(f"_value_{contract.key}")).alias("_record"),
        _per_table(_payload).alias("_payload"),
    ]
    content = F.to_json(
        F.array(
            F.lit(source), F.col("event_id"), F.col("event_sequence").cast("string"), F.col("source_table"),
            F.col("operation"), F.col("captured_at"), F.col("payload_json"),
        )
    )
    found = {
        "event_id": F.col("_id"),
        "event_sequence": F.col("_sequence"),
        "source_system": F.lit(source),
        "source_table": F.col("_table"),
        "record_id": F.col("_record"),
        "operation": F.col("_operation"),
        "captured_at": F.col("_captured"),
        "payload_json": F.col("_payload"),
    }
    valid = F.col("error").isNull()
    result = [F.col("error"), *[F.when(valid, column).alias(name) for name, column in found.items()]]
    return parsed, opened, texts, values, judged, result, F.when(valid, F.sha2(content, 256)).alias(DECODED[-1])


def decode_events(raw, source=DEFAULT_SOURCE, text="value"):
    """The raw rows with either `error` or the normalised event columns.

    The hash stands behind the settled columns, as no filter refers to it: without a reader it is not made.
    """
    keep = [F.col(name) for name in raw.columns]
    session = raw.sparkSession.sparkContext.applicationId
    parsed, opened, texts, values, judged, result, event_hash = _stages(session, source, text)
    rows = raw.select(*keep, *parsed).select(*keep, *opened).select("*", *texts).select("*", *values)
    return settle(rows.select(*keep, *judged).select(*keep, *result), raw.columns, DECODED[:-1]).select("*", event_hash)
