"""Strict JSON documents as VARIANT columns."""

from pyspark.sql import functions as F


def sealed_document(text):
    """The text and a seal, its own 64-bit hash, parsed together as a two-element array.

    The VARIANT parser refuses duplicate keys at every depth but stops after the first value.
    Behind anything but exactly one value the seal is not the second element: see `is_sealed`.
    """
    seal = F.xxhash64(text).cast("string")
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), seal, F.lit("]")))


def is_sealed(document, text):
    """Whether the text is exactly one JSON value, with nothing before or after it."""
    return F.try_variant_get(document, "$[1]", "bigint") == F.xxhash64(text)


def member(document, path, kind="variant"):
    """A member of a sealed document, by dotted path."""
    return F.try_variant_get(document, f"$[0].{path}", kind)


def value_of(document):
    return F.try_variant_get(document, "$[0]", "variant")


def kind_of(value):
    """BIGINT, STRING, BOOLEAN, DOUBLE, DECIMAL(p,s), VOID, OBJECT<..> or ARRAY<..>; NULL when absent."""
    return F.schema_of_variant(value)
