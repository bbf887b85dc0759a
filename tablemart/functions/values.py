"""Guarded parsing of text values, hashes and buckets."""

from pyspark.sql import functions as F

# The number pattern and the measure type the warehouse accepts.
NUMBER_PATTERN = r"^-?[0-9]+(\.[0-9]+)?$"
MEASURE_TYPE = "decimal(20,6)"
UNKNOWN = "Unknown"


def number_or_null(column, kind=MEASURE_TYPE):
    """Plain decimal text as a number; any other text and any overflow becomes NULL."""
    return F.when(column.rlike(NUMBER_PATTERN), column.try_cast(kind))


def label_or_unknown(column):
    """Text without outer spaces; blank or missing text becomes 'Unknown'. Tabs survive."""
    return F.coalesce(F.nullif(F.trim(column), F.lit("")), F.lit(UNKNOWN))


def whole_number_text(column):
    """Canonical integer text: '08' and '8.0' both give '8', anything else gives NULL."""
    integer_part = F.regexp_extract(column, r"^\s*([+-]?[0-9]+)(\.[0-9]*)?\s*$", 1)
    return integer_part.try_cast("int").cast("string")


def reason_list(rules):
    """';'-joined names of the broken rules, in rule order; '' when all hold."""
    return F.concat_ws(";", *[F.when(broken, F.lit(name)) for name, broken in rules])


def first_reason(rules):
    """Name of the first broken rule, NULL when all hold."""
    return F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules])


def surrogate_key(column):
    """Key of a dimension row: SHA-256 of its natural key."""
    return F.sha2(column, 256)


def bucket_of(column, buckets):
    """Even, value-independent bucket number in [0, buckets)."""
    return F.pmod(F.hash(column), F.lit(buckets))


def canonical_uuid(column):
    """Lower-case dashed UUID text; NULL for text that is not a UUID.

    Accepted spellings: dashed or not, upper case, in braces, with a urn:uuid: prefix. Text that
    is canonical already, the usual case, is recognised by one pattern.
    """
    bare = F.regexp_replace(column, r"urn:|uuid:", "")
    bare = F.regexp_replace(bare, r"^[{}]+|[{}]+$", "")
    digits = F.lower(F.regexp_replace(bare, "-", ""))
    dashed = F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(
        column.rlike(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"), column
    ).when(digits.rlike(r"^[0-9a-f]{32}\z"), dashed)


def integer_text(column):
    """64-bit integer from its shortest decimal text; '+1', '01' and '1.0' give NULL.

    The shortest text is the one that the number itself is written as.
    """
    number = column.try_cast("bigint")
    return F.when(number.cast("string") == column, number)
