"""Published table and column names."""

from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tablemart.contracts import PUBLISHED_FIELDS, PUBLISHED_TABLES


def published_name(table):
    return PUBLISHED_TABLES.get(table, table)


def published(frame):
    """Columns under their published names with units; wall-clock values as text."""
    as_text = [
        column.name for column in frame.schema
        if isinstance(column.dataType, (TimestampType, TimestampNTZType))
    ]
    frame = frame.withColumns({name: F.col(name).cast("string") for name in as_text})
    return frame.withColumnsRenamed(PUBLISHED_FIELDS)


def published_tables(tables):
    return {published_name(name): published(frame) for name, frame in tables.items()}
