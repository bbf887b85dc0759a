"""Parquet tables in folders and in the catalog."""

from pyspark.sql import functions as F

from tablemart.contracts import CDC_TABLES, LEDGER, QUARANTINE, state_schema
from tablemart.sources.files import quoted


def write_new(frame, path):
    """A table that must not exist yet."""
    frame.write.mode("errorifexists").parquet(path)


def gathered(frame, columns):
    """Rows brought together by their values of these columns. The rebalance is adaptive: a value that
    holds a third of all rows is split over many tasks, small values share one."""
    return frame.hint("rebalance", *columns) if columns else frame


def write_partitioned(frame, path, columns, mode="errorifexists", gather=True):
    """A table in one folder per partition value.

    Rows are first brought together by partition value, so a value is written by few tasks and
    the table has few files. Without `gather` they are written where they are: for rows that were
    gathered before wide columns were added, and for those of a table that is stored by the same values.
    """
    if gather:
        frame = gathered(frame, columns)
    writer = frame.write.mode(mode).option("compression", "snappy")
    if columns:
        writer = writer.partitionBy(*columns)
    writer.parquet(path)


def write_raw_by_date(frame, path, payload="payload", member="trip_start_timestamp"):
    """Raw rows by the date text of one payload member."""
    dated = frame.withColumn("trip_date", F.substring(F.get_json_object(payload, f"$.{member}"), 1, 10))
    write_partitioned(dated, path, ["trip_date"], mode="overwrite")


def replace_table(frame, name):
    """Replace the whole content of a catalog table, creating it when it is missing.

    The frame must not read the table it replaces.
    """
    frame.write.mode("overwrite").format("parquet").saveAsTable(quoted(name))


def register_location(spark, name, path, schema_ddl=None):
    """Catalog entry over Parquet files that a snapshot already wrote."""
    name = quoted(name)
    columns = f"({schema_ddl})" if schema_ddl else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} {columns} USING parquet LOCATION '{path}'")
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def create_current_views(spark, database):
    """Views of the current business rows of the state tables: no tombstones, no bookkeeping columns."""
    for name, contract in CDC_TABLES.items():
        columns = ", ".join(["source_system", *contract.fields])
        spark.sql(
            f"CREATE OR REPLACE VIEW {quoted(f'{database}.{name}_current')} AS"
            f" SELECT {columns} FROM {quoted(f'{database}.{name}_state')} WHERE NOT is_deleted"
        )
    return [f"{database}.{name}_current" for name in CDC_TABLES]


def create_cdc_tables(spark, database):
    """Ledger, quarantine and state tables of the event contract, when missing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    schemas = {"event_ledger": LEDGER, "quarantine": QUARANTINE}
    schemas.update({f"{name}_state": state_schema(name) for name in CDC_TABLES})
    for name, schema in schemas.items():
        partition = " PARTITIONED BY (source_table)" if name == "event_ledger" else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(database)}.{name} ({schema}) USING parquet{partition}")
    return [f"{database}.{name}" for name in schemas]
