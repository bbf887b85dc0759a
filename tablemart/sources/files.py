"""Scans with fixed schemas: nothing is inferred from the data."""

from math import ceil

from pyspark.sql import functions as F

from tablemart.contracts import RAW_ENVELOPE

DOCUMENT_GLOB = "*.json"
#: Rows of a scan that one task renders or parses.
ROWS_PER_TASK = 100_000


def read_batches(spark, paths):
    """Envelope rows of JSON-lines batch files; no files give an empty frame."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        return spark.createDataFrame([], RAW_ENVELOPE)
    return spark.read.schema(RAW_ENVELOPE).json(paths)


def read_documents(spark, path):
    """One row per *.json file below the path: its text and where it came from."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", DOCUMENT_GLOB)
        .text(path, wholetext=True)
        .select("value", F.col("_metadata.file_path").alias("source_file"))
    )


def read_lines(spark, path):
    """One row per text line. Pretty-printed documents span lines: use read_documents there."""
    return spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("value").alias("event_json")
    )


def read_parquet(spark, path, schema=None):
    """A Parquet table; Hive-style partition folders become columns and prune the scan."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def spread_scan(rows):
    """The rows of a scan over all cores and in tasks of at most ROWS_PER_TASK rows.

    For narrow rows before dear work: a scan is cut by the bytes of its files, however dear the rows
    are to parse. Parquet counts its rows without reading them. A scan that has tasks enough stays as
    it is. Only for plain scans: asking for the tasks of a plan with shuffles would run them.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, ceil(rows.count() / ROWS_PER_TASK))
    return rows.repartition(tasks) if rows.rdd.getNumPartitions() < tasks else rows


def quoted(name):
    """A dotted table name with every part quoted, so that none is read as anything but a name."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def read_table(spark, name):
    """A catalog table such as `database.table`."""
    return spark.table(quoted(name))
