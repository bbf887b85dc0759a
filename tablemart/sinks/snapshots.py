"""Immutable snapshots selected by a pointer, and run records.

A run writes every table below its own folder. The pointer gets its new version last, so a failed run
leaves the previous snapshot selected. A version is one file that only one writer can create: of two
publishers of one version, one wins and the other writes nothing. Everything goes through Spark's
writers and file systems, hence works wherever Spark can write.
"""

import json

from pyspark.errors import AnalysisException

from tablemart.storage import create_once, names_in, read_text
from tablemart.table_notes import OWNER, describe, describe_column

POINTER = "version bigint, run_id string, published_at_utc string, tables string"
RUNS = (
    "run_id string, status string, started_at_utc string, completed_at_utc string,"
    " extracted_rows bigint, error string"
)


def _rows(spark, path, ddl):
    """Rows of a small append-only JSON table; none when it was never written."""
    try:
        return spark.read.schema(ddl).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def pointer_rows(spark, root, ddl=POINTER):
    """Every version ever published, oldest included."""
    return _rows(spark, f"{root}/_pointer", ddl)


def current_pointer(spark, root):
    """The newest pointer row, None before the first one."""
    versions = [n for n in names_in(spark, f"{root}/_pointer") if n.endswith(".json") and n[:-5].isdigit()]
    return json.loads(read_text(spark, f"{root}/_pointer/{versions[-1]}")) if versions else None


def current_version(spark, root):
    """Version of the published snapshot, 0 before the first one."""
    newest = current_pointer(spark, root)
    return newest["version"] if newest else 0


def current_run(spark, root):
    """Run id of the published snapshot, None before the first one."""
    newest = current_pointer(spark, root)
    return newest["run_id"] if newest else None


def run_folder(root, run_id):
    return f"{root}/snapshots/{run_id}"


def table_folder(root, run_id, name):
    return f"{run_folder(root, run_id)}/{name.replace('.', '/')}"


def read_current(spark, root, name):
    """A table of the published snapshot, None before the first one."""
    run_id = current_run(spark, root)
    return spark.read.parquet(table_folder(root, run_id, name)) if run_id else None


def table_metadata(frames, contracts, owner=OWNER):
    """Manifest rows: meaning, owner, columns with their meaning, partitioning, grain and contract
    version of each table. A table without a contract has no grain and version 1."""
    for name, frame in sorted(frames.items()):
        contract = contracts.get(name)
        yield {
            "table_name": name,
            "description": describe(name),
            "owner": owner,
            "columns": [(c.name, c.dataType.simpleString(), describe_column(c.name)) for c in frame.schema],
            "partition_by": ", ".join(contract.partition_by) if contract else "",
            "grain": ", ".join(contract.primary_key) if contract else "",
            "contract_version": contract.version if contract else 1,
        }


MANIFEST = (
    "table_name string, description string, owner string,"
    " columns array<struct<name:string,type:string,description:string>>, partition_by string,"
    " grain string, contract_version int"
)


def write_manifest(spark, root, run_id, rows):
    frame = spark.createDataFrame(list(rows), MANIFEST).coalesce(1)
    frame.write.mode("errorifexists").json(f"{run_folder(root, run_id)}/manifest")


def manifest(spark, root, run_id):
    """The manifest of a run, one row per table."""
    return spark.read.schema(MANIFEST).json(f"{run_folder(root, run_id)}/manifest")


class PublishConflict(RuntimeError):
    """Another writer published the version first; nothing was written."""


def move_pointer(spark, root, row, based_on=None):
    """Publish a pointer row as the version after `based_on` (default: after the newest one)."""
    version = (current_version(spark, root) if based_on is None else based_on) + 1
    if not create_once(spark, f"{root}/_pointer/{version:012d}.json", json.dumps({"version": version, **row})):
        raise PublishConflict(f"version {version} below {root} was published by another writer")
    return version


def publish(spark, root, run_id, published_at, tables, based_on=None):
    """Select the snapshot of this run, after all its tables are written.

    `based_on` is the version the run started from: if another one was published meanwhile, this
    one is refused, as its tables do not hold what that one added.
    """
    row = {"run_id": run_id, "published_at_utc": published_at, "tables": ",".join(sorted(tables))}
    return move_pointer(spark, root, row, based_on)


def record_run(spark, root, run_id, status, started_at, completed_at=None, rows=None, error=None):
    """One audit row per status change, with the whole error text."""
    row = spark.createDataFrame([(run_id, status, started_at, completed_at, rows, error)], RUNS)
    row.coalesce(1).write.mode("append").json(f"{root}/_runs")


def run_records(spark, root):
    return _rows(spark, f"{root}/_runs", RUNS)
