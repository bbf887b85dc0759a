"""Tables dealt over buckets of their key, of which a commit replaces some.

Rows live in run=../bucket=.. folders. The pointer says for every bucket which run wrote it last, so a
commit writes the buckets it changes, leaves the files of all others as they are, and selects old and new
ones together when its pointer is created. Readers of the version before go on reading their files.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablemart.sinks import snapshots


def bucket_of(columns, count):
    """Bucket of a row by the hash of its key columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(count)).cast("int")


class BucketTable:
    """One table below `place`, as its newest pointer selects it when this object is made."""

    def __init__(self, spark, place, ddl):
        self.spark, self.place, self.ddl = spark, place, ddl
        self.columns = [*StructType.fromDDL(ddl).names, "bucket"]
        head = snapshots.current_pointer(spark, place) or {"version": 0, "buckets": {}}
        self.version, self.at = head["version"], {int(b): found for b, found in head["buckets"].items()}

    def read(self, only=None):
        """Rows with their `bucket`; with `only`, those of some buckets: no other file is opened."""
        wanted = self.at if only is None else {b: self.at[b] for b in only if b in self.at}
        schema = f"{self.ddl}, bucket int"
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = sorted(f"{self.place}/run={found['run']}/bucket={b}" for b, found in wanted.items())
        rows = self.spark.read.schema(f"{schema}, run string").option("basePath", self.place).parquet(*paths)
        rows = rows.select(*self.columns)
        return rows if only is None else rows.filter(F.col("bucket").isin(sorted(wanted)))

    def replace(self, frame, run_id, touched, **sums):
        """Replace the content of the touched buckets by `frame` (with its `bucket`) and select it.

        sums: name = column; its total is kept for every bucket beside the number of rows, so that
        totals over the table need no scan.
        """
        folder = f"{self.place}/run={run_id}"
        dealt = frame.select(*self.columns).hint("rebalance", "bucket")
        dealt.write.mode("errorifexists").option("compression", "snappy").partitionBy("bucket").parquet(folder)
        written = self.spark.read.schema(f"{self.ddl}, bucket int").parquet(folder)
        counts = written.groupBy("bucket").agg(F.count("*").alias("rows"), *[v.alias(k) for k, v in sums.items()])
        at = {b: found for b, found in self.at.items() if b not in touched}
        # One small row per touched bucket.
        at |= {r["bucket"]: {"run": run_id, **{k: int(r[k] or 0) for k in ("rows", *sums)}} for r in counts.collect()}
        row = {"run_id": run_id, "buckets": {str(b): found for b, found in sorted(at.items())}}
        self.version = snapshots.move_pointer(self.spark, self.place, row, self.version)
        self.at = at

    def total(self, name="rows"):
        """Sum over all buckets, from the pointer alone."""
        return sum(found.get(name, 0) for found in self.at.values())
