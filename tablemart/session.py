"""Session settings shared by the jobs, the tests and the benchmark."""

from pyspark.sql import SparkSession

SETTINGS = {
    # ANSI arithmetic everywhere; parse points use try_* so bad text becomes NULL.
    "spark.sql.ansi.enabled": "true",
    # Reduce-side sizing, join strategy and skewed join partitions are decided at run time
    # from the real shuffle sizes, so no plan below carries a hand-picked partition count.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # A task that holds rows of few partition values writes their files side by side, without a sort
    # of its rows that could spill; from the ninth value on it sorts the rest.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Rows can be whole documents: a batch for a Python worker stays small in bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # The JVM never compiles a method above 8000 bytes of bytecode; the wide rule projections
    # are faster as many small generated methods than as one large interpreted one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app="tablemart", zone="UTC", master=None, **settings):
    """A session with the library settings; every job states its zone explicitly."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", zone)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def apply_settings(spark):
    """The library settings on a session somebody else built; all of them can change at run time."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
