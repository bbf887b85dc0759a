"""Options of relational reads and writes; the driver jar comes from the cluster."""

FETCH_ROWS = 5_000
BATCH_ROWS = 5_000


def bucketed_query(table, key, columns, buckets):
    """A subquery with an even bucket number per row, so ids need not be numeric.

    The expression is PostgreSQL's text hash moved to a non-negative range.
    """
    wanted = ", ".join(columns)
    bucket = f"((hashtext({key}::text)::bigint + 2147483648) % {buckets})::int"
    return f"(select {wanted}, {bucket} as bucket from {table}) src"


def parallel_read_options(url, query, buckets, fetch_rows=FETCH_ROWS, **connection):
    """One task per bucket."""
    return {
        **connection,
        "url": url,
        "dbtable": query,
        "partitionColumn": "bucket",
        "lowerBound": "0",
        "upperBound": str(buckets),
        "numPartitions": str(buckets),
        "fetchsize": str(fetch_rows),
    }


def single_read_options(url, query, fetch_rows=FETCH_ROWS, **connection):
    """A small table or query in one task."""
    return {**connection, "url": url, "dbtable": query, "fetchsize": str(fetch_rows)}


def write_options(url, table, batch_rows=BATCH_ROWS, **connection):
    return {**connection, "url": url, "dbtable": table, "batchsize": str(batch_rows)}


def read_parallel(spark, url, table, key, columns, buckets=8, **connection):
    query = bucketed_query(table, key, columns, buckets)
    options = parallel_read_options(url, query, buckets, **connection)
    return spark.read.format("jdbc").options(**options).load().drop("bucket")


def read_single(spark, url, query, **connection):
    options = single_read_options(url, query, **connection)
    return spark.read.format("jdbc").options(**options).load()


def write_staged(frame, url, table, connections=2, **connection):
    """Overwrite a staging table over a bounded number of connections."""
    options = write_options(url, table, **connection)
    frame.coalesce(connections).write.format("jdbc").options(**options).mode("overwrite").save()
