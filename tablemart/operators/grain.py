"""Key, null and reference checks that return the offending rows or one-row counts."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F


def duplicate_keys(frame, keys):
    """Keys that occur more than once (NULL keys group together), with their counts."""
    counts = frame.groupBy(*keys).agg(F.count("*").alias("occurrences"))
    return counts.filter(F.col("occurrences") > 1)


def surplus_keys(frame, key):
    """One row: how many rows exceed the number of distinct keys."""
    return frame.agg((F.count("*") - F.countDistinct(key)).alias("surplus"))


def null_counts(frame, columns):
    """One row, one count of NULLs per column.

    Only rows with a NULL are looked at: a scan of Parquet leaves out the row groups that have none by
    their statistics, which it does for columns inside the files and for partition columns, but not for both
    in one condition.
    """
    found = frame.filter(reduce(or_, [F.col(name).isNull() for name in columns]))
    return found.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])


def unmatched(frame, reference, keys):
    """Rows without a partner in the reference table."""
    return frame.join(reference.select(*keys), list(keys), "left_anti")


def conflicting_groups(frame, keys, content):
    """Keys whose rows disagree on `content`; rows without content disagree with nothing.

    Two different contents exist exactly when the smallest and the largest of their hashes differ.
    Numbers are compared where texts would be sorted: one shuffle of hash-aggregated partial minima
    and maxima, 32 bytes a key. Two independent 64-bit hashes make equal hashes of different
    contents negligible.
    """
    value, sums = F.col(content), []
    for seed in (0, 1):
        mark = F.when(value.isNotNull(), F.xxhash64(value, F.lit(seed)))
        sums += [F.min(mark).alias(f"_low{seed}"), F.max(mark).alias(f"_high{seed}")]
    marks = frame.groupBy(*keys).agg(*sums)
    return marks.filter("_low0 <> _high0 OR _low1 <> _high1").select(*keys)
