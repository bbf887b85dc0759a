"""Top rows, ties, bounded reads and consecutive numbering."""

from pyspark.sql import Window, functions as F

from tablemart.storage import pin


class LimitExceeded(ValueError):
    """A read promised to be small was not."""


def top_rows(frame, order, count):
    """The first `count` rows; each task keeps only its own first `count` on the way."""
    return frame.orderBy(*order).limit(count)


def all_at_extreme(frame, value, extreme, where=None):
    """Every row whose value equals the extreme over the (filtered) frame, ties included.

    The extreme is one scalar from a map-side combined aggregate and the rows are then found
    by a filter on it: no global sort and no single-task window.
    """
    pool = frame if where is None else frame.filter(where)
    bound = pool.agg(extreme(value).alias("bound"))
    return pool.filter(F.col(value) == bound.scalar())


def extremes(frame, value, lowest_where=None):
    """Rows with the largest value, and rows with the smallest value among those of `lowest_where`,
    with the column `extreme` ('longest' or 'shortest'), ties included.

    Both bounds come from one aggregate and both sets from one filter: two scans, no sort.
    """
    low = F.min(value if lowest_where is None else F.when(lowest_where, F.col(value)))
    bounds = frame.agg(F.struct(F.max(value).alias("high"), low.alias("low")).alias("bounds")).scalar()
    lowest = F.lit(True) if lowest_where is None else lowest_where
    found = frame.withColumn("_bounds", bounds).withColumn("extreme", F.explode(F.array_compact(F.array(
        F.when(F.col(value) == F.col("_bounds.high"), "longest"),
        F.when(lowest & (F.col(value) == F.col("_bounds.low")), "shortest"),
    ))))
    return found.drop("_bounds")


def bounded(frame, limit):
    """The frame, unless it has more than `limit` rows; reads at most limit + 1 of them."""
    if frame.limit(limit + 1).count() > limit:
        raise LimitExceeded(f"more than {limit} rows")
    return frame


def number_rows(frame, order, name="sequence", start=0):
    """Consecutive numbers start, start+1, .. in the given order, without a one-task window.

    The rows are range-sorted over all tasks and pinned in the shared folder, so that the
    partitions stay as they are if an executor is lost. The generated row id holds partition
    and position; adding the row count of all earlier partitions (one small row per partition)
    makes the position global. `order` should name a unique row, so no range is one hot value.
    """
    sorted_rows = pin(frame.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", 33)
    position = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted_rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")
    )
    numbered = sorted_rows.withColumn("_part", part).join(starts, "_part")
    return numbered.withColumn(name, F.col("_before") + position + F.lit(start)).drop(
        "_row", "_part", "_before"
    )
