"""Dimension tables and their lookups."""

from pyspark.sql import functions as F

from tablemart.functions.values import surrogate_key


def natural_key_dimension(frame, columns, natural, key):
    """Distinct values of one or several columns of a frame with their surrogate key.

    Several columns (one dimension in several roles) are unfolded in the same scan, so the
    frame is read once however many roles share the dimension.
    """
    if len(columns) == 1:
        values = frame.select(F.col(columns[0]).alias(natural))
    else:
        values = frame.select(F.explode(F.array(*columns)).alias(natural))
    return values.distinct().withColumn(key, surrogate_key(F.col(natural)))


def lookup(frame, dimension, on, take):
    """Left join of a unique dimension: `on` maps frame column -> dimension column and `take`
    maps new column -> dimension column. The row count of the frame is preserved.

    No broadcast hint: Spark broadcasts the dimension when its measured size is below the
    session threshold and otherwise joins by key with skewed partitions split.
    """
    renamed = dimension.select(
        *[F.col(theirs).alias(ours) for ours, theirs in on.items()],
        *[F.col(theirs).alias(new) for new, theirs in take.items()],
    )
    return frame.join(renamed, list(on), "left")
