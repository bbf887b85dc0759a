"""Expensive columns computed exactly once per row."""

from pyspark.sql import functions as F


def settle(frame, passed, computed):
    """The frame with its `computed` columns as finished values.

    A filter on a computed column is pushed through projections by copying the whole expression,
    so a parsed document would be parsed again for every rule the filter refers to. Filters are
    not pushed through a generator: unfolding a one-element array makes each row's values once.
    """
    row = F.struct(*[F.col(name) for name in computed])
    return frame.select(*[F.col(name) for name in passed], F.inline(F.array(row)))
