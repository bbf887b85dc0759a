"""Vectors packed into blocks: many rows become one binary value that numpy reads without copying."""

import io

import numpy as np
from pyspark.sql import functions as F


def whole_vectors(frame, key, vector, *more):
    """id, vector (doubles) and `more` of the rows whose key is not null and whose vector is neither
    null nor holds null, NaN or infinity."""
    value = F.col(vector).cast("array<double>")
    good = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = frame.filter(F.col(key).isNotNull() & F.coalesce(good, F.lit(False)))
    return sound.select(F.col(key).cast("long").alias("id"), value.alias("vector"), *more)


def pack(**arrays):
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(blob):
    return np.load(io.BytesIO(blob), allow_pickle=False)
