"""Insert, upsert and diff of keyed tables, as plans over immutable Parquet tables.

Every function returns the new content (or the rows to append); the caller writes it to a new
path. Upserts rewrite the whole content and so read each side once, in one full outer join by key.
"""

from pyspark.sql import functions as F


def absent_rows(stored, incoming, keys):
    """Incoming rows whose key is not stored yet: the rows an insert-only merge appends."""
    batch_keys = incoming.select(*keys)
    present = stored.select(*keys).join(batch_keys, list(keys), "left_semi")
    return incoming.join(present, list(keys), "left_anti")


def insert_absent(stored, incoming, keys):
    """Stored rows plus the incoming rows with a new key; stored rows never change."""
    return stored.unionByName(absent_rows(stored, incoming, keys))


def _choose(stored, incoming, keys, take_incoming):
    """Per key of either side: the incoming row where the stored one is missing or the condition holds,
    else the stored row. One full outer join, so both sides are read once."""
    values = [name for name in stored.columns if name not in keys]
    old = stored.select(*keys, F.struct(*values).alias("_old"))
    new = incoming.select(*keys, F.struct(*values).alias("_new"))
    better = F.col("_old").isNull() | (F.col("_new").isNotNull() & take_incoming(F.col("_new"), F.col("_old")))
    pick = F.when(better, F.col("_new")).otherwise(F.col("_old"))
    return old.join(new, list(keys), "full").select(*keys, pick.alias("_row")).select(*keys, "_row.*").select(
        *stored.columns
    )


def merge_newer(stored, incoming, keys, sequence):
    """Upsert where only a strictly higher sequence replaces a stored row.

    `incoming` has one row per key. Stale and replayed rows have no effect; a key without a
    stored row is inserted, deletes included, so a tombstone survives as a row.
    """
    return _choose(stored, incoming, keys, lambda new, old: new[sequence] > old[sequence])


def upsert_changed(stored, incoming, keys, content):
    """Upsert where only a change of `content` replaces a stored row.

    A row that arrives unchanged keeps its stored ingest time.
    """
    def changed(new, old):
        differs = [~new[name].eqNullSafe(old[name]) for name in content]
        found = differs[0]
        for other in differs[1:]:
            found = found | other
        return found

    return _choose(stored, incoming, keys, changed)


def snapshot_changes(old, new, keys):
    """Row changes between two states of a table: I, U or D with the row image.

    Deletes carry the before-image, inserts and updates the after-image; equal rows are absent.
    """
    values = [name for name in new.columns if name not in keys]
    before = old.select(*keys, F.struct(*keys, *values).alias("_before"))
    after = new.select(*keys, F.struct(*keys, *values).alias("_after"))
    operation = (
        F.when(F.col("_before").isNull(), "I")
        .when(F.col("_after").isNull(), "D")
        .when(~F.col("_before").eqNullSafe(F.col("_after")), "U")
    )
    return (
        before.join(after, list(keys), "full_outer")
        .select(operation.alias("operation"), F.coalesce("_after", "_before").alias("image"))
        .filter(F.col("operation").isNotNull())
        .select("operation", F.struct(*[F.col("image")[k].alias(k) for k in keys]).alias("record_key"),
                F.col("image").alias("record_data"))
    )
