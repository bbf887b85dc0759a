"""Validation of the reference-area snapshot."""

from pyspark.sql import functions as F

from tablemart.functions.values import whole_number_text

# The ids a complete snapshot holds.
FIRST_AREA, LAST_AREA = 1, 77
POLYGONS = ("Polygon", "MultiPolygon")

AREA_ROW = "area_num_1 string, community string, the_geom string"


def decode_areas(rows, text="payload"):
    """Area rows from JSON objects; the geometry stays JSON text."""
    return rows.select(
        F.get_json_object(text, "$.area_num_1").alias("area_num_1"),
        F.get_json_object(text, "$.community").alias("community"),
        F.get_json_object(text, "$.the_geom").alias("the_geom"),
        F.col(text).alias("payload"),
    )


def area_faults(areas, complete=False, first=FIRST_AREA, last=LAST_AREA):
    """One row of counts: how many rows break each rule of the snapshot.

    `complete` also demands every id from first to last. All columns are 0 for a good snapshot.
    """
    number = F.when(F.col("area_num_1").rlike(r"^[0-9]+$"), F.col("area_num_1").try_cast("bigint"))
    geometry_kind = F.get_json_object("the_geom", "$.type")
    coordinates = F.get_json_object("the_geom", "$.coordinates")
    checked = areas.select(
        number.alias("number"),
        F.coalesce((number < first) | (number > last), F.lit(True)).alias("bad_id"),
        F.coalesce(F.length("community") == 0, F.lit(True)).alias("no_name"),
        (
            F.coalesce(~geometry_kind.isin(*POLYGONS), F.lit(True))
            | F.coalesce(F.json_array_length(coordinates) == 0, F.lit(True))
        ).alias("bad_polygon"),
    )
    per_id = checked.groupBy("number").agg(
        F.count("*").alias("rows"),
        *[F.count_if(name).alias(name) for name in ("bad_id", "no_name", "bad_polygon")],
    )
    total = F.coalesce(F.sum("rows"), F.lit(0))
    return per_id.agg(
        F.when(total == 0, 1).otherwise(0).cast("bigint").alias("empty"),
        F.coalesce(F.sum("bad_id"), F.lit(0)).alias("bad_id"),
        F.coalesce(F.sum(F.when(F.col("number").isNotNull(), F.col("rows") - 1)), F.lit(0)).alias("repeated_id"),
        F.coalesce(F.sum("no_name"), F.lit(0)).alias("no_name"),
        F.coalesce(F.sum("bad_polygon"), F.lit(0)).alias("bad_polygon"),
        (F.abs(total - F.lit(last - first + 1)) if complete else F.lit(0).cast("bigint")).alias("missing"),
    )


def checked_areas(areas, complete=False):
    """(record_id, payload) of a valid snapshot; an invalid one raises before use."""
    faults = {name: n for name, n in area_faults(areas, complete).first().asDict().items() if n}
    if faults:
        raise ValueError(f"area snapshot rejected: {faults}")
    return areas.select(whole_number_text(F.col("area_num_1")).alias("record_id"), "payload")
