"""CSV and GeoJSON exports of published tables."""

from pyspark.sql import functions as F

from tablemart.contracts import PUBLISHED_FIELDS

_WORKING_FIELDS = {published: working for working, published in PUBLISHED_FIELDS.items()}
_AVERAGE = "average_trip_duration_seconds"


def export_columns(table, frame):
    """Working column names of an exported table, as its readers know them."""
    if table == "gold.mart_taxi_trip_enriched":
        names = {k: v for k, v in _WORKING_FIELDS.items() if k != _AVERAGE}
    else:
        names = {_AVERAGE: _WORKING_FIELDS[_AVERAGE]}
    return frame.withColumnsRenamed({k: v for k, v in names.items() if k in frame.columns})


def write_csv(frame, path, mode="errorifexists"):
    """One CSV part file with header per task."""
    frame.write.mode(mode).option("header", True).csv(path)


def features(areas):
    """One GeoJSON Feature text per area; this form has no size limit."""
    properties = F.struct("area_id", "area_name")
    return areas.select(
        "area_id",
        F.to_json(
            F.struct(
                F.lit("Feature").alias("type"),
                properties.alias("properties"),
                F.try_parse_json("geometry_geojson").alias("geometry"),
            )
        ).alias("feature"),
    )


def feature_collection(areas):
    """(part, area_id, line): the lines of one FeatureCollection document, in the order (part, area_id).

    One head line, a line per area with a comma behind all but the last, one tail line; no row holds
    more than one area and no task more than its range of them.
    """
    rows = features(areas)
    last = rows.agg(F.max("area_id").alias("last"))
    comma = F.when(F.col("area_id") < last.scalar(), ",").otherwise("")
    lines = rows.select(F.lit(1).alias("part"), "area_id", F.concat("feature", comma).alias("line"))
    ends = rows.sparkSession.createDataFrame(
        [(0, None, '{"type":"FeatureCollection","features":['), (2, None, "]}")],
        f"part int, area_id {rows.schema['area_id'].dataType.simpleString()}, line string",
    )
    return lines.unionByName(ends)


def write_feature_collection(areas, path, mode="errorifexists"):
    """The document as text parts whose concatenation in file order is one JSON value."""
    feature_collection(areas).orderBy("part", "area_id").select("line").write.mode(mode).text(path)
