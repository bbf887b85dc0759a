"""Column-array weather responses as hourly rows."""

from pyspark.sql import functions as F

from tablemart.functions.times import ZONED, iso_utc_text, local_hour_text, utc_from_iso, utc_to_local

# Measures with their units, and the constants of the weather source.
MEASURES = {"temperature_2m": "°C", "precipitation": "mm", "snowfall": "cm"}
MODEL = "era5"
LATITUDE, LONGITUDE = 41.8781, -87.6298

RESPONSE = (
    "hourly_units struct<"
    + ", ".join(f"{name}: string" for name in MEASURES)
    + ">, hourly struct<time: array<string>, "
    + ", ".join(f"{name}: array<double>" for name in MEASURES)
    + ">"
)


def response_faults():
    """Rules on a decoded response `r`: (fault, broken?)."""
    for name, unit in MEASURES.items():
        yield f"unit of {name}", ~F.col(f"r.hourly_units.{name}").eqNullSafe(F.lit(unit))
    for name in MEASURES:
        yield f"length of {name}", ~F.size(f"r.hourly.{name}").eqNullSafe(F.size("r.hourly.time"))


def _stop_if(rules, value):
    """The value, or an error of the job that names the first broken rule."""
    fault = F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules])
    return F.when(
        fault.isNotNull(), F.raise_error(F.concat(F.lit("weather response: "), fault))
    ).otherwise(value)


def _utc(time):
    """UTC wall-clock value of an hour: text without zone is UTC, text with an offset is moved."""
    return F.coalesce(utc_from_iso(time), F.when(~time.rlike(ZONED), time.try_cast("timestamp_ntz")))


def hourly_rows(responses, start, end, text="response"):
    """Rows (hour_utc, local_hour, measures) of the responses inside the local window.

    Arrays are zipped by position inside one row and unfolded by `inline`; each response stays
    in its own task. A wrong unit, a length mismatch, a non-hourly or repeated hour or a
    non-finite measure stops the job; a NULL measure is kept as NULL.
    """
    decoded = responses.select(F.from_json(text, RESPONSE).alias("r"))
    zipped = F.arrays_zip(
        F.col("r.hourly.time").alias("time"),
        *[F.col(f"r.hourly.{name}").alias(name) for name in MEASURES],
    )
    # Hours repeat within one response or not at all: chunks only share their UTC margin. They are
    # compared as instants, so one hour under two offsets is a repetition.
    instants = F.transform("r.hourly.time", _utc)
    repeated = F.size(F.array_distinct(instants)) != F.size("r.hourly.time")
    checked = _stop_if([*response_faults(), ("repeated hour", repeated)], zipped)
    rows = decoded.select(checked.alias("_rows")).select(F.inline("_rows"))
    stamp = _utc(F.col("time"))
    faults = [("time", stamp.isNull() | (stamp != F.date_trunc("hour", stamp)))]
    for name in MEASURES:
        value = F.col(name)
        odd = F.isnan(value) | (F.abs(value) == float("inf"))
        if name != "temperature_2m":
            odd = odd | (value < 0)
        faults.append((name, F.coalesce(odd, F.lit(False))))
    utc = rows.select(_stop_if(faults, stamp).cast("timestamp_ntz").alias("utc"), *MEASURES)
    local = utc.withColumn("local", utc_to_local(F.col("utc")))
    day = F.to_date("local")
    return local.filter((day >= F.lit(start)) & (day < F.lit(end))).select(
        iso_utc_text(F.col("utc")).alias("hour_utc"),
        local_hour_text(F.col("local")).alias("local_hour"),
        *MEASURES,
    )


def weather_payloads(rows):
    """(record key, payload JSON) of hourly rows, ready for the raw envelope."""
    members = [
        *MEASURES,
        "hour_utc",
        "local_hour",
        F.lit(MODEL).alias("model"),
        F.lit(LATITUDE).alias("latitude"),
        F.lit(LONGITUDE).alias("longitude"),
    ]
    return rows.select(
        F.col("hour_utc").alias("record_id"),
        F.to_json(F.struct(*members), {"ignoreNullFields": "false"}).alias("payload"),
    )
