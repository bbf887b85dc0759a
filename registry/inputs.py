"""The given tables as the library's inputs: raw trips, weather hours, areas and change events.

Everything is derived from whole tables by Spark expressions; faults are put in by modulus.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from tablemart.contracts import CAPTURE_METHOD, DEFAULT_SOURCE, SOURCE_SCHEMA
from tablemart.functions.settle import settle
from tablemart.plans import enrichment, trips
from tablemart.plans.outbox import derived_event_id
from tablemart.sources.files import spread_scan


def load(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_spread(spark, folder, name):
    """A table whose rows are about to be rendered and parsed."""
    return spread_scan(load(spark, folder, name))


def plain(frame):
    """Decimals as doubles, dates and times as text: values that every engine prints alike."""
    columns = []
    for column in frame.schema:
        value = F.col(column.name)
        if isinstance(column.dataType, DecimalType):
            value = value.cast("double")
        elif isinstance(column.dataType, (DateType, TimestampNTZType, TimestampType)):
            value = value.cast("string")
        columns.append(value.alias(column.name))
    return frame.select(*columns)


def _every(modulus, fault, value):
    return F.when(F.col("event_id") % modulus == 0, F.lit(fault)).otherwise(value)


def trip_text(events, faults=False):
    """Events as raw trip members, all text."""
    number = F.col("event_id")
    value = F.col("value").cast("decimal(20,2)").cast("string")
    members = {
        "taxi_id": F.concat(F.lit("taxi-"), F.col("user_id").cast("string")),
        "trip_start_timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "trip_seconds": (number % 3600).cast("string"),
        "trip_miles": F.concat(F.get_json_object("props", "$.k"), F.lit("."), (number % 10).cast("string")),
        "fare": value,
        "tips": F.when(number % 5 != 0, (number % 7).cast("string")),
        "trip_total": value,
        "payment_type": F.col("event_type"),
        "company": F.concat(F.lit("Company "), (number % 4).cast("string")),
        "pickup_community_area": (F.col("user_id") % 27).cast("string"),
        "dropoff_community_area": (number % 27).cast("string"),
    }
    if faults:
        members["fare"] = _every(17, "broken", members["fare"])
        members["trip_start_timestamp"] = _every(19, "invalid", members["trip_start_timestamp"])
        members["trip_total"] = _every(23, "-1", members["trip_total"])
        members["tips"] = _every(29, "-2", _every(31, "abc", members["tips"]))
        members["trip_miles"] = _every(37, "12345678901234567890", members["trip_miles"])
        members["taxi_id"] = _every(11, "   ", members["taxi_id"])
        members["company"] = _every(13, " padded ", members["company"])
        members["pickup_community_area"] = _every(7, "08", members["pickup_community_area"])
        members["payment_type"] = _every(41, "", members["payment_type"])
    return events.select(
        number.cast("string").alias("trip_id"), *[v.alias(k) for k, v in members.items()]
    )


def raw_trips(spark, folder, faults=False):
    """(trip_id, payload JSON)."""
    text = trip_text(load_spread(spark, folder, "events"), faults)
    return text.select("trip_id", F.to_json(F.struct(*text.columns)).alias("payload"))


def typed_trips(spark, folder, faults=False):
    return trips.typed(trips.decode(raw_trips(spark, folder, faults)))


def fact(spark, folder, faults=False):
    return trips.with_keys(trips.accepted(typed_trips(spark, folder, faults)))


def raw_areas(spark, folder):
    """(area_id, payload JSON): nations as areas with a small triangle."""
    key = F.col("n_nationkey").cast("double")
    ring = F.array(F.array(key, key), F.array(key + 1, key), F.array(key, key + 1), F.array(key, key))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    return load(spark, folder, "nation").select(
        F.col("n_nationkey").cast("string").alias("area_id"),
        F.to_json(
            F.struct(
                F.col("n_nationkey").cast("string").alias("area_num_1"),
                F.col("n_name").alias("community"),
                geometry.alias("the_geom"),
            )
        ).alias("payload"),
    )


def weather_hours(spark, folder):
    """Hourly measures from the event counts; some hours lack, some occur twice."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    counts = load(spark, folder, "events").groupBy(hour.alias("hour")).agg(F.count("*").alias("n"))
    copies = F.when((F.hour("hour") == 1) & (F.dayofmonth("hour") % 5 == 0), 2).otherwise(1)
    return counts.filter(F.col("n") % 13 != 0).select(
        "hour",
        F.when(F.col("n") % 11 != 0, (F.col("n") % 25).cast("double")).alias("temperature_2m"),
        (F.col("n") % 3).cast("double").alias("precipitation"),
        F.when(F.col("n") % 4 == 0, 1.0).otherwise(0.0).alias("snowfall"),
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    )


def raw_weather(spark, folder):
    """(payload JSON)."""
    local = F.date_format("hour", "yyyy-MM-dd'T'HH:00:00").alias("local_hour")
    return weather_hours(spark, folder).select(
        F.to_json(
            F.struct(local, "temperature_2m", "precipitation", "snowfall"),
            {"ignoreNullFields": "false"},
        ).alias("payload")
    )


def areas(spark, folder):
    return enrichment.area_dimension(raw_areas(spark, folder))


def hours(spark, folder):
    return enrichment.weather_dimension(raw_weather(spark, folder))


def change_event_text(spark, folder, faults=False):
    """(value JSON, source_file): events as loan and transaction changes."""
    stamped = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    # A column of its own: the documents name it several times and would format the time for each.
    events = load_spread(spark, folder, "events").select("event_id", "user_id", "event_type", "value", stamped.alias("stamp"))
    number, user, stamp = F.col("event_id"), F.col("user_id"), F.col("stamp")
    is_loan = number % 3 == 0
    transaction = user * 10 + number % 10
    amount = (F.col("value") + 1).cast("decimal(12,2)").cast("string")
    operation = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    version, event_id, sequence = F.lit(1), derived_event_id(number.cast("string")), (number + 1).cast("string")
    captured, shift = stamp, F.lit(0)
    if faults:
        version = F.when(number % 19 == 0, 2).otherwise(version)
        operation = _every(23, "X", operation)
        captured = _every(29, "2026-01-01", captured)
        amount = _every(31, "1.001", amount)
        shift = F.when(number % 37 == 0, 1).otherwise(0)
        sequence = _every(43, "-1", sequence)
        event_id = _every(47, "bad", event_id)

    def envelope(table, key_name, key, data):
        return F.to_json(
            F.struct(
                version.alias("schema_version"),
                F.lit(CAPTURE_METHOD).alias("capture_method"),
                F.lit(DEFAULT_SOURCE).alias("source_system"),
                event_id.alias("event_id"),
                sequence.alias("event_sequence"),
                F.lit(SOURCE_SCHEMA).alias("source_schema"),
                F.lit(table).alias("source_table"),
                operation.alias("operation"),
                F.struct((key + shift).alias(key_name)).alias("record_key"),
                F.struct(*data).alias("record_data"),
                captured.alias("captured_at"),
            )
        )

    extra = [F.when(number % 53 == 0, 1).alias("extra")] if faults else []
    loan = envelope("loans", "loan_id", user, [
        user.alias("loan_id"), amount.alias("principal_amount"), F.lit("GBP").alias("currency"),
        F.when(number % 2 == 0, "active").otherwise("closed").alias("status"),
        stamp.alias("created_at"), stamp.alias("updated_at"), *extra,
    ])
    payment = envelope("loan_transactions", "transaction_id", transaction, [
        transaction.alias("transaction_id"), user.alias("loan_id"),
        F.when(number % 2 == 0, "repayment").otherwise("disbursement").alias("transaction_type"),
        amount.alias("amount"), stamp.alias("occurred_at"), stamp.alias("updated_at"), *extra,
    ])
    value = F.when(is_loan, loan).otherwise(payment)
    if faults:
        value = (
            F.when(number % 17 == 0, F.substring(value, 1, 20))
            .when(number % 41 == 0, F.concat(value, F.lit(" x")))
            .otherwise(value)
        )
    rows = events.select(
        value.alias("value"), F.concat(F.lit("events/"), number.cast("string")).alias("source_file")
    )
    # A filter on the text would render it a second time.
    return settle(rows, ["source_file"], ["value"]).select(*rows.columns)
