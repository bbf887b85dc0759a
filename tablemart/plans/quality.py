"""Blocking checks as rows (check, table, violations, passed)."""

from functools import reduce

from pyspark.sql import functions as F

from tablemart.operators.grain import duplicate_keys, null_counts, unmatched
from tablemart.plans.trips import KM_PER_MILE

RESULT = "check string, table string, violations bigint, passed boolean"
DIMENSION_KEYS = ("taxi_key", "payment_key", "company_key", "pickup_area_key", "dropoff_area_key")


class QualityError(ValueError):
    """A blocking check failed."""


def _result(check, table, counted, violations):
    """One result row from a one-row frame."""
    return counted.select(
        F.lit(check).alias("check"), F.lit(table).alias("table"),
        violations.cast("bigint").alias("violations"), (violations == 0).alias("passed"),
    )


def schema_drift(spark, name, frame, contract):
    """Columns that are missing, unexpected or of another type. Order and nullability flags do
    not count; nothing is read."""
    actual = {c.name: c.dataType.simpleString() for c in frame.schema}
    wrong = [k for k in {**actual, **contract.types} if actual.get(k) != contract.types.get(k)]
    return spark.createDataFrame([("schema", name, len(wrong), not wrong)], RESULT).coalesce(1)


def unique_grain(name, frame, keys):
    return _result("unique key", name, duplicate_keys(frame, keys).agg(F.count("*").alias("n")), F.col("n"))


def required_values(name, frame, columns, partition_by=()):
    """All NULLs of all required columns; those of partition columns are counted apart, from the folders."""
    parts = []
    for group in ([c for c in columns if c not in partition_by], [c for c in columns if c in partition_by]):
        if group:
            counts = reduce(lambda a, b: a + b, [F.col(c) for c in group])
            parts.append(null_counts(frame, group).select(counts.alias("n")))
    counted = reduce(lambda a, b: a.unionByName(b), parts).agg(F.sum("n").alias("n"))
    return _result("required values", name, counted, F.col("n"))


def split_complete(raw, accepted, quarantined):
    """Every raw row is either accepted or quarantined."""
    parts = [
        raw.agg(F.count("*").alias("n")),
        accepted.agg((-F.count("*")).alias("n")),
        quarantined.agg((-F.count("*")).alias("n")),
    ]
    total = reduce(lambda a, b: a.unionByName(b), parts).agg(F.sum("n").alias("n"))
    return _result("accepted + quarantined", "silver.fact_taxi_trip", total, F.abs("n"))


def _totals(name, frame, trips, amount):
    return frame.agg(
        F.lit(name).alias("table"),
        F.coalesce(trips, F.lit(0)).cast("bigint").alias("trips"),
        F.sum(amount).cast("decimal(38,6)").alias("amount"),
    )


def totals_match(fact, marts, amount="trip_total_usd"):
    """Trip count and amount of each mart equal those of the fact.

    `marts` maps a name to (frame, trips column or None for one row per trip, amount column or
    None where the mart holds no amount). Each table is read once, for both sums. Sums over
    empty tables are NULL and equal.
    """
    facts = _totals("", fact, F.count("*"), amount)
    rows = facts
    for name, (frame, trips, money) in marts.items():
        counted = F.sum(trips) if trips else F.count("*")
        value = F.lit(None).cast("decimal(20,6)") if money is None else F.col(money)
        rows = rows.unionByName(_totals(name, frame, counted, value))
    # A handful of rows from here on: one per table.
    wanted = rows.agg(
        F.max(F.when(F.col("table") == "", F.struct("trips", "amount"))).alias("fact"),
        F.collect_list(F.struct("table", "trips", "amount")).alias("all"),
    ).select("fact", F.inline("all")).filter(F.col("table") != "")
    silent = [name for name, (_, _, money) in marts.items() if money is None]
    same_amount = F.col("amount").eqNullSafe(F.col("fact.amount")) | F.col("table").isin(silent)
    good = (F.col("trips") == F.col("fact.trips")) & same_amount
    return wanted.select(
        F.lit("totals").alias("check"), "table",
        F.when(good, 0).otherwise(1).cast("bigint").alias("violations"), good.alias("passed"),
    )


def dimension_keys_present(fact, columns=DIMENSION_KEYS):
    return required_values("silver.fact_taxi_trip", fact, list(columns)).withColumn(
        "check", F.lit("dimension keys")
    )


def references_found(name, frame, dimension, key):
    """Keys of the frame without a dimension row; keys are made distinct before the join."""
    used = frame.select(key).filter(F.col(key).isNotNull()).distinct()
    missing = unmatched(used, dimension, [key]).agg(F.count("*").alias("n"))
    return _result(f"reference {key}", name, missing, F.col("n"))


def conversion_exact(fact, miles="trip_distance_miles", km="trip_distance_km", tolerance="0.000001"):
    """Distances in both units agree within the tolerance."""
    factor = F.lit(KM_PER_MILE).cast("decimal(10,6)")
    off = F.abs(F.col(km) - F.col(miles) * factor) > F.lit(tolerance).cast("decimal(10,6)")
    counted = fact.agg(F.count_if(off).alias("n"))
    return _result("unit conversion", "silver.fact_taxi_trip", counted, F.col("n"))


def table_set(spark, published, contracts):
    """The published tables are exactly the contracted ones."""
    odd = set(published) ^ set(contracts)
    return spark.createDataFrame([("table set", "all", len(odd), not odd)], RESULT).coalesce(1)


def contract_checks(spark, name, frame, contract):
    """Schema, key and required values of one published table."""
    checks = [schema_drift(spark, name, frame, contract), unique_grain(name, frame, contract.primary_key)]
    if contract.required:
        checks.append(required_values(name, frame, contract.required, contract.partition_by))
    return checks


def trip_checks(bronze, tables):
    """The reconciliation checks of one trip snapshot (published table names)."""
    fact = tables["silver.fact_taxi_trip"]
    area = tables["gold.mart_community_area_demand_daily"]
    total = "reported_total_usd"
    marts = {
        "gold.mart_taxi_demand_daily": (tables["gold.mart_taxi_demand_daily"], "trips", "revenue_usd"),
        "gold.mart_taxi_demand_hourly": (tables["gold.mart_taxi_demand_hourly"], "trips", "revenue_usd"),
        "gold.mart_payment_demand_daily": (tables["gold.mart_payment_demand_daily"], "trips", "revenue_usd"),
        "gold.mart_taxi_revenue_daily": (tables["gold.mart_taxi_revenue_daily"], "trips", total),
        "gold.mart_weather_demand_hourly": (tables["gold.mart_weather_demand_hourly"], "trips", total),
        "gold.mart_taxi_trip_enriched": (tables["gold.mart_taxi_trip_enriched"], None, "trip_total_usd"),
        "gold.mart_taxi_trip_distance": (tables["gold.mart_taxi_trip_distance"], None, None),
    }
    for activity in ("Pickup", "Dropoff"):
        rows = area.filter(F.col("activity") == activity)
        marts[f"gold.mart_community_area_demand_daily {activity}"] = (rows, "trips", total)
    return [
        split_complete(bronze, fact, tables["silver.quarantine_taxi_trip"]),
        totals_match(fact, marts),
        dimension_keys_present(fact),
        conversion_exact(fact),
    ]


def report(checks):
    """All result rows of a list of checks."""
    return reduce(lambda a, b: a.unionByName(b), checks)


def failures(results):
    """The rows of failed checks; their number is bounded by the number of tables."""
    return results.filter(~F.col("passed")).collect()


def require_passed(results):
    """Raise with the failed checks."""
    require_none(failures(results))


def require_none(failed):
    if failed:
        raise QualityError("; ".join(f"{r['check']}: {r['table']} ({r['violations']})" for r in failed))


def summary(bronze, fact, quarantine, amount="trip_total_usd"):
    """One row: raw, accepted and quarantined trips and the reported total."""
    parts = [
        bronze.agg(F.count("*").alias("bronze_trips"), F.lit(None).cast("decimal(30,6)").alias("total")),
        fact.agg(F.count("*").alias("accepted_trips"), F.sum(amount).alias("total")),
        quarantine.agg(F.count("*").alias("quarantined_trips")),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(
        F.max("bronze_trips").alias("bronze_trips"),
        F.max("accepted_trips").alias("accepted_trips"),
        F.max("quarantined_trips").alias("quarantined_trips"),
        F.max("total").alias("reported_total_usd"),
    )
