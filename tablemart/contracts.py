"""Table and event contracts, stated as data."""

from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableContract:
    """A published table; the DDL becomes a StructType once a session exists."""

    ddl: str
    primary_key: tuple
    partition_by: tuple = ()
    upstream: tuple = ()
    version: int = 1

    @property
    def schema(self):
        return StructType.fromDDL(self.ddl)

    @property
    def types(self):
        return {column.name: column.dataType.simpleString() for column in self.schema}

    @property
    def required(self):
        return [column.name for column in self.schema if not column.nullable]


def table(ddl, key, partition=(), upstream=()):
    return TableContract(ddl, tuple(key), tuple(partition), tuple(upstream))


RAW_ENVELOPE = (
    "record_id string not null, payload string not null, ingested_at_utc string not null,"
    " run_id string not null, sequence bigint not null"
)

# The members of a raw trip payload, all sent as text.
TRIP_MEMBERS = (
    "trip_id", "taxi_id", "trip_start_timestamp", "trip_seconds", "trip_miles", "fare", "tips",
    "trip_total", "payment_type", "company", "pickup_community_area", "dropoff_community_area",
)
TRIP_PAYLOAD = ", ".join(f"{name} string" for name in TRIP_MEMBERS if name != "trip_id")

# The published tables, their columns and their keys.
_FACT_DDL = (
    "dropoff_community_area string, pickup_community_area string, company string,"
    " payment_type string, taxi_id string, trip_id string not null,"
    " trip_duration_seconds decimal(20,6) not null, trip_distance_miles decimal(20,6),"
    " fare_usd decimal(20,6), tips_usd decimal(20,6), trip_total_usd decimal(20,6) not null,"
    " started_at string, trip_date date not null, trip_hour int not null,"
    " trip_distance_km decimal(24,6) not null, taxi_key string not null, payment_key string,"
    " company_key string, pickup_area_key string not null, dropoff_area_key string not null"
)
TABLES = {
    "bronze.taxi_trip_raw": table(RAW_ENVELOPE, ["record_id"], upstream=["source.trips"]),
    "bronze.community_area_raw": table(RAW_ENVELOPE, ["record_id"], upstream=["source.areas"]),
    "bronze.weather_hour_raw": table(RAW_ENVELOPE, ["record_id"], upstream=["source.weather"]),
    "silver.fact_taxi_trip": table(
        _FACT_DDL, ["trip_id"], ["trip_date"], ["bronze.taxi_trip_raw"]
    ),
    "silver.quarantine_taxi_trip": table(
        "trip_id string not null, taxi_id string, trip_start_timestamp string,"
        " trip_duration_seconds decimal(20,6), trip_distance_miles decimal(20,6),"
        " fare_usd decimal(20,6), tips_usd decimal(20,6), trip_total_usd decimal(20,6),"
        " payment_type string, company string, pickup_community_area string,"
        " dropoff_community_area string, started_at string, rejection_reason string",
        ["trip_id"],
        upstream=["bronze.taxi_trip_raw"],
    ),
    "silver.dim_taxi": table(
        "taxi_id string, taxi_key string not null", ["taxi_key"], upstream=["bronze.taxi_trip_raw"]
    ),
    "silver.dim_payment": table(
        "payment_type string, payment_key string not null", ["payment_key"],
        upstream=["bronze.taxi_trip_raw"],
    ),
    "silver.dim_company": table(
        "company string, company_key string not null", ["company_key"],
        upstream=["bronze.taxi_trip_raw"],
    ),
    "silver.dim_area": table(
        "area string, area_key string not null", ["area_key"], upstream=["bronze.taxi_trip_raw"]
    ),
    "silver.dim_date": table(
        "trip_date date not null, year int, month int, day_of_week int",
        ["trip_date"], ["trip_date"], ["bronze.taxi_trip_raw"],
    ),
    "silver.dim_community_area": table(
        "area_id string not null, area_name string, geometry_geojson string",
        ["area_id"], upstream=["bronze.community_area_raw"],
    ),
    "silver.dim_weather_hour": table(
        "weather_local_hour string not null, source_hours bigint, temperature_c double,"
        " precipitation_mm double, snowfall_cm double, weather_ambiguous boolean",
        ["weather_local_hour"], upstream=["bronze.weather_hour_raw"],
    ),
    "gold.mart_taxi_demand_daily": table(
        "trip_date date not null, trips bigint, revenue_usd decimal(30,6),"
        " tips_usd decimal(30,6), average_distance_km decimal(28,10),"
        " average_trip_usd decimal(24,10)",
        ["trip_date"], ["trip_date"], ["silver.fact_taxi_trip"],
    ),
    "gold.mart_taxi_demand_hourly": table(
        "trip_date date not null, trip_hour int not null, trips bigint, revenue_usd decimal(30,6)",
        ["trip_date", "trip_hour"], ["trip_date"], ["silver.fact_taxi_trip"],
    ),
    "gold.mart_payment_demand_daily": table(
        "trip_date date not null, payment_type string not null, trips bigint,"
        " revenue_usd decimal(30,6)",
        ["trip_date", "payment_type"], ["trip_date"], ["silver.fact_taxi_trip"],
    ),
    "gold.mart_taxi_revenue_daily": table(
        "trip_date date not null, taxi_key string not null, taxi_label string, trips bigint,"
        " reported_total_usd decimal(30,6)",
        ["trip_date", "taxi_key"], ["trip_date"], ["silver.fact_taxi_trip"],
    ),
    "gold.mart_taxi_trip_distance": table(
        "trip_id string not null, trip_date date, taxi_id string, trip_distance_km decimal(24,6),"
        " pickup_community_area string, dropoff_community_area string,"
        " is_positive_distance boolean",
        ["trip_id"], ["trip_date"], ["silver.fact_taxi_trip"],
    ),
    "gold.mart_taxi_trip_enriched": table(
        "weather_local_hour string, dropoff_area_id string, pickup_area_id string, " + _FACT_DDL
        + ", pickup_area_name string, dropoff_area_name string, source_hours bigint,"
        " temperature_c double, precipitation_mm double, snowfall_cm double,"
        " weather_ambiguous boolean, weather_available boolean, weather_condition string",
        ["trip_id"], ["trip_date"],
        ["silver.fact_taxi_trip", "silver.dim_community_area", "silver.dim_weather_hour"],
    ),
    "gold.mart_community_area_demand_daily": table(
        "trip_date date not null, area_id string, area_name string, activity string not null,"
        " trips bigint, reported_total_usd decimal(30,6)",
        ["trip_date", "area_id", "activity"], ["trip_date"], ["gold.mart_taxi_trip_enriched"],
    ),
    "gold.mart_weather_demand_hourly": table(
        "trip_date date not null, trip_hour int not null, weather_condition string not null,"
        " trips bigint, reported_total_usd decimal(30,6),"
        " average_trip_duration_seconds decimal(24,10), temperature_c double,"
        " precipitation_mm double, snowfall_cm double",
        ["trip_date", "trip_hour", "weather_condition"], ["trip_date"],
        ["gold.mart_taxi_trip_enriched"],
    ),
}

# Working names and the published names with units.
PUBLISHED_TABLES = {
    "silver.fct_trips": "silver.fact_taxi_trip",
    "silver.quarantine_trips": "silver.quarantine_taxi_trip",
    "gold.mart_daily": "gold.mart_taxi_demand_daily",
    "gold.mart_hourly": "gold.mart_taxi_demand_hourly",
    "gold.mart_payment": "gold.mart_payment_demand_daily",
    "gold.mart_taxi_earnings": "gold.mart_taxi_revenue_daily",
    "gold.mart_trip_distances": "gold.mart_taxi_trip_distance",
    "gold.mart_enriched_trips": "gold.mart_taxi_trip_enriched",
    "gold.mart_area_demand": "gold.mart_community_area_demand_daily",
    "gold.mart_weather_demand": "gold.mart_weather_demand_hourly",
}
PUBLISHED_FIELDS = {
    "trip_seconds": "trip_duration_seconds",
    "trip_miles": "trip_distance_miles",
    "distance_km": "trip_distance_km",
    "fare": "fare_usd",
    "tips": "tips_usd",
    "trip_total": "trip_total_usd",
    "temperature_2m": "temperature_c",
    "precipitation": "precipitation_mm",
    "snowfall": "snowfall_cm",
    "average_trip_seconds": "average_trip_duration_seconds",
}


@dataclass(frozen=True)
class RecordContract:
    """One captured source table: exact members, key and value rules."""

    key: str
    fields: dict
    enums: dict = field(default_factory=dict)
    positive: tuple = ()

    @property
    def ddl(self):
        return ", ".join(f"{name} {kind}" for name, kind in self.fields.items())


# Version 1 of the change-event contract.
SCHEMA_VERSION = 1
CAPTURE_METHOD = "transactional_outbox"
SOURCE_SCHEMA = "lending"
OPERATIONS = ("I", "U", "D")
DEFAULT_SOURCE = "lending-postgres-dev"
CDC_TABLES = {
    "loans": RecordContract(
        key="loan_id",
        fields={
            "loan_id": "bigint",
            "principal_amount": "decimal(12,2)",
            "currency": "string",
            "status": "string",
            "created_at": "timestamp",
            "updated_at": "timestamp",
        },
        enums={"status": ("active", "closed")},
        positive=("principal_amount",),
    ),
    "loan_transactions": RecordContract(
        key="transaction_id",
        fields={
            "transaction_id": "bigint",
            "loan_id": "bigint",
            "transaction_type": "string",
            "amount": "decimal(12,2)",
            "occurred_at": "timestamp",
            "updated_at": "timestamp",
        },
        enums={"transaction_type": ("disbursement", "repayment")},
        positive=("amount",),
    ),
}

LEDGER = (
    "event_id string, event_sequence bigint, source_system string, source_table string,"
    " record_id bigint, operation string, captured_at timestamp, payload_json string,"
    " event_hash string, event_json string"
)
EVENT_INDEX = "source_system string, event_id string, event_hash string"
LOAN_TOTALS = (
    "source_system string, loan_id bigint, transaction_count bigint, repaid_amount decimal(22,2),"
    " disbursed_amount decimal(22,2)"
)
QUARANTINE = "rejection_id string, source_file string, raw_json string, reason string"


def portfolio_schema():
    """Columns of the portfolio: a current loan and the totals of its transactions."""
    return state_schema("loans") + ", " + LOAN_TOTALS.split(", ", 2)[2]


def state_schema(name):
    """Columns of the latest-state table of one captured table."""
    return (
        f"source_system string, {CDC_TABLES[name].ddl}, event_sequence bigint, event_id string,"
        " event_hash string, captured_at timestamp, is_deleted boolean"
    )
